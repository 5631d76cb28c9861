import random

import pytest

from lexigrid.operators.cooccurrence import (
    pair_counts,
    pair_counts_by_line,
    pair_counts_by_window,
    roll_up_pairs,
)
from lexigrid.operators.stripes import merge_stripes, occurrence_stripes, stripes, stripes_by_line
from lexigrid.plans import cooccurrence_of_corpus
from lexigrid.sources import word_list
from tests import brute

LISTED = ["war", "world", "city", "xii", "of", ""]


def as_pairs(df):
    return {(r.w1, r.w2): r.n for r in df.collect()}


def as_stripes(df):
    return {r.w1: dict(r.stripe) for r in df.collect()}


@pytest.fixture(scope="module")
def noise(lines_from):
    """Lines of listed, unlisted and never-counting words; one long line full of one pair."""
    random.seed(7)
    vocabulary = ["war", "world", "city", "xii", "of", "the", "fox", "War", "x1", "café"]
    documents = {
        f"d{d}": [
            " ".join(random.choices(vocabulary, k=random.randint(0, 12))) + random.choice(["", ".", " "])
            for _ in range(20)
        ]
        for d in range(6)
    }
    documents["hot"] = ["war world " * 3000]
    return documents, lines_from(documents)


def test_hand_made_pairs(spark, lines_from):
    lines, top = lines_from({"a": ["war world the war"]}), word_list(spark, ["war", "world"])
    assert as_pairs(pair_counts(lines, top, 1)) == {("war", "world"): 1}
    assert as_pairs(pair_counts(lines, top, 2)) == {("war", "world"): 1, ("world", "war"): 1}
    assert as_pairs(pair_counts(lines, top, 3)) == {("war", "world"): 1, ("world", "war"): 1, ("war", "war"): 1}


def test_no_pair_and_an_empty_stripe_across_lines(spark, lines_from):
    lines, top = lines_from({"a": ["war", "world"]}), word_list(spark, ["war", "world"])
    assert as_pairs(pair_counts(lines, top, 4)) == {}
    for result in (stripes(lines, top, 4), merge_stripes(stripes_by_line(lines, ["war", "world"], 4))):
        assert as_stripes(result) == {"war": {}, "world": {}}


def test_words_that_never_count_can_be_loose_neighbours_only(spark, lines_from):
    lines, top = lines_from({"a": ["war xii war"]}), word_list(spark, ["war", "xii"])
    for make, given in ((stripes, top), (lambda *a, **k: merge_stripes(stripes_by_line(*a, **k)), ["war", "xii"])):
        assert as_stripes(make(lines, given, 1)) == {"war": {}}
        assert as_stripes(make(lines, given, 1, checked=False)) == {"war": {"xii": 1}}


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_all_forms_agree_with_brute_force(spark, noise, distance):
    documents, lines = noise
    texts = [line for document in documents.values() for line in document]
    top = word_list(spark, LISTED)
    expected = brute.pair_counts(texts, set(LISTED), distance)
    assert as_pairs(pair_counts(lines, top, distance)) == expected
    assert as_pairs(roll_up_pairs(pair_counts_by_line(lines, LISTED, distance))) == expected
    assert as_pairs(pair_counts_by_window(lines, top, distance)) == expected
    for checked in (True, False):
        expected_stripes = brute.stripes(texts, set(LISTED), distance, checked)
        assert as_stripes(stripes(lines, top, distance, checked=checked)) == expected_stripes
        by_line = stripes_by_line(lines, LISTED, distance, checked=checked)
        assert as_stripes(merge_stripes(by_line)) == expected_stripes
    merged = merge_stripes(occurrence_stripes(lines, LISTED, distance))
    assert as_stripes(merged) == brute.stripes(texts, set(LISTED), distance)


def test_line_counts_are_those_of_each_line(spark, noise):
    documents, lines = noise
    found = {}
    for r in pair_counts_by_line(lines, LISTED, 2).collect():
        found.setdefault((r.doc_id, r.line_no), {})[r.w1, r.w2] = r.n
    expected = {
        (doc, i): dict(counted)
        for doc, document in documents.items()
        for i, line in enumerate(document)
        if (counted := brute.pair_counts([line], set(LISTED), 2))
    }
    assert found == expected


def test_results_do_not_depend_on_broadcasting(spark, noise):
    documents, lines = noise
    top = word_list(spark, LISTED)
    expected = brute.pair_counts([line for d in documents.values() for line in d], set(LISTED), 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_pairs(pair_counts(lines, top, 2)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_counts_never_fall_with_distance(spark, noise):
    _, lines = noise
    top = word_list(spark, LISTED)
    near, far = as_pairs(pair_counts(lines, top, 1)), as_pairs(pair_counts(lines, top, 3))
    assert all(far[pair] >= n for pair, n in near.items())


def test_a_list_taken_from_the_corpus(spark, noise):
    documents, lines = noise
    found = as_pairs(cooccurrence_of_corpus(lines, None, k=2, distance=1))
    texts = [line for d in documents.values() for line in d]
    assert found == brute.pair_counts(texts, {"war", "world"}, 1)


@pytest.mark.parametrize("make", [pair_counts, pair_counts_by_line, stripes])
def test_distance_must_be_positive(spark, lines_from, make):
    with pytest.raises(ValueError):
        make(lines_from({"a": ["war"]}), ["war"] if make is pair_counts_by_line else word_list(spark, ["war"]), 0)
