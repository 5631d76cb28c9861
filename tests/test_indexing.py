import math

import pytest
from pyspark.sql import functions as F

from lexigrid.operators.indexing import (
    document_frequency,
    document_frequency_of_rows,
    document_stripes,
    encoded_stripes,
    long_documents,
    merge_encoded_stripes,
    row_stripes,
    score,
    term_frequency,
    tf_idf,
    top_terms,
    words_of_top_terms,
    with_document_frequency,
)
from lexigrid.plans import scores_of_corpus
from lexigrid.sources import word_list


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


@pytest.fixture()
def runners(lines_from):
    return lines_from({"a": ["running runs", "run"], "b": ["runner run"]})


def test_document_frequency_counts_documents_not_lines(runners):
    assert as_dict(document_frequency(runners), "term", "df") == {"run": 2, "runner": 1}


def test_whole_rows_give_the_same(spark):
    texts = spark.createDataFrame([("running runs\nrun",), ("runner run",)], "text string")
    assert as_dict(document_frequency_of_rows(texts), "term", "df") == {"run": 2, "runner": 1}


def test_stopwords_and_rules_apply_before_and_after_stemming(spark, lines_from):
    # `ties` stems to `ti`, too short; `cares` stems to `care`, a stopword then.
    lines = lines_from({"a": ["ties cares the vii fox"]})
    stop = word_list(spark, ["the", "care"])
    assert as_dict(document_frequency(lines, stop), "term", "df") == {"fox": 1}
    assert as_dict(document_frequency(lines, stop, stemmed=False), "term", "df") == {"ties": 1, "cares": 1, "fox": 1}


def test_a_document_may_lie_in_many_rows_and_tasks(spark, lines_from):
    lines = lines_from({"hot": ["war city"] * 500, "b": ["war"]}).repartition(7)
    assert as_dict(document_frequency(lines), "term", "df") == {"war": 2, "citi": 1}


def scattered_lines(spark):
    """Documents of 14, 4 and 23 characters and one of 8 without identifier, line by line; terms repeat across lines."""
    rows = [(1, "running"), (2, "war"), (3, "cares Runs the"), (None, "run"), (1, ""), (3, "running"), (1, None), (1, "runs"), (None, "fox"), (4, None)]
    return spark.createDataFrame(rows, "doc_id long, line string").repartition(3)


SCATTERED = {"run": 3, "war": 1, "fox": 1}
SCATTERED_UNSTEMMED = {"running": 2, "runs": 2, "run": 1, "war": 1, "fox": 1, "cares": 1}


@pytest.mark.parametrize("limits", [{}, {"LONGEST_TOGETHER": 13}, {"LONGEST_TOGETHER": 4}, {"LONGEST_TOGETHER": 0}, {"LONGEST_TOGETHER": 4, "MOST_LONG": 1}, {"MOST_LISTED": 1}])
def test_long_documents_and_lists_are_counted_alike(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(f"lexigrid.operators.indexing.{name}", value)
    lines = scattered_lines(spark)
    stop = spark.createDataFrame([("the",), ("care",), (None,)], "word string")
    assert as_dict(document_frequency(lines, stop), "term", "df") == SCATTERED
    assert as_dict(document_frequency(lines, stop, stemmed=False), "term", "df") == SCATTERED_UNSTEMMED


def test_long_documents_are_found_by_all_their_lines(spark, monkeypatch):
    keys = {r.doc_id: r.key for r in scattered_lines(spark).select("doc_id", F.xxhash64("doc_id").alias("key")).collect()}
    assert long_documents(scattered_lines(spark)) == []
    monkeypatch.setattr("lexigrid.operators.indexing.LONGEST_TOGETHER", 14)
    assert sorted(long_documents(scattered_lines(spark))) == [keys[3]]
    monkeypatch.setattr("lexigrid.operators.indexing.LONGEST_TOGETHER", 13)
    assert sorted(long_documents(scattered_lines(spark))) == sorted([keys[1], keys[3]])
    monkeypatch.setattr("lexigrid.operators.indexing.MOST_LONG", 1)
    assert long_documents(scattered_lines(spark)) is None


def test_top_terms_break_ties_by_term(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "term string, df long")
    assert [r.term for r in top_terms(df, 2).collect()] == ["c", "a"]


def family_texts(spark):
    """`run` leads by its whole family only; `fox` and `war` tie; `the` is a stopword, `cares` is one once stemmed."""
    texts = ["running war the fox", "runs the fox xii", "run runs the cares", "runner war the cares", "ran", "", None]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, line string")


@pytest.mark.parametrize("k, listed", [(1, "fox run running runs war"), (9, "fox ran run runner running runs war")])
def test_words_of_terms_that_can_lead(spark, k, listed):
    texts, stop = family_texts(spark), ["the", "care"]
    assert words_of_top_terms(texts, stop, k, "line") == listed.split()
    every = top_terms(document_frequency_of_rows(texts, stop, text="line"), k)
    some = top_terms(document_frequency_of_rows(texts, stop, text="line", listed=listed.split()), k)
    assert some.collect() == every.collect()
    assert every.first() == ("run", 3)


def test_only_listed_words_are_counted_and_stemmed(spark):
    texts = family_texts(spark)
    given = spark.createDataFrame([("run", 3), ("is", 1)], "term string, df long")
    found = term_frequency(texts, given, listed=["run", "runs", "running", "is"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, term_frequency(texts, given).collect()))
    assert [r.tf for r in term_frequency(texts, given, listed=["runs"]).orderBy("doc_id").collect()] == [1, 1]
    stripes = row_stripes(texts, ["run"], listed=["run", "runs", "running"]).orderBy("doc_id").collect()
    assert stripes == row_stripes(texts, ["run"]).orderBy("doc_id").collect()


def test_too_many_words_to_list_are_not_listed(spark, monkeypatch):
    monkeypatch.setattr("lexigrid.operators.indexing.MOST_LISTED", 3)
    assert words_of_top_terms(family_texts(spark), None, 9, "line") is None
    monkeypatch.setattr("lexigrid.operators.indexing.MOST_FAMILIES", 1)
    assert words_of_top_terms(family_texts(spark), ["the", "care"], 1, "line") is None


def test_no_words_no_list(spark):
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, line string")
    assert words_of_top_terms(empty, ["the"], 5, "line") == []
    assert scores_of_corpus(empty, ["the"], whole_documents=True).collect() == []


@pytest.mark.parametrize(
    "tf, df, expected", [(3, 2, 25.552180), (1, 9518, 0.718152), (2, 4014, 2.500537), (1, 1, 9.210440)]
)
def test_score(spark, tf, df, expected):
    row = spark.createDataFrame([(tf, df)], "tf long, df long").select(score(F.col("tf"), F.col("df")).alias("s"))
    assert round(row.first().s, 6) == expected


def test_term_frequency_has_the_looser_rule_and_no_stopwords(spark, runners, lines_from):
    dictionary = spark.createDataFrame([("run", 2), ("vii", 1), ("is", 1), ("ab", 1)], "term string, df long")
    lines = lines_from({"a": ["running vii", "runs is"], "b": ["x fox"], "c": ["ab ab"]})
    found = {(r.doc_id, r.term): r.tf for r in term_frequency(lines, dictionary).collect()}
    assert found == {("a", "run"): 2, ("a", "vii"): 1, ("a", "is"): 1, ("c", "ab"): 2}


def test_dictionary_terms_are_not_stemmed_again(spark, lines_from):
    # `univers` is the stem of `university`; stemming it once more gives another word.
    dictionary = spark.createDataFrame([("univers", 1)], "term string, df long")
    found = term_frequency(lines_from({"a": ["university"]}), dictionary).collect()
    assert [(r.term, r.tf) for r in found] == [("univers", 1)]


def test_scores_of_a_corpus_over_its_own_terms(spark, runners):
    expected = {("a", "run"): 3 * math.log(10000 / 2 + 1), ("b", "run"): math.log(10000 / 2 + 1)}
    found = {(r.doc_id, r.term): r.score for r in scores_of_corpus(runners, k=1).collect()}
    assert found == pytest.approx(expected)
    texts = runners.groupBy("doc_id").agg(F.array_join(F.collect_list("line"), "\n").alias("line"))
    whole = {(r.doc_id, r.term): r.score for r in scores_of_corpus(texts, k=1, whole_documents=True).collect()}
    assert whole == pytest.approx(expected)


def test_stripes_encode_and_merge(spark):
    tf = spark.createDataFrame([("a", "run", 2), ("a", "fox", 1), ("b", "run", 1)], "doc_id string, term string, tf long")
    encoded = encoded_stripes(document_stripes(tf))
    assert as_dict(encoded, "doc_id", "stripe") == {"a": "fox:1|run:2", "b": "run:1"}
    twice = merge_encoded_stripes(encoded.union(encoded))
    assert {(r.doc_id, r.term): r.tf for r in twice.collect()} == {("a", "fox"): 2, ("a", "run"): 4, ("b", "run"): 2}


def test_broken_parts_of_a_stripe_are_skipped(spark):
    encoded = spark.createDataFrame([("a", "run:2|x|run:1|y:z|big:99999999999|dec:1.0|"), ("b", "")], "doc_id string, stripe string")
    assert [(r.doc_id, r.term, r.tf) for r in merge_encoded_stripes(encoded).collect()] == [("a", "run", 3)]


def test_terms_from_elsewhere_default_to_one_document(spark):
    tf = spark.createDataFrame([("a", "run", 1), ("a", "odd", 1)], "doc_id string, term string, tf long")
    dictionary = spark.createDataFrame([("run", 4)], "term string, df long")
    scored = {r.term: r.score for r in tf_idf(with_document_frequency(tf, dictionary)).collect()}
    assert scored == pytest.approx({"run": math.log(2501), "odd": math.log(10001)})
