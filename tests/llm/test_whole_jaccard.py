"""The similarity join on long lists of unlike sets, short ids, and rows kept for null and repeated doc_ids."""

import random

import pytest
import xxhash

from lexigrid.llm import jaccard_join
from lexigrid.llm.jaccard_join import JaccardJoin, halves, short_id, short_ids, unique_turn
from tests.llm.test_edges import SCHEMA, brute_groups, rows


def mosaics(seed):
    """Near copies, and texts made of a few common phrases, which share many n-grams and are unlike."""
    draw = random.Random(seed)
    bases = [[draw.choice("abcdefgh") + str(draw.randrange(30)) for _ in range(draw.choice([3, 7, 60, 900]))] for _ in range(12)]
    phrases = [[draw.choice("pqrs") + str(draw.randrange(30)) for _ in range(9)] for _ in range(12)]
    texts = [None, "", "One two", "one TWO"]
    for _ in range(120):
        words = list(draw.choice(bases))
        for _ in range(draw.randrange(6)):
            words[draw.randrange(len(words))] = "new" + str(draw.randrange(99))
        texts.append(" ".join(words))
    return texts + [" ".join(sum((draw.choice(phrases) for _ in range(draw.choice([1, 2, 3, 5, 20]))), [])) for _ in range(120)]


@pytest.mark.parametrize("seed,percent", [(2, 80), (3, 80), (4, 60)])
def test_long_lists_lose_no_pair(spark, seed, percent):
    texts = mosaics(seed)
    join = JaccardJoin(spark.createDataFrame(rows(*texts), SCHEMA), percent=percent, bucket_log=4, long_list=2)
    wanted = brute_groups(texts, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in join.groups().collect()} == wanted
    assert sorted(r.doc_id for r in join.kept_rows().collect()) == sorted(i for i, (_, c) in wanted.items() if i == c)


def test_many_unlike_sets_that_share_an_n_gram(spark):
    draw = random.Random(1)

    def own(i):
        return [f"u{i}x{k}" for k in range(draw.randrange(6, 20))] + ["the same five words here"] + [f"v{i}x{k}" for k in range(draw.randrange(6, 20))]

    texts = [" ".join(own(i)) for i in range(3000)]
    texts += [texts[i] + " more" for i in range(0, 3000, 100)]
    table = spark.createDataFrame(rows(*texts), SCHEMA)
    found = {r.doc_id: r.component_id for r in JaccardJoin(table, bucket_log=2, long_list=64).groups().collect()}
    assert found == {i: i if i < 3000 else (i - 3000) * 100 for i in range(len(texts))}


def test_short_ids_are_unique(spark):
    nodes = [bytes(range(k, k + 16)) for k in range(50)] + [b"\x01" * 8 + b"\x01" * 8, b"\x02" * 8 + b"\x02" * 8]
    one, two = halves(nodes).T.tolist()
    table = spark.createDataFrame(list(zip(one, two, strict=True)), "one long, two long")
    assert len(set(short_ids(nodes, 0))) < len(nodes)  # equal halves undo each other
    for turn in (0, 1, 63):
        assert sorted(r[0] for r in table.select(short_id(table.one, table.two, turn)).collect()) == sorted(short_ids(nodes, turn).tolist())
    turn = unique_turn(table)
    assert turn > 0 and len(set(short_ids(nodes, turn))) == len(nodes)


def test_one_row_of_a_group_stays_whatever_its_doc_ids(spark):
    base = " ".join(f"w{i}" for i in range(100))
    near = [base, base + " x", base + " y", "z " + base]
    other = [t.replace("w", "q") for t in near]
    alone = ["some words that stand alone", None, ""]
    table = [(None, t, "en", "a", "x", 1, "y", 0.5) for t in near] + [(7, t, "en", "a", "x", 1, "y", 0.5) for t in [*other, other[0]]]
    table += [(9, t, "en", "a", "x", 1, "y", 0.5) for t in alone]
    frame = spark.createDataFrame(table, SCHEMA)
    kept = JaccardJoin(frame, bucket_log=10).kept_rows()
    assert kept.columns == frame.columns
    texts = [r.text for r in kept.collect()]
    assert len(texts) == 5 and set(alone) <= set(texts)
    assert len([t for t in texts if t in near]) == 1 and len([t for t in texts if t in other]) == 1


def test_pairs_of_long_lists_meet_where_enough_can_follow(spark):
    join = object.__new__(JaccardJoin)
    join.percent = 80
    parity = "struct<narrow: array<long>, wide: array<long>>"
    schema = f"gram long, node long, n int, pos int, label long, most long, parity {parity}, second long, pos2 int, step int, own int"
    # From position 19 on 81 of 100 n-grams are left, too few for 80 percent; from 2 on there are enough.
    rows = [(1, node, 100, 0, node, 9, None, second, pos, 5, 5) for node in (1, 2) for second, pos in ((7, 19), (8, 2))]
    rows += [(1, 3, 100, 0, 3, 9, ([0] * 8, None), 8, 2, 5, 5), (1, 4, 100, 0, 4, 9, ([-1] + [0] * 7, None), 8, 2, 5, 5)]
    table = spark.createDataFrame(rows, schema)
    met = join._met(table, table.hint("merge"), ["gram", "second", "step"])
    assert sorted((r.a, r.b) for r in met.collect()) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)]
    one = spark.createDataFrame([r for r in rows if r[7] == 7], schema)
    assert join._met(one, one, ["gram", "second", "step"]).collect() == []


@pytest.mark.parametrize("bit, expected", [(0, [(1, 2)]), (-1, [])])
def test_pairs_of_large_sets_look_at_wide_parities(spark, bit, expected):
    join = object.__new__(JaccardJoin)
    join.percent = 80
    schema = "gram long, node long, n int, pos int, label long, most long, parity struct<narrow: array<long>, wide: array<long>>"
    rows = [(1, node, 600, 0, node, 9, ([0] * 8, [bit * (node - 1)] * 64)) for node in (1, 2)]
    table = spark.createDataFrame(rows, schema)
    assert [(r.a, r.b) for r in join._met(table, table, ["gram"], wide=True).collect()] == expected
    assert join._met(table, table, ["gram"]).collect() == []  # left to the other join


@pytest.mark.parametrize("together", [1, 40, 1 << 17])
def test_sets_of_texts_hashed_together(monkeypatch, together):
    monkeypatch.setattr(jaccard_join, "TOGETHER", together)
    draw = random.Random(5)
    texts = [bytes(draw.choices(b"aB zZ\t\n\x0b\x0c\r\x1c\x85\xff\x00", k=draw.randrange(80))) for _ in range(200)]
    texts += [b"x" * n for n in range(70)] + [b"a " * n for n in range(9)] + [b""]
    for text in texts:
        found, starts = jaccard_join.word_hashes(text)
        assert found.tolist() == [xxhash.xxh64_intdigest(w) for w in text.lower().split()]
        assert all(text[i : i + 1].strip() for i in starts.tolist())
    sets = [*jaccard_join.shingle_sets(texts, 5)]
    for text, found in zip(texts, sets, strict=True):
        words = text.lower().split()
        n = min(5, len(words))
        assert len(found) == (len({*zip(*(words[i:] for i in range(n)), strict=False)}) if n else 0)
        assert (found == jaccard_join.shingles(text, 5)).all() and (found[1:] > found[:-1]).all()
