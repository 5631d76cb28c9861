"""Mixing to target weights: targets, exact budgets, epochs, and the rows of the mix."""

import random
import re
from fractions import Fraction

import pytest

from lexigrid.llm.mixing import Mixture

SCHEMA = "doc_id long, text string, source string, size long, target double, key string, row long, budget int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, 0.5, "x", 1, 2) for r in rows], SCHEMA)


def wanted_targets(rows, percent=150, most=2):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORDS.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = Fraction(percent * sum(sizes.values()), 100), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: Fraction(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return sizes, target


def draw(seed, sources, n=300):
    rng = random.Random(seed)
    return [(i, "w\t" * rng.randrange(0, 40), rng.choice(sources)) for i in range(n)]


CASES = {
    "many sources": draw(1, [None, "a", "B", "é", "z", "", "hot", "hot", "hot", "hot"]),
    "one hot source": [(i, "a b c", "hot" if i else "small") for i in range(200)],
    "one source": draw(2, ["only"]),
    "nulls and ties": [(None, "a b", None)] * 7 + [(3, "a b", "x")] * 5 + [(3, None, "x"), (4, "", "y"), (5, " \n", "z")],
    "no words": [(1, None, "a"), (2, "", None)],
    "long text": [(1, "word " * 200_000, "a"), (2, "b", "b"), (3, "c", "c")],
}


@pytest.mark.parametrize("name", CASES)
def test_budgets_are_met_to_the_word(spark, name):
    rows = CASES[name]
    sizes, target = wanted_targets(rows)
    mix = Mixture(table(spark, rows), copies=True)
    plan = mix.plan().collect()
    assert sorted(r.size for r in plan) == sorted(len(WORDS.findall(t or "")) for _, t, _ in rows)
    taken, words = {}, {r.row: r for r in plan}
    assert len(words) == len(rows)
    known = {r.source: r for r in mix.sources.collect()}
    for source, size in sizes.items():
        code = "1" if source is None else "0" + source
        assert (known[code].source_size, known[code].budget) == (size, int(target[source]))
        assert known[code].target == pytest.approx(float(target[source]), rel=1e-12)
    for r in mix.rows().collect():
        taken[r.source] = taken.get(r.source, 0) + len(WORDS.findall(r.text))
    assert taken == {s: int(t) for s, t in target.items() if int(t)}
    assert all(0 <= r.taken <= 2 * r.size for r in plan)
    # Epochs: every document is taken a whole number of times, but for one at most in each source.
    for code in known:
        times = [divmod(r.taken, r.size)[1] for r in plan if r.size and r.source_size == known[code].source_size and r.target == known[code].target]
        if len({(k.source_size, k.target) for k in known.values()}) == len(known):
            assert sum(map(bool, times)) <= 1


def test_rows_keep_their_columns_and_are_cut_at_a_word(spark):
    rows = [(i, "  one two\nthree ", "s") for i in range(10)]
    mix = Mixture(table(spark, rows), percent=145, copies=True)
    out = mix.rows()
    assert out.columns == [*table(spark, rows).columns, "_llm_epoch"]
    found = out.collect()
    assert sorted(r._llm_epoch for r in found) == [0] * 10 + [1] * 5  # 43 of 30 words
    assert sorted(r.text for r in found if r._llm_epoch == 1) == ["  one"] + ["  one two\nthree "] * 4


def test_reruns_and_other_partitions_agree(spark):
    rows = table(spark, CASES["many sources"])
    plans = [sorted(tuple(r)[:5] for r in Mixture(t).plan().collect()) for t in (rows, rows.repartition(7), rows.repartition(3))]
    assert plans[0] == plans[1] == plans[2]


def test_empty_table(spark):
    assert Mixture(table(spark, []), copies=True).plan().count() == 0
    assert Mixture(table(spark, []), copies=True).rows().count() == 0
