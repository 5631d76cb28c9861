"""Estimation against plain Python over single candidates, what the classifier rejects, and the work in long texts."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from lexigrid.llm import pii

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def whole(spark):
    return pii.PersonalData(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def brute_beliefs(candidates, rounds=50, anchor=0.2):
    """Each candidate by itself, with pseudo-candidates for what the votes are taken to mean."""
    meant = [pii.CHECKED] + [pii.MEANT] * 3
    held = anchor * len(candidates)
    prior, like = 0.5, lambda j, c, y: meant[j][c][y]
    for _ in range(rounds):
        belief = []
        for votes in candidates:
            yes, no = prior, 1 - prior
            for j, c in enumerate(votes):
                yes, no = yes * like(j, c, 0), no * like(j, c, 1)
            belief.append(yes / (yes + no))
        prior = (held / 2 + sum(belief)) / (held + len(candidates))
        table = {}
        for j in range(4):
            for y in (0, 1):
                weights = [b if y == 0 else 1 - b for b in belief]
                for c in "+0-":
                    seen = sum(w for w, votes in zip(weights, candidates, strict=True) if votes[j] == c)
                    table[j, c, y] = meant[j][c][y] if j == 0 else (held * meant[j][c][y] + seen) / (held + sum(weights))
        like = lambda j, c, y, table=table: table[j, c, y]
    return dict(zip(candidates, belief, strict=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_beliefs_are_those_of_single_candidates(seed):
    draw = random.Random(seed)
    patterns = ["".join(draw.choice("+0-") for _ in range(4)) for _ in range(12)]
    candidates = [draw.choice(patterns) for _ in range(300)]
    counts = {("card", v): candidates.count(v) for v in candidates}
    wanted = brute_beliefs(candidates)
    found = pii.reliabilities(counts)["card"]
    assert found == pytest.approx(wanted, rel=1e-9)


def test_numbers_that_fail_their_check_are_disbelieved(whole):
    assert any(v[0] == "-" for v in whole.belief["card"])
    for kind, beliefs in whole.belief.items():
        for votes, belief in beliefs.items():
            assert (belief < 0.5) == (votes[0] == "-"), (kind, votes, belief)
    assert whole.belief == {k: pytest.approx(v, rel=1e-9) for k, v in pii.reliabilities(
        {(r.kind, r.votes): r["count"] for r in whole.extracted.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes").count().collect()}
    ).items()}


def test_the_classifier_rejects_what_is_disbelieved(whole):
    bar = math.log(whole.threshold / (1 - whole.threshold))
    rejected, passed = 0, {}
    for r in whole.extracted.where(F.size("candidates") > 0).collect():
        for c in r.candidates:
            total = whole.odds.get(c.kind, 0.0) + sum(whole.odds.get(t, 0.0) for t in c.traits)
            passed.setdefault((c.kind, c.votes[0]), []).append(total >= bar)
            rejected += total < bar
    assert rejected > 100
    assert not any(passed["card", "-"]) and all(passed["card", "+"]) and all(passed["ip", "+"])


def test_dates_orders_and_versions_are_no_phones(spark):
    yes = [f"call +1 (212) 555-{i:04} or +44 20 7946 {i:04}" for i in range(40)]
    no = [f"order {20000000 + i}, of 2024-01-{i % 28 + 1:02}, serial 19.12.{i + 1950}, no 123456789012{i:010}" for i in range(80)]
    table = spark.createDataFrame(list(enumerate(yes + no)), "doc_id long, text string")
    found = pii.PersonalData(table).spans().select("doc_id", pii.listed(F.col("spans")).alias("spans")).collect()
    assert all(r.spans.count("phone") == 2 for r in found if r.doc_id < 40)
    assert all(r.spans == "" for r in found if r.doc_id >= 40)


def test_overlaps_are_found_by_halving(spark):
    draw = random.Random(4)
    rows = []
    for _ in range(200):
        ends = sorted(draw.sample(range(60), 2 * draw.randrange(0, 12)))
        start = draw.randrange(60)
        rows.append(([{"start": a, "end": b} for a, b in zip(ends[::2], ends[1::2], strict=True)], {"start": start, "end": start + draw.randrange(1, 9)}))
    table = spark.createDataFrame(rows, "spans array<struct<start: int, end: int>>, c struct<start: int, end: int>")
    for r in table.withColumn("met", pii.meets(F.col("spans"), F.col("c"))).collect():
        assert r.met == any(s.start < r.c.end and r.c.start < s.end for s in r.spans)


def test_work_grows_with_the_spans_of_a_text(spark):
    def seconds(n):
        text = "10.20.30.40 call 212-555-0199 now, " * n
        table = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        r = pii.PersonalData(table).spans().select(F.size("base").alias("base"), F.element_at("base", -1).alias("last")).first()
        assert r.base >= n and r.last.start > len(text) - 60
        return time.time() - start

    seconds(100)
    few, many = seconds(20_000), seconds(40_000)
    assert many <= 2.5 * few
