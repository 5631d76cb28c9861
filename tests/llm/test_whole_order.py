"""Ranges of a whole sort key: ties spread over tasks, sums are those of the sorted rows, shards those of one sorted list."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexigrid.llm.ordering import in_order, sums_before
from lexigrid.llm.sharding import assign_shards
from lexigrid.llm.shared import scratch

NAMES = "doc_id long, text string, source string, shard string, slot long, key string, part long, payload string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "k", 2, "p") for r in rows], NAMES)


def slow_shards(rows, shards):
    """(doc_id, source, text, shard, slot), from lists that are sorted whole."""
    def key(r):
        return hashlib.md5(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())

    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[2]].append(r)
    ranked = []
    for source, own in by_source.items():
        named = "" if source is None else "=" + source
        ranked += [((i + 0.5) / len(own), named.encode(), key(r), r) for i, r in enumerate(sorted(own, key=key))]
    ranked.sort(key=lambda x: x[:3])
    out = []
    for place, (*_, r) in enumerate(ranked):
        shard = place * shards // len(rows)
        out.append((r[0], r[2], r[1] or "", shard, place - -(-shard * len(rows) // shards)))
    return sorted(out, key=repr)


def draw(seed, n):
    rng = random.Random(seed)
    ids = [None, 1, 2, 3, *range(10, 200)]
    return [(rng.choice(ids), rng.choice([None, "", "a", "b"]), rng.choice([None, "", "hot", "hot", "hot", "x", f"s{i}"])) for i in range(n)]


CASES = {
    "null and equal doc_ids and sources": draw(1, 400),
    "sources of one row": [(i, "t", f"s{i}") for i in range(3000)],
    "all doc_ids null": [(None, f"t{i % 7}", "s") for i in range(1000)],
    "equal rows": [(5, "same", "s")] * 300,
    "one row": [(None, None, None)],
    "long text": [(1, "long " * 500_000, "a"), (2, "b", "a"), (3, None, "b")],
}


@pytest.mark.parametrize("name", CASES)
def test_shards_are_those_of_one_sorted_list(spark, name):
    rows = CASES[name]
    found = assign_shards(table(spark, rows), shards=7, payload=["source", "text", F.col("key").alias("mine")])
    assert found.columns == ["doc_id", "source", "text", "mine", "shard", "slot"]
    got = sorted(((r.doc_id, r.source, r.text or "", r.shard, r.slot) for r in found.collect()), key=repr)
    assert got == slow_shards(rows, 7)


@pytest.fixture
def uneven_partitions_stay(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_ties_spread_over_tasks(spark, uneven_partitions_stay):
    rows = spark.range(20_000).select(F.lit(0).alias("tie"), F.col("id").alias("row"))
    ordered = in_order(rows, [F.col("tie"), F.col("row")], scratch(spark, "ties"))
    sizes = [r["count"] for r in ordered.groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 5000  # not all in one of the four ranges


def test_sums_before_and_totals(spark, uneven_partitions_stay):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(9)}", i, rng.randrange(5)) for i in range(500)]
    frame = spark.createDataFrame(rows, "g string, i long, v long").repartition(3)
    ordered = in_order(frame, [F.col("g"), F.col("i")], scratch(spark, "sums"))
    for r in sums_before(ordered, ["g"], F.col("v"), "before", total="all").collect():
        own = [x for x in rows if x[0] == r.g]
        assert r.before == sum(v for _, i, v in own if i < r.i) and r["all"] == sum(v for *_, v in own)
