"""Proportional stratified interleaving: shards that all hold the corpus's mixture of sources.

Rows of a source are put in a seeded random order; a row's fractional rank is its place in that
order over the source's size. In the order of fractional ranks every stretch holds each source in
proportion, so the order is cut into shards of equal row counts.

Both rankings are made without gathering a source, the corpus or a tie in one task: rows are dealt by ranges of
their whole sort key, and a row's rank is what stands in the ranges before plus its place in its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import in_order, sums_before
from .shared import scratch, stage


def assign_shards(docs: DataFrame, shards: int = 40, seed: int = 7, payload: list[Column | str] | None = None) -> DataFrame:
    """doc_id, the `payload` columns, shard (0 to shards - 1) and slot (gapless from 0).

    Row counts of shards differ by one at most, whatever the sources. Null sources are a source
    of their own. Null doc_ids and repeated rows are dealt like any others; rows with equal
    doc_id, source and text are interchangeable. An empty table gives no rows. With fewer
    rows than shards the last shards stay empty. Texts, however long, are read once and not shuffled. Other columns play no
    part, whatever their names; `payload` must not name doc_id, shard or slot.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    work = scratch(docs.sparkSession, "shards")
    rows = docs.select(
        F.struct("doc_id", *(payload or [])).alias("payload"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"),
        key.alias("key"), F.col("doc_id"), F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    keys = [F.col(c) for c in ("source", "key", "doc_id", "tie", "row")]
    ordered = in_order(stage(rows, f"{work}/rows"), keys, f"{work}/in-source")
    ranked = sums_before(ordered, ["source"], F.lit(1), "before", total="of").drop("_part", "_at")
    ranked = ranked.withColumn("part", (F.col("before") + F.lit(0.5)) / F.col("of"))
    ranked = stage(ranked.drop("before", "of"), f"{work}/ranked")
    ordered = in_order(ranked, [F.col("part"), *keys], f"{work}/in-order").withColumn("whole", F.lit(0))
    placed = sums_before(ordered, ["whole"], F.lit(1), "place", total="n").withColumn("shards", F.lit(shards))
    shard = F.expr("CAST(place * shards DIV n AS INT)")
    slot = F.expr("place - (shard * n + shards - 1) DIV shards")
    return placed.withColumn("shard", shard).withColumn("slot", slot).select("payload.*", "shard", "slot")
