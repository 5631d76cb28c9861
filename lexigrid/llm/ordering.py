"""Global order and prefix sums of a table, without one task that sees it all.

Rows are dealt by ranges of their whole sort key, so no key value, however frequent, is one range if
the last column tells its rows apart. What stands before a row is what stands before it in its range plus the
totals of the ranges before, of which there are as many as shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage


def in_order(rows: DataFrame, keys: list[Column], path: str) -> DataFrame:
    """The rows sorted by `keys`, written to `path`, with _part (range) and _at (place in it, from 0)."""
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    part, at = F.shiftright("_place", 33).cast("int"), F.col("_place").bitwiseAND((1 << 33) - 1)
    return stage(dealt.withColumns({"_part": part, "_at": at}).drop("_place"), path)


def sums_before(
    ordered: DataFrame, group: list[str], value: Column, name: str, total: str = "_total", facts: DataFrame | None = None
) -> DataFrame:
    """`ordered` rows with `name`, the sum of `value` over the earlier rows of the same group, and `total`, that over all of it.

    `facts`, one row a group, are added to the rows with the sums, so that no frequent group is joined as such.

    `group` columns hold no nulls and come first in the order, so a group is a run of ranges. Its rows are
    gathered range by range only.
    """
    rows = ordered.withColumn("_value", value.cast("long"))
    inside = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum")).select(
        *group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_sum").over(Window.partitionBy(*group)).alias(total),
    )
    if facts is not None:
        totals = totals.join(facts, group)
    return own.join(totals, [*group, "_part"]).withColumn(name, F.col("_inside") + F.col("_earlier")).drop(
        "_value", "_inside", "_earlier"
    )
