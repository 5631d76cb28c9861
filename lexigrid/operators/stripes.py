"""Co-occurrence as stripes: one map of neighbour counts per word.

Counts travel as (w1, w2, n) rows and become maps only at the end, when a word
has at most one row per listed word. A listed word that occurs without any
neighbour keeps an empty stripe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.arrays import bind, run_slices
from lexigrid.functions.words import words
from lexigrid.operators.cooccurrence import centres, countable_listed, line_pairs, listed_words


def _to_stripes(counted: DataFrame) -> DataFrame:
    """(w1, w2, n) rows to maps; a row without w2 only shows that w1 occurs."""
    entry = F.when(F.col("w2").isNotNull(), F.struct("w2", "n"))
    return counted.groupBy("w1").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stripe"))


def stripes(
    lines: DataFrame, top: DataFrame, distance: int = 1, line: str = "line", checked: bool = True
) -> DataFrame:
    """`w1, stripe` over all lines.

    Without `checked`, a word of the list that never counts (too short, Roman)
    can still be a neighbour, though not a centre.
    """
    reached = centres(lines.select(line), top, distance, line).select("w1", F.explode_outer("following").alias("w2"))
    # The outer join keeps w1 where no neighbour is listed, for the empty stripe.
    listed = listed_words(top, checked).select(F.col("word").alias("_listed")).distinct()
    pairs = reached.join(listed, F.col("w2") == F.col("_listed"), "left").select("w1", F.col("_listed").alias("w2"))
    return _to_stripes(pairs.groupBy("w1", "w2").agg(F.count("*").alias("n")))


def occurrence_stripes(lines: DataFrame, top: Sequence[str], distance: int = 1, line: str = "line") -> DataFrame:
    """One stripe per occurrence of a listed word: other columns, `pos, w1, stripe`. No shuffle."""
    others = [name for name in lines.columns if name != line]
    if distance < 1:
        raise ValueError("distance must be at least 1")
    listed = countable_listed(top)
    in_order = lines.select(*others, words(F.col(line)).alias("_words"))
    placed = in_order.select(*others, "_words", F.posexplode_outer("_words").alias("pos", "w1")).where(F.col("w1").isin(listed))
    reach = placed.select(*others, "pos", "w1", F.slice("_words", F.col("pos") + 2, distance).alias("following"))
    near = F.array_distinct(F.filter("following", lambda w: w.isin(listed)))
    reach = reach.withColumn("_distinct", near)

    def entry(w2: Column) -> Column:
        n = F.size(F.filter(F.col("following"), lambda w: w == w2)).cast("long")
        return F.struct(w2.alias("w2"), n.alias("n"))

    return reach.select(*others, "pos", "w1", F.map_from_entries(F.transform("_distinct", entry)).alias("stripe"))


def stripes_by_line(
    lines: DataFrame, top: Sequence[str], distance: int = 1, line: str = "line", checked: bool = True
) -> DataFrame:
    """The stripes of every single line: other columns, `w1, stripe`. No shuffle.

    The line's pairs are in order, so those of one word follow each other and are cut out in one pass.
    """
    others = [name for name in lines.columns if name != line]
    counted = line_pairs(lines, top, distance, line, checked)
    pairs = F.transform("pair_counts", lambda p: F.struct(p["item"]["w1"].alias("w1"), p["item"]["w2"].alias("w2"), p["n"].alias("n")))

    def stripe(run: Column) -> Column:
        entries = F.transform(run, lambda pair: F.struct(pair["w2"].alias("w2"), pair["n"].alias("n")))
        return F.struct(F.get(run, F.lit(0))["w1"].alias("w1"), F.map_from_entries(entries).alias("stripe"))

    empty = F.map_from_entries(F.array().cast("array<struct<w2:string,n:bigint>>"))
    found = F.transform(bind(pairs, lambda x: run_slices(x, "w1")), stripe)
    alone = F.array_except("centre_words", F.transform("pair_counts", lambda p: p["item"]["w1"]))
    both = F.concat(found, F.transform(alone, lambda w1: F.struct(w1.alias("w1"), empty.alias("stripe"))))
    return counted.select(*others, F.inline_outer(both)).where(F.col("w1").isNotNull())


def merge_stripes(partial: DataFrame) -> DataFrame:
    """Add partial stripes entry by entry; empty ones keep their word."""
    rows = partial.select("w1", F.explode_outer("stripe").alias("w2", "n"))
    return _to_stripes(rows.groupBy("w1", "w2").agg(F.sum("n").alias("n")))
