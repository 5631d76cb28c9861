"""Results as lines of text: `key⇥value`, sorted by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entries(stripe: Column, between: str, separator: str) -> Column:
    """Map entries sorted by key, so the text does not depend on map order."""
    entries = F.array_sort(F.map_entries(stripe))
    rendered = F.transform(entries, lambda e: F.concat(e["key"], F.lit(between), e["value"].cast("string")))
    return F.array_join(rendered, separator)


def stripe_text(stripe: Column) -> Column:
    """`{k=v, k=v}`."""
    return F.concat(F.lit("{"), _entries(stripe, "=", ", "), F.lit("}"))


def encode_stripe(stripe: Column) -> Column:
    """`term:count|term:count`."""
    return _entries(stripe, ":", "|")


def render_tsv(rows: DataFrame, key: str, value: str) -> DataFrame:
    """`key⇥value` lines next to their sort key (word counts, frequencies)."""
    return rows.select(F.col(key).alias("key"), F.concat_ws("\t", key, F.col(value).cast("string")).alias("line"))


def render_ranked(rows: DataFrame, key: str, value: str) -> DataFrame:
    """`render_tsv` for top lists, which are written highest value first."""
    place = F.struct((-F.col(value)).alias("down"), F.col(key).alias("key"))
    return rows.select(place.alias("key"), F.concat_ws("\t", key, F.col(value).cast("string")).alias("line"))


def render_pairs(pairs: DataFrame) -> DataFrame:
    """`w1,w2⇥n` lines."""
    return render_tsv(pairs.select(F.concat_ws(",", "w1", "w2").alias("pair"), "n"), "pair", "n")


def render_stripes(stripes: DataFrame) -> DataFrame:
    """`w1⇥{k=v, k=v}` lines."""
    return render_tsv(stripes.select("w1", stripe_text(F.col("stripe")).alias("stripe")), "w1", "stripe")


def render_scores(scores: DataFrame) -> DataFrame:
    """`id⇥term⇥score` lines with six decimals."""
    doc_id = F.col("doc_id").cast("string")
    line = F.concat_ws("\t", doc_id, "term", F.format_string("%.6f", "score"))
    return scores.select(F.concat_ws("\t", doc_id, "term").alias("key"), line.alias("line"))


def write_lines(rendered: DataFrame, path: str, single_file: bool = False) -> None:
    """Write rendered lines in key order (UTF-8 bytes); the folder must not exist.

    The sort partitions by key range, so the part files, read in name order, are
    the sorted result; no task sees all of it. `single_file` forces one part and
    is for results of known small size: top lists, pairs and stripes over a top
    list.
    """
    if single_file:
        ordered = rendered.repartition(1).sortWithinPartitions("key", "line")
    else:
        ordered = rendered.orderBy("key", "line")
    ordered.select(F.col("line").alias("value")).write.mode("errorifexists").text(path)
