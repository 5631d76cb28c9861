"""Corpora: folders of text files, or tables with one text per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.words import line_array


def document_id(path: Column) -> Column:
    """File name of a path without its last extension.

    The same name in two folders gives the same document.
    """
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]+$", "")


def read_text_corpus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as rows of `doc_id, line`, one row per line.

    Large files are split and small ones packed by the scan, so neither one huge
    file nor millions of tiny ones decides the number of tasks. A document may
    therefore be spread over many tasks; every job allows for that.
    """
    # The scan reports paths URL-encoded, where a plus sign stands for itself.
    raw_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(path).select(document_id(raw_path).alias("doc_id"), F.col("value").alias("line"))


def lines_of(texts: DataFrame, text: str = "text", position: str = "line_no") -> DataFrame:
    """One row per line of a text column, numbered from 0; other columns stay."""
    others = [name for name in texts.columns if name != text]
    # The outer form keeps Spark from adding a size check that repeats the split.
    return (
        texts.select(*others, F.posexplode_outer(line_array(F.col(text))).alias(position, "line"))
        .where(F.col("line").isNotNull())
    )
