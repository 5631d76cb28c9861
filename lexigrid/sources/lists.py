"""Word lists and document-frequency dictionaries kept as small text files.

No list is broadcast by hint. Spark sees the size of a file or of a limited
result and broadcasts only below `spark.sql.autoBroadcastJoinThreshold`; a
larger list is joined by shuffling.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.words import java_trim


def word_list(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """A list given in code, as `word`.

    Arrow data becomes a local relation, whose size the planner knows.
    """
    return spark.createDataFrame(pa.table({"word": pa.array(list(words), pa.string())}))


def parse_stopwords(lines: DataFrame, value: str = "value") -> DataFrame:
    """One word per line, trimmed and lowered; blank lines are skipped."""
    return _distinct_words(lines, java_trim(F.lower(F.col(value))))


def parse_top_words(lines: DataFrame, value: str = "value") -> DataFrame:
    """First blank-separated field of each line, lowered; the count is ignored.

    A line that starts with a blank has an empty first field and is skipped.
    """
    first = F.element_at(F.split(F.lower(F.col(value)), r"\s+"), 1)
    return _distinct_words(lines, java_trim(first))


def _distinct_words(lines: DataFrame, word: Column) -> DataFrame:
    return lines.select(word.alias("word")).where(F.col("word") != "").distinct()


def parse_df_dictionary(lines: DataFrame, value: str = "value", order: str = "line_no") -> DataFrame:
    """`term⇥df` lines as a table; the last line of a repeated term wins.

    Lines need exactly two fields (empty ones at the end do not count) and a
    32-bit integer in the second; others are skipped.
    """
    fields = F.split(F.regexp_replace(F.col(value), r"\t+$", ""), "\t")
    count = java_trim(F.get(fields, F.lit(1)))
    # A cast alone would also accept blanks and decimals.
    is_integer = count.rlike(r"^[+-]?[0-9]+$")
    return (
        lines.where(F.size(fields) == 2)
        .select(
            java_trim(F.get(fields, F.lit(0))).alias("term"),
            F.when(is_integer, count.try_cast("int")).cast("long").alias("df"),
            F.col(order).alias("_order"),
        )
        .where(F.col("df").isNotNull())
        .groupBy("term")
        .agg(F.max_by("df", "_order").alias("df"))
    )


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    return parse_stopwords(spark.read.text(path))


def read_top_words(spark: SparkSession, path: str) -> DataFrame:
    return parse_top_words(spark.read.text(path))


def read_df_dictionary(spark: SparkSession, path: str) -> DataFrame:
    # Place in the file: blocks may be scanned in any order, rows of a block not.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return parse_df_dictionary(spark.read.text(path).select("value", place.alias("line_no")))


def as_sequence(listed: DataFrame, at_most: int = 100_000) -> list[str]:
    """The words of a list file for the jobs that keep it in every task; a longer one is refused."""
    found = [row.word for row in listed.select("word").limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"the list has more than {at_most} words; use the job without --by-line")
    return found
