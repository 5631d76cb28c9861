"""Word counts and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.words import is_countable_token, words


def positioned_words(lines: DataFrame, case_mode: str = "insensitive", line: str = "line") -> DataFrame:
    """One row per word with its raw position in the line; other columns stay."""
    others = [name for name in lines.columns if name != line]
    return lines.select(*others, F.posexplode_outer(words(F.col(line), case_mode)).alias("pos", "word")).where(
        F.col("word") != ""
    )


def countable_words(lines: DataFrame, case_mode: str = "insensitive", line: str = "line") -> DataFrame:
    """The words that count (length and Roman rules), in a column `word`.

    Lines may be whole texts: a line break separates words like any non-letter.
    """
    others = [name for name in lines.columns if name != line]
    return lines.select(*others, F.explode_outer(words(F.col(line), case_mode)).alias("word")).where(
        is_countable_token(F.col("word"))
    )


def without_stopwords(word_rows: DataFrame, stopwords: DataFrame | None, column: str = "word") -> DataFrame:
    """Drop rows whose word is on the list; no list, no change."""
    if stopwords is None:
        return word_rows
    listed = stopwords.select(F.col("word").alias(column))
    return word_rows.join(listed, column, "left_anti")


def word_counts(
    lines: DataFrame,
    stopwords: DataFrame | None = None,
    case_mode: str = "insensitive",
    line: str = "line",
) -> DataFrame:
    """`word, n` over all lines.

    Each task counts before the shuffle, so a word that makes up a third of the
    corpus is one row per task there.
    """
    counts = countable_words(lines.select(line), case_mode, line).groupBy("word").agg(F.count("*").alias("n"))
    # Counts are joined, not words: where the list is too large to broadcast, no frequent word is
    # shuffled as itself. A small list is joined below the count, by Spark's own choice.
    return without_stopwords(counts, stopwords)


def top_words(counts: DataFrame, k: int = 50, ties: str = "ascending") -> DataFrame:
    """The `k` most frequent words; equal counts in word order.

    Every task keeps its own best `k`, so no full sort takes place.
    """
    tie_order = {"ascending": F.asc("word"), "descending": F.desc("word")}[ties]
    return counts.orderBy(F.desc("n"), tie_order).limit(k)


def ranked(top: DataFrame) -> DataFrame:
    """Add the place (from 1) to a top list. The list is one small group."""
    order = Window.orderBy(F.desc("n"), F.asc("word"))
    return top.select(F.row_number().over(order).alias("place"), "word", "n")
