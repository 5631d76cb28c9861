"""Directed co-occurrence of listed words within a distance, as pairs.

A pair is (w1, w2) with w2 one to `distance` places after w1 in the same line.
Places are raw word positions, so words that are not listed still take up
distance. The window is a slice of the line's own word array: no join of the
corpus with itself, and nothing is shuffled before the counts are aggregated.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.arrays import bind, count_equal
from lexigrid.functions.words import is_countable, words
from lexigrid.operators.wordcount import positioned_words


def listed_words(top: DataFrame, checked: bool = True) -> DataFrame:
    """The list as `word` rows; `checked` leaves out words that never count.

    The check is written as a value, not as a filter on `word`: Spark would
    repeat such a filter, pattern and all, on every word of the corpus.
    """
    word = F.col("word")
    test = (word != "") & is_countable(word) if checked else word != ""
    return top.select(F.when(test, word).alias("word")).where(word.isNotNull())


def centres(lines: DataFrame, top: DataFrame, distance: int, line: str = "line") -> DataFrame:
    """Occurrences of listed words as `w1` with the `following` words in reach."""
    if distance < 1:
        raise ValueError("distance must be at least 1")
    others = [name for name in lines.columns if name != line]
    in_order = lines.select(*others, words(F.col(line)).alias("_words"))
    placed = in_order.select(*others, "_words", F.posexplode_outer("_words").alias("pos", "w1"))
    # Cutting the window before the join costs nothing when the list is broadcast
    # (it is evaluated for the rows that stay) and keeps whole lines out of the
    # shuffle when the list is too large for that.
    reach = placed.select(*others, "pos", "w1", F.slice("_words", F.col("pos") + 2, distance).alias("following"))
    found = reach.join(listed_words(top).withColumnRenamed("word", "w1"), "w1", "left_semi")
    return found.select(*others, "pos", "w1", "following")


def neighbour_pairs(lines: DataFrame, top: DataFrame, distance: int = 1, line: str = "line") -> DataFrame:
    """One row per pair occurrence; columns other than the line stay."""
    others = [name for name in lines.columns if name != line]
    reached = centres(lines, top, distance, line).select(*others, "w1", F.explode_outer("following").alias("w2"))
    return reached.join(listed_words(top).withColumnRenamed("word", "w2"), "w2", "left_semi").select(
        *others, "w1", "w2"
    )


def pair_counts(lines: DataFrame, top: DataFrame, distance: int = 1, line: str = "line") -> DataFrame:
    """`w1, w2, n`: the co-occurrence matrix as rows."""
    reached = centres(lines.select(line), top, distance, line).select("w1", F.explode_outer("following").alias("w2"))
    counts = reached.groupBy("w1", "w2").agg(F.count("*").alias("n"))
    return counts.join(listed_words(top).withColumnRenamed("word", "w2"), "w2", "left_semi").select("w1", "w2", "n")


def countable_listed(top: Sequence[str], checked: bool = True) -> list[str]:
    """`listed_words` of a list in code."""
    return sorted({w for w in top if w and (not checked or re.fullmatch(r"(?![ivx]+$)[a-z]{3,}", w))})


def line_pairs(lines: DataFrame, top: Sequence[str], distance: int, line: str = "line", checked: bool = True) -> DataFrame:
    """Each line with `centre_words` and its `pair_counts`, counted inside the row.

    A line is one row, so its counts need no shuffle. `pair_counts` is an array
    of (item: (w1, w2), n) in key order. The list is a sequence: each task has it as one
    hash set, made once. `checked` is about w2; w1 always has to
    count.
    """
    if distance < 1:
        raise ValueError("distance must be at least 1")
    others = [name for name in lines.columns if name != line]

    centre_list, neighbour_list = countable_listed(top), countable_listed(top, checked)
    placed = lines.select(*others, F.col(line).alias("_line"))
    no_pairs = F.array().cast("array<struct<w1:string,w2:string>>")

    def pairs_of(in_line: Column, firsts: Column, seconds: Column) -> Column:
        def following(w1: Column, i: Column) -> Column:
            reach = F.filter(F.slice(in_line, i + 2, distance), lambda w: F.array_contains(seconds, w))
            return F.transform(reach, lambda w2: F.struct(w1.alias("w1"), w2.alias("w2")))

        per_word = F.transform(
            in_line, lambda w, i: F.when(F.array_contains(firsts, w), following(w, i)).otherwise(no_pairs)
        )
        return F.flatten(per_word)

    def counted(in_line: Column) -> Column:
        # The few listed words the line has are what each word is then looked up in.
        firsts = F.array_distinct(F.filter(in_line, lambda w: w.isin(centre_list)))
        seconds = F.array_distinct(F.filter(in_line, lambda w: w.isin(neighbour_list)))
        return bind(
            F.struct(firsts.alias("firsts"), seconds.alias("seconds")),
            lambda present: F.struct(
                present["firsts"].alias("centre_words"),
                count_equal(pairs_of(in_line, present["firsts"], present["seconds"])).alias("pair_counts"),
            ),
        )

    return placed.select(*others, bind(words(F.col("_line")), counted).alias("_counted")).select(
        *others, "_counted.centre_words", "_counted.pair_counts"
    )


def pair_counts_by_line(lines: DataFrame, top: Sequence[str], distance: int = 1, line: str = "line") -> DataFrame:
    """Pair counts of every single line: the other columns, `w1, w2, n`. No shuffle."""
    others = [name for name in lines.columns if name != line]
    counted = line_pairs(lines, top, distance, line)
    rows = counted.select(*others, F.inline_outer("pair_counts")).where(F.col("n").isNotNull())
    return rows.select(*others, "item.w1", "item.w2", "n")


def roll_up_pairs(partial: DataFrame) -> DataFrame:
    """Add up partial pair counts, such as those of single lines."""
    return partial.groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def pair_counts_by_window(
    lines: DataFrame, top: DataFrame, distance: int = 1, key: tuple[str, ...] = ("doc_id", "line_no"), line: str = "line"
) -> DataFrame:
    """`pair_counts` by a look-ahead window over the listed words of each line.

    The frame is a range of positions, so only listed words are shuffled and the
    gaps between them still count. Needs columns that identify a line.
    """
    placed = positioned_words(lines.select(*key, line), line=line)
    found = placed.join(listed_words(top), "word", "left_semi")
    ahead = Window.partitionBy(*key).orderBy("pos").rangeBetween(1, distance)
    reached = found.select(F.col("word").alias("w1"), F.collect_list("word").over(ahead).alias("_following"))
    pairs = reached.select("w1", F.explode_outer("_following").alias("w2")).where(F.col("w2").isNotNull())
    return pairs.groupBy("w1", "w2").agg(F.count("*").alias("n"))
