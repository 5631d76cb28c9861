"""Mixing sources to target weights, to the word.

Documents get hash-random keys and are range-sorted by them within their source. Distributed prefix
sums of their word counts tell how many words stand before each, and the mix takes a source's documents in this order up
to its budget: the last one in part, so that the budget is met exactly. A budget over the source's size
takes whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import in_order, sums_before
from .shared import scratch, stage

WORD = r"[^\x20\x09-\x0D]+"


def exact(number: int) -> Column:
    """An integer of any size that may occur, for comparisons of products."""
    return F.lit(str(number)).cast("decimal(38,0)")


class Mixture:
    """A mix of `docs` (doc_id, text, source, anything else) by source.

    A document's size is its number of words `[^\\x20\\x09-\\x0D]+` (null: 0). Sources in code point order,
    null (a source of its own) last, weigh `weights`, repeating. They share `percent` percent of all sizes by weight;
    a target stops at `most` times its source's size, and the excess is shared anew by weight until no target is
    above. A source's budget is its target rounded down, and exactly as many words are taken.

    Documents of size 0 are never taken. Null and equal doc_ids are documents of their own; rows with equal doc_id,
    source and size are interchangeable, and which of them the budget ends in doesn't follow from the table. All else does, so
    reruns agree. An empty table gives no rows. Very long texts are cut at a word like any others. Other columns play no part in the plan. With `copies` the
    texts are written once, for `rows`.
    """

    def __init__(
        self, docs: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2, seed: int = 11,
        copies: bool = False,
    ):
        self.names, self.weights, self.percent, self.most = docs.columns, list(weights), percent, most
        self.work = scratch(docs.sparkSession, "mix")
        self.docs = docs.withColumn("_llm_row", F.monotonically_increasing_id())
        if copies:
            self.docs = stage(self.docs, f"{self.work}/docs")
        doc_id, source = F.col("doc_id"), F.col("source").cast("string")
        key = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 16)
        rows = self.docs.select(
            doc_id, F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("source"),  # null sorts last
            key.alias("key"), F.col("_llm_row").alias("row"),
        )
        keys = [F.col(c) for c in ("source", "key", "doc_id", "size", "row")]
        self.ordered = in_order(stage(rows, f"{self.work}/sizes"), keys, f"{self.work}/ordered")
        self.sources = stage(self._targets(), f"{self.work}/sources")

    def _targets(self) -> DataFrame:
        """source, source_size, target, budget.

        Shares are fractions of integers: of 100 * the words left to share, the weights of the sources that
        share them. Each round caps at least one source more; the table of sources stays distributed.
        """
        sizes = self.ordered.groupBy("source").agg(F.sum("size").alias("source_size"))
        ranked = in_order(sizes, [F.col("source")], f"{self.work}/source-sizes").withColumn("_all", F.lit(0))
        ranked = sums_before(ranked, ["_all"], F.lit(1), "rank")
        weight = F.element_at(F.array(*map(F.lit, self.weights)), (F.col("rank") % len(self.weights) + 1).cast("int"))
        sources = stage(ranked.select("source", "source_size", weight.cast("long").alias("weight")), f"{self.work}/weights")
        cap, big = F.col("source_size") * self.most, F.col("weight").cast("decimal(18,0)")
        capped, known, words, left = F.lit(False), -1, 0, 0
        while True:
            n, gone, left, total = sources.agg(
                F.count_if(capped), F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)),
                F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0)),
            ).first()
            words = self.percent * total - 100 * gone
            if n == known or not left:
                break
            known = n
            capped = cap.cast("decimal(20,0)") * exact(100 * left).cast("decimal(18,0)") < big * exact(words).cast("decimal(20,0)")
        share = big * exact(words).cast("decimal(20,0)")
        whole = exact(100 * max(1, left)).cast("decimal(18,0)")
        return sources.select(
            "source", "source_size",
            F.when(capped, cap.cast("double")).otherwise(share.cast("double") / whole.cast("double")).alias("target"),
            F.when(capped, cap).otherwise(F.floor(share / whole).cast("long")).alias("budget"),
        )

    def plan(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken, epochs (whole ones), part (words of the next), row."""
        placed = sums_before(self.ordered, ["source"], F.col("size"), "before", facts=self.sources)
        epochs = F.when(F.col("source_size") > 0, F.expr("budget DIV source_size")).otherwise(0)
        rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
        part = F.greatest(F.lit(0), F.least(rest, F.col("size")))
        return placed.withColumn("epochs", epochs).withColumn("part", part).select(
            "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
            "epochs", "part", "row",
        )

    def rows(self) -> DataFrame:
        """The mix: rows of `docs` (made with `copies`), each as often as it is taken, with _llm_epoch from 0.

        A document taken in part ends after its last word that counts.
        """
        taken = self.plan().where("taken > 0").select(F.col("row").alias("_llm_row"), F.col("epochs").alias("_llm_epochs"), F.col("part").alias("_llm_part"), F.col("size").alias("_llm_size"))
        copies = F.sequence(F.lit(0), (F.col("_llm_epochs") - F.when(F.col("_llm_part") == 0, 1).otherwise(0)).cast("int"))
        each = self.docs.join(taken, "_llm_row").withColumn("_llm_epoch", F.explode(copies))
        words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
        cut = F.array_join(F.slice(words, F.lit(1), F.col("_llm_part").cast("int")), "")
        ends = (F.col("_llm_epoch") == F.col("_llm_epochs")) & (F.col("_llm_part") < F.col("_llm_size"))
        return each.withColumn("text", F.when(ends, cut).otherwise(F.col("text"))).select(*self.names, "_llm_epoch")
