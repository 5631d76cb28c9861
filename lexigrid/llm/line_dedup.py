"""Dropping lines that many documents share.

Lines are exploded and hashed, each hash is counted over documents, lines over the threshold go,
and what is left of a document is put together by position.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import MaybeIn, map_batches, scratch, stage, texts

BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The normalised line, None if it is too short to count."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def positions_by_hash(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """128-bit hash of each line that counts -> its positions in the text."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        key = line_key(line, min_chars)
        if key is not None:
            found.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
    return found


class LineDedup:
    """Shared lines of `docs` (doc_id, text, anything else).

    A text is split at \\n (null or empty: one empty line). A line's key has white space
    [\\x20\\x09-\\x0D] stripped at both ends and A-Z lower-cased. Keys of `min_chars` code points
    or more that stand in `min_docs` documents or more lose all their lines except in the
    document with the largest doc_id among them, which keeps every one. Rows with one doc_id,
    null included, are one document when counted and each keep or lose their own lines. An empty table gives
    empty results. Whole texts are split; a very long one, or one of very many lines, is one row's work like any other. Other
    columns play no part. Keys are compared by a 128-bit hash.

    A hash's count is a sum that starts in each task, so a line of every third document is one
    row a task. Documents without a line over the threshold are never shuffled.
    """

    def __init__(self, docs: DataFrame, min_chars: int = 20, min_docs: int = 3):
        self.docs, self.min_chars, self.min_docs = docs, min_chars, min_docs
        self.work = scratch(docs.sparkSession, "lines")
        rows = docs.select(F.col("text").cast("string"))

        def hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [h for t in texts(batch.column(0)) for h in positions_by_hash(t, min_chars)]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["hash"])

        often = map_batches(rows, hashes, "hash binary").groupBy("hash").count()
        often = stage(often.where(F.col("count") >= min_docs).select("hash"), f"{self.work}/often")
        self.maybe = MaybeIn(often, "hash")
        self.affected = stage(
            self._rows(affected=True).withColumn("_llm_row", F.monotonically_increasing_id()),
            f"{self.work}/affected",
        )
        self.dropped = stage(self._dropped(), f"{self.work}/dropped")

    def _rows(self, affected: bool) -> DataFrame:
        """The documents with a line that may be over the threshold, or all others."""
        maybe, min_chars, at = self.maybe, self.min_chars, self.docs.columns.index("text")

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            mask = [bool(maybe([*positions_by_hash(t, min_chars)]).any()) for t in texts(batch.column(at))]
            return batch.filter(pa.array(np.array(mask, bool) == affected))

        return map_batches(self.docs, make, self.docs.schema)

    def _dropped(self) -> DataFrame:
        """row, positions of the lines that go."""
        maybe, min_chars = self.maybe, self.min_chars

        def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, ids, hashes, positions = [], [], [], []
            for row, doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True
            ):
                found = positions_by_hash(text, min_chars)
                for (h, at), yes in zip(found.items(), maybe([*found]), strict=True):
                    if yes:
                        rows.append(row), ids.append(doc_id), hashes.append(h), positions.append(at)
            arrays = [
                pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(hashes, pa.binary()),
                pa.array(positions, pa.list_(pa.int32())),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "hash", "positions"])

        own = self.affected.select("_llm_row", F.col("doc_id").cast("long"), F.col("text").cast("string"))
        found = map_batches(own, lines, "row long, doc_id long, hash binary, positions array<int>")
        found = stage(found, f"{self.work}/lines")
        shared = (
            found.select("hash", "doc_id").distinct()
            .groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
            .where(F.col("n") >= self.min_docs)
        )
        # Written first, so that the join has plain shuffles on both sides and hot lines can be split.
        shared = stage(shared, f"{self.work}/shared")
        gone = found.join(shared, "hash").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        return gone.groupBy("row").agg(F.flatten(F.collect_list("positions")).alias("positions"))

    def _cleaned(self) -> DataFrame:
        """Affected rows with the positions that go as the last column."""
        by_row = self.dropped.select(F.col("row").alias("_llm_row"), F.col("positions").alias("_llm_gone"))
        # The lists grow with the corpus: joined by shuffling at every size.
        return self.affected.join(by_row.hint("merge"), "_llm_row", "left").drop("_llm_row")

    def summary(self) -> DataFrame:
        """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
        schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            all_texts = texts(batch.column(1))
            gone = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(all_texts)
            kept = [without(t, g or ()) for t, g in zip(all_texts, gone, strict=True)]
            arrays = [
                batch.column(0), pa.array([t.count(b"\n") + 1 for t in all_texts], pa.int64()),
                pa.array([len(g or ()) for g in gone], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

        doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
        plain = map_batches(self._rows(affected=False).select(doc_id, text), make, schema)
        return plain.unionByName(map_batches(self._cleaned().select(doc_id, text, "_llm_gone"), make, schema))

    def cleaned(self) -> DataFrame:
        """All rows with all columns, the lines that go taken out of their texts (a null text stays null)."""
        names, at = self.docs.columns, self.docs.columns.index("text")

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            gone = batch.column(len(names)).to_pylist()
            kept = [without(t, g or ()).decode() for t, g in zip(texts(batch.column(at)), gone, strict=True)]
            return batch.select(names).set_column(at, names[at], pa.array(kept, batch.schema.field(at).type))

        changed = map_batches(self._cleaned().select(*names, "_llm_gone"), make, self.docs.schema)
        return self._rows(affected=False).unionByName(changed)


def without(text: bytes, gone: tuple[int, ...] | list[int]) -> bytes:
    """The text's other lines by position."""
    if not gone:
        return text
    out = set(gone)
    return b"\n".join(line for i, line in enumerate(text.split(b"\n")) if i not in out)
