"""Benchmark decontamination: windows of benchmark words, searched in every training text.

The hash set of the benchmark's windows is sent to the tasks in blocks of a fixed largest size; each
block scans all documents. A task hashes a document's words once, rolls window hashes over them,
and compares every hit word by word before it counts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import MaybeIn, Sent, map_batches, scratch, stage, texts

# A-Z to a-z; every other ASCII character but a-z and 0-9 separates words.
WORD_BYTES = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)
) + bytes(range(128, 256))
FACTOR = 0x9E3779B97F4A7C15


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive words."""
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out *= np.uint64(FACTOR)
        out += hashes[k : k + len(out)]
    return out ^ (out >> np.uint64(29))


class Block:
    """Some of the benchmark's windows: which hashes may be one, and which items hold it."""

    def __init__(self, pairs: list[tuple[bytes, int, str]]):
        self.items: dict[bytes, list[str]] = {}
        sizes: dict[int, list[int]] = {}
        for window, size, item in pairs:
            if window not in self.items:
                hashed = window_hashes(word_hashes(window.split(b" ")), size)
                sizes.setdefault(size, []).append(int(hashed[0]))
            self.items.setdefault(window, []).append(item)
        self.log = max(16, min(24, (16 * len(self.items)).bit_length()))
        self.maybe = {}
        for size, hashes in sizes.items():
            self.maybe[size] = np.zeros(1 << self.log, bool)
            self.maybe[size][np.array(hashes, np.uint64) >> np.uint64(64 - self.log)] = True

    def search(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges (end exclusive) of the occurring windows, and their items."""
        spans, items, hashes = [], set(), word_hashes(found)
        for size, maybe in self.maybe.items():
            if len(found) < size:
                continue
            at = np.flatnonzero(maybe[window_hashes(hashes, size) >> np.uint64(64 - self.log)])
            for i in at.tolist():
                held = self.items.get(b" ".join(found[i : i + size]))
                if held is not None:
                    spans.append((i, i + size))
                    items.update(held)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the ranges and what stands between them."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_BYTES))]
    out, last = [], 0
    for first, end in spans:
        out.append(text[last : at[first][0]])
        last = at[end - 1][1]
    return b"".join(out) + text[last:]


SPANS = "array<struct<first: int, end: int>>"
SPAN_LIST = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def as_structs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"first": first, "end": end} for first, end in spans]


def block_of(pairs: DataFrame) -> Block:
    return Block([(bytes(w), s, i) for w, s, i in pairs.collect()])


def gathered(hits: list[DataFrame]) -> DataFrame:
    """hash, spans, items: what the blocks found in a text, put together."""
    every = hits[0]
    for more in hits[1:]:
        every = every.unionAll(more)
    held = [F.flatten(F.collect_list(name)).alias(name) for name in ("spans", "items")]  # one entry a block
    one = every.groupBy("hash").agg(*held)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [as_structs(merged([(s["first"], s["end"]) for s in own])) for own in batch.column(1).to_pylist()]
        items = [sorted(set(own)) for own in batch.column(2).to_pylist()]
        arrays = [batch.column(0), pa.array(spans, SPAN_LIST), pa.array(items, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, ["hash", "spans", "items"])

    return map_batches(one, make, f"hash binary, spans {SPANS}, items array<string>")


class Decontamination:
    """Benchmark passages (item_id, text) in `docs` (doc_id, text, anything else).

    Words are runs of a-z (A-Z lower-cased), 0-9 and any non-ASCII characters. A window is `size`
    consecutive words of an item; an item of fewer words, but not none, is one window. Every word of
    a document inside an occurrence of a window is hit. Null and empty texts have no words; an item
    without words never occurs; a null item_id is named ''. Items may repeat. Empty tables
    give empty results (an empty benchmark: no hits). Other columns play no part.

    Whole texts are searched, a long one in time that grows with its words. Windows are sent to the tasks `max_windows` at a
    time (about 100 MB at most with ordinary words); a larger benchmark is searched in several such blocks, each over all
    documents, of which only the hits are written.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, size: int = 10, max_windows: int = 1 << 20):
        self.docs = docs

        def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                found = words(text)
                for i in range(max(1, len(found) - size + 1) if found else 0):
                    part = found[i : i + size]
                    out.append((b" ".join(part), len(part), item))
            window, sizes, items = zip(*out, strict=True) if out else ((), (), ())
            arrays = [pa.array(window, pa.binary()), pa.array(sizes, pa.int32()), pa.array(items, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["window", "size", "item"])

        items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string"))
        pairs = map_batches(items, windows, "window binary, size int, item string").distinct()
        work = scratch(docs.sparkSession, "windows")
        pairs = stage(pairs, f"{work}/pairs")
        blocks = max(1, -(-pairs.count() // max_windows))
        if blocks == 1:
            self.found = self._scanned(Sent(docs.sparkSession, block_of(pairs)))
            return
        hits = []
        for b in range(blocks):
            block = Sent(docs.sparkSession, block_of(pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b)))
            hits.append(stage(self._hits(block), f"{work}/hits-{b}"))
        self.found = self._joined(stage(gathered(hits), f"{work}/hits"))

    def _schema(self) -> StructType:
        """That of the documents with what was found."""
        found = StructType.fromDDL(f"_llm_spans {SPANS}, _llm_items array<string>, _llm_words long")
        return StructType([*self.docs.schema.fields, *found.fields])

    def _scanned(self, sent: Sent) -> DataFrame:
        """The documents with _llm_spans, _llm_items and _llm_words, from one scan."""
        n, at = len(self.docs.columns), self.docs.columns.index("text")
        schema = self._schema()

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            of_texts = [words(t) for t in texts(batch.column(at))]
            found = [sent.value.search(w) for w in of_texts]
            added = [
                pa.array([as_structs(merged(spans)) for spans, _ in found], SPAN_LIST),
                pa.array([sorted(items) for _, items in found], pa.list_(pa.string())), pa.array([len(w) for w in of_texts], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays([*batch.columns[:n], *added], schema.names)

        return map_batches(self.docs, make, schema)

    def _hits(self, sent: Sent) -> DataFrame:
        """hash, spans, items of each text with a window of one block. What is found depends on the text only."""
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, spans, items = [], [], []
            for text in texts(batch.column(0)):
                own, held = sent.value.search(words(text))
                if own:
                    keys.append(xxhash.xxh3_128_digest(text)), spans.append(as_structs(merged(own))), items.append(sorted(held))
            arrays = [pa.array(keys, pa.binary()), pa.array(spans, SPAN_LIST), pa.array(items, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(arrays, ["hash", "spans", "items"])

        rows = self.docs.select(F.col("text").cast("string"))
        return map_batches(rows, make, f"hash binary, spans {SPANS}, items array<string>").groupBy("hash").agg(
            F.first("spans").alias("spans"), F.first("items").alias("items")
        )

    def _joined(self, hits: DataFrame) -> DataFrame:
        """The documents with what all blocks found; those that certainly have no hit are not shuffled."""
        n, at = len(self.docs.columns), self.docs.columns.index("text")
        maybe = Sent(self.docs.sparkSession, MaybeIn(hits, "hash"))
        schema = self._schema()

        def make(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
            found = texts(batch.column(at))
            keys = [xxhash.xxh3_128_digest(t) for t in found]
            mask = maybe.value(keys) == wanted
            added = [
                pa.array([[]] * len(found), SPAN_LIST), pa.array([[]] * len(found), pa.list_(pa.string())),
                pa.array([len(words(t)) for t in found], pa.int64()), *([pa.array(keys, pa.binary())] if wanted else []),
            ]
            names = [*schema.names, *(["_llm_hash"] if wanted else [])]
            return pa.RecordBatch.from_arrays([*batch.columns[:n], *added], names).filter(pa.array(mask))

        clean = map_batches(self.docs, lambda batch: make(batch, False), schema)
        wide = StructType(list(schema.fields)).add("_llm_hash", "binary")
        unsure = map_batches(self.docs, lambda batch: make(batch, True), wide)
        both = unsure.join(hits.withColumnsRenamed({"hash": "_llm_hash", "spans": "_llm_s", "items": "_llm_i"}), "_llm_hash", "left")
        both = both.withColumns({"_llm_spans": F.coalesce("_llm_s", "_llm_spans"), "_llm_items": F.coalesce("_llm_i", "_llm_items")})
        return clean.unionByName(both.select(*schema.names))

    def report(self) -> DataFrame:
        """One row per document: doc_id, n_words, n_hit, n_items, items (sorted), contaminated."""
        hit = F.aggregate("_llm_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
        return self.found.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("_llm_words").alias("n_words"), hit.alias("n_hit"),
            F.size("_llm_items").cast("long").alias("n_items"), F.col("_llm_items").alias("items"),
            (F.size("_llm_spans") > 0).alias("contaminated"),
        )

    def clean_rows(self) -> DataFrame:
        """The documents without any hit, with all their columns."""
        return self.found.where(F.size("_llm_spans") == 0).select(*self.docs.columns)

    def without_spans(self) -> DataFrame:
        """All documents, the hit passages cut out of their texts."""
        n, at = len(self.docs.columns), self.docs.columns.index("text")

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(n).to_pylist(), strict=True):
                ranges = [(s["first"], s["end"]) for s in spans]
                out.append(cut(text.encode(), ranges).decode() if ranges else text)
            columns = list(batch.columns[:n])
            columns[at] = pa.array(out, batch.schema.field(at).type)
            return pa.RecordBatch.from_arrays(columns, batch.schema.names[:n])

        return map_batches(self.found.select(*self.docs.columns, "_llm_spans"), make, self.docs.schema)
