"""Byte-level BPE: text to token ids and back.

A pre-token that is in the vocabulary as a whole is found by a minimal perfect hash. The others are
merged: a heap holds the ranks of neighbouring parts, and the parts form a linked list over the
pre-token's bytes, so a pre-token of n bytes takes n log n steps.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Sent, map_batches, slices

hashed = xxhash.xxh3_64_intdigest


class PerfectHash:
    """Minimal perfect hash: n keys to the slots 0 to n - 1, no two keys to one.

    Keys fall into buckets; a bucket of several keys stores a seed under which they all hit free
    slots, a bucket of one key stores its slot (as -1 - slot).
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // 3)
        by_bucket: dict[int, list[bytes]] = {}
        for key in keys:
            by_bucket.setdefault(hashed(key) % self.buckets, []).append(key)
        self.stored, taken = [0] * self.buckets, bytearray(self.n)
        for bucket, own in sorted(by_bucket.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(own) == 1:
                break
            seed = 1
            while True:
                slots = {hashed(key, seed) % self.n for key in own}
                if len(slots) == len(own) and not any(taken[s] for s in slots):
                    break
                seed += 1
            self.stored[bucket] = seed
            for s in slots:
                taken[s] = 1
        free = iter([s for s in range(self.n) if not taken[s]])
        for bucket, own in by_bucket.items():
            if len(own) == 1:
                self.stored[bucket] = -1 - next(free)

    def slot(self, key: bytes) -> int:
        """The key's slot; of anything else, any slot."""
        stored = self.stored[hashed(key) % self.buckets]
        return -1 - stored if stored < 0 else hashed(key, stored) % self.n


class Tokenizer:
    """Ranks (token bytes -> id), with every single byte among them, and the pre-token pattern.

    `cache` holds the ids of pre-tokens of up to 64 characters met in this task. When it has `cache_size` it becomes the
    `older` one, from which what is met again is taken over, so frequent pre-tokens are never merged anew.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_size: int = 150_000):
        self.ranks, self.pattern, self.cache_size = ranks, regex.compile(pattern), cache_size
        self.hash = PerfectHash([*ranks])
        self.keys: list[bytes] = [b""] * len(ranks)
        self.packed: list[bytes] = [b""] * len(ranks)
        for token, rank in ranks.items():
            slot = self.hash.slot(token)
            self.keys[slot], self.packed[slot] = token, rank.to_bytes(4, "little")
        self.by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.by_id[rank] = token
        self.forget()

    def forget(self) -> None:
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}, "older": {}}

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one pre-token, packed as little-endian 32-bit integers."""
        slot = self.hash.slot(piece)
        return self.packed[slot] if self.keys[slot] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> bytes:
        """Merges the neighbours of least rank, leftmost first, until none is in the vocabulary."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here
        alive = bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not alive[i] or middle >= n or end[middle] != stop or middle == stop:
                continue  # a part has changed since
            alive[middle] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]].to_bytes(4, "little"))
            i = end[i]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed; special tokens are ordinary text."""
        out = []
        for piece in self.pattern.findall(text):
            ids = self.cache.get(piece)
            out.append(self._not_cached(piece) if ids is None else ids)
        return b"".join(out)

    def _not_cached(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode_piece(piece.encode())
        if len(piece) <= 64:
            if len(self.cache) >= self.cache_size:
                self.older, self.cache = self.cache, {}
            self.cache[piece] = ids
        return ids

    def decode(self, packed: bytes) -> bytes:
        return joined(packed, self.by_id)


def joined(packed: bytes, by_id: list[bytes]) -> bytes:
    """The bytes that packed ids stand for."""
    return b"".join(map(by_id.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def load_tokenizer(path: str, pattern: str) -> Tokenizer:
    """Reads a rank file: base64 token and rank a line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Tokenizer({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def encode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id and `ids`, a text's token ids as little-endian unsigned 32-bit integers.

    Null counts as empty and has no ids. Rows are independent: repeated rows give repeated results,
    an empty table none. Other columns play no part. A text is one row's work, in its length times
    the logarithm of its longest pre-token.
    """
    sent = Sent(docs.sparkSession, tokenizer)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [sent.value.encode(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, make, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """`encoded` with `decoded`, the bytes its ids stand for."""
    sent = Sent(encoded.sparkSession, tokenizer.by_id)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoded = [joined(x, sent.value) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
        )

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256.

    Same rows as decode(encode(docs)), but ids and decoded bytes never leave the worker that made them.
    """
    sent = Sent(docs.sparkSession, tokenizer)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        try:
            for batch in slices(batches):
                counts, of_ids, of_decoded = [], [], []
                for text in batch.column(1):
                    ids = own.encode(text.as_py() or "")
                    counts.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names)
        finally:
            own.forget()  # the worker process lives on

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
