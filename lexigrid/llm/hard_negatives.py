"""Hard negatives: for an anchor and each of its nearest rows of the same label, the most similar rows of other labels
whose score stands in a band below the positive's.

All rows are kept in buckets of similar length, each with a sorted list per coordinate. For an anchor and the
least score that still counts, a bucket whose longest vector cannot reach it is passed over. In the others that score
is an angle, which bounds every coordinate of a vector that counts. The lists of the anchor's focus coordinates (its
largest ones) are cut to these ranges and intersected, and only what is left is scored, exactly. Each task
keeps the best of every anchor, so the score that counts rises as it goes on.

Anchors are a query set: they go to the tasks in blocks of a fixed largest size, each block over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Sent, scratch, stage

BUCKET_ROWS = 1024
BUFFER_BYTES = 32 << 20  # of rows that a task sorts by length before it cuts buckets; of anchors in a block
GROUP = 256  # anchors that are looked up together
SLACK = 1e-9  # of angles and lengths, so that rounding never loses a row
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Whether the vector is known and all its components are finite numbers."""
    huge = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge)), F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as long (the nearest one beyond its range)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; shorter vectors are filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `a` with all of `b`, exact; beyond 64 bits the nearest such number."""
    top = max(1, a.shape[1]) * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if top < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if top < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


class Bucket:
    """Rows of similar length: ids, labels, vectors, and per coordinate the sorted list of the normalised ones."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        lengths = np.linalg.norm(vectors.astype(float), axis=1)
        self.longest, self.shortest = float(lengths.max()), float(lengths.min())
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")  # a column is a coordinate's list
        self.values = np.take_along_axis(unit, self.order, axis=0)
        self.places = np.empty_like(self.order)
        np.put_along_axis(self.places, self.order, np.arange(len(ids))[:, None], axis=0)


class Anchors:
    """A block of anchors, with what the search needs to know of each."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, focus: int = 4):
        self.rows, self.labels, self.vectors = rows, labels, vectors
        self.lengths = np.linalg.norm(vectors.astype(float), axis=1)
        self.unit = vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :focus]


def cap(cosine: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinate of unit vectors within the angle arccos(least) of a unit vector that has `cosine` there."""
    inner, angle = np.arccos(np.clip(cosine, -1, 1)), np.arccos(np.clip(least, -1, 1)) + 1e-7
    low = np.where(inner + angle >= np.pi, -1.0, np.cos(np.minimum(np.pi, inner + angle)))
    high = np.where(inner <= angle, 1.0, np.cos(np.maximum(0, inner - angle)))
    return low - SLACK, high + SLACK


def candidates(bucket: Bucket, anchors: Anchors, which: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in `which`, row of the bucket) whose score may be from `least` to `most` (each an array over `which`)."""
    lengths, n = anchors.lengths[which], len(bucket.ids)
    # The ends of 64 bits stand for all that lies beyond.
    empty, least, most = least > most, np.where(least > LEAST, least, -np.inf), np.where(most < MOST, most, np.inf)
    reach = lengths * bucket.longest
    alive = np.flatnonzero((least <= reach * (1 + SLACK)) & (most >= -reach * (1 + SLACK)) & ~empty)
    if not len(alive):
        return alive, alive
    which, least, most, lengths, reach = which[alive], least[alive], most[alive], lengths[alive], reach[alive]
    with np.errstate(divide="ignore", invalid="ignore"):
        # The cosine that counts: the longest vector needs the least, and of an upper bound the shortest allows the most.
        least_cos = np.where(least > 0, least / reach, least / (lengths * bucket.shortest))
        most_cos = np.where(most < 0, most / reach, most / (lengths * bucket.shortest))
    least_cos, most_cos = np.nan_to_num(least_cos, nan=-1.0), np.nan_to_num(most_cos, nan=1.0)
    zero = (bucket.shortest == 0) | (lengths == 0)  # a vector without length has no angle
    first = np.zeros((len(which), anchors.focus.shape[1]), np.int64)
    end = np.full_like(first, n)
    for k in range(first.shape[1]):
        of = anchors.focus[which, k]
        cosine = anchors.unit[which, of]
        low, high = cap(cosine, least_cos)
        low2, high2 = cap(-cosine, -most_cos)
        low, high = np.maximum(low, low2), np.minimum(high, high2)
        low, high = np.where(zero, -np.inf, low), np.where(zero, np.inf, high)
        for f in np.unique(of):
            mine = of == f
            first[mine, k] = np.searchsorted(bucket.values[:, f], low[mine], "left")
            end[mine, k] = np.searchsorted(bucket.values[:, f], high[mine], "right")
    sizes = np.maximum(end - first, 0)
    best = sizes.argmin(axis=1)
    every = np.arange(len(which))
    size = sizes[every, best]
    of_pair = np.repeat(every, size)
    start = np.cumsum(size) - size
    in_list = np.arange(len(of_pair)) - start[of_pair] + first[every, best][of_pair]
    row = bucket.order[in_list, anchors.focus[which, best][of_pair]]
    for k in range(first.shape[1]):
        place = bucket.places[row, anchors.focus[which, k][of_pair]]
        held = (place >= first[of_pair, k]) & (place < end[of_pair, k])
        of_pair, row = of_pair[held], row[held]
    return alive[of_pair], row


def scores(bucket: Bucket, anchors: Anchors, which: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Exact scores of pairs (anchor, row of the bucket); where they are many, from whole products."""
    some, place = np.unique(which, return_inverse=True)
    if 8 * len(row) >= len(some) * len(bucket.ids):
        return products(anchors.vectors[some], bucket.vectors)[place, row]
    out = np.empty(len(row), np.int64)
    for k, first in zip(range(len(some)), np.searchsorted(place, np.arange(len(some))), strict=True):
        end = np.searchsorted(place, k, "right")
        out[first:end] = products(anchors.vectors[some[k]][None], bucket.vectors[row[first:end]])[0]
    return out


class Best:
    """The `k` best (score, then id, null last) of each group seen so far."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.least = np.full(groups, LEAST)  # what counts from now on
        self.held = [np.empty(0, np.int64) for _ in range(4)]  # group, score, id, whether the id is null

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids, unnamed = (np.concatenate(x) for x in zip(self.held, (group, score, ids, unnamed), strict=True))
        at = np.lexsort((ids, unnamed, -score, group))
        group = group[at]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        at, last = at[rank < self.k], at[rank == self.k - 1]
        self.held = [group[rank < self.k], score[at], ids[at], unnamed[at]]
        self.least[group[rank == self.k - 1]] = score[last]


def merged_ranks(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The tasks' best, ranked over all tasks; each task sends `k` rows of a group at most."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class HardNegatives:
    """Hard negatives of some rows of `rows` (id, label, vector of integers, anchor: whether it is one).

    A row's score is its inner product with the anchor, exact (shorter vectors count as filled up with zeros, and scores beyond
    64 bits as the nearest such number); higher scores come first, equal ones by smaller id, null ids last. An anchor's positives are
    its `positives` best other rows of its label, and a positive's negatives the `negatives` best rows of other labels with
    low * positive_score <= 100 * score <= high * positive_score. Rows with a null label or vector, or a null component, take no part.
    Rows that repeat an id, or are equal, are rows of their own, anchors too. Whole-number labels are compared as
    they are, others by a 64-bit hash. Anchors go to the tasks `block` at a time, or fewer where vectors are long. Empty tables and tables without anchors give no rows; other columns play no part.
    """

    def __init__(
        self, rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = 8192
    ):
        self.spark, self.work = rows.sparkSession, scratch(rows.sparkSession, "negatives")
        self.positives, self.negatives, self.low, self.high = positives, negatives, low, high
        whole = rows.schema["label"].dataType.typeName() in ("byte", "short", "integer", "long")
        label = F.col("label").cast("long") if whole else F.xxhash64(F.col("label").cast("string"))
        known = F.col("label").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
        taken = rows.where(known).select(
            F.monotonically_increasing_id().alias("row"), F.col("id").cast("long"), label.alias("label"),
            F.col("vector").cast("array<bigint>").alias("vector"), F.coalesce(F.col("anchor"), F.lit(False)).alias("anchor"),
        )
        taken = stage(taken, f"{self.work}/rows")
        n, width = taken.agg(F.count_if("anchor"), F.max(F.size("vector"))).first()
        self.width = max(width or 0, 1)
        self.buckets = stage(self._buckets(taken), f"{self.work}/buckets")
        found = []
        blocks = -(-n // max(1, min(block, BUFFER_BYTES // (8 * self.width))))
        for b in range(blocks):
            own = taken.where("anchor").where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)
            found.append(self._block(own.select("row", "id", "label", "vector").toArrow(), b))
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        self.found = found[0] if found else self.spark.createDataFrame([], schema)
        for more in found[1:]:
            self.found = self.found.unionByName(more)

    def _buckets(self, taken: DataFrame) -> DataFrame:
        """Rows in buckets: number, row, id, label, vector, place; the longest vectors of a buffer come first."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def cut(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                table = pa.Table.from_batches(tables).combine_chunks()
                lengths = np.linalg.norm(matrix(table["vector"], width).astype(float), axis=1)
                table = table.take(pa.array(np.argsort(-lengths, kind="stable")))
                for start in range(0, len(table), BUCKET_ROWS):
                    part = table.slice(start, BUCKET_ROWS)
                    ends = pa.array([0, len(part)], pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays(c.chunks)) for c in part.columns]
                    yield pa.RecordBatch.from_arrays(lists, part.column_names)

            for batch in batches:
                held.append(batch)
                size += batch.num_rows * max(1, width) * 8
                if size >= BUFFER_BYTES:
                    yield from cut(held)
                    held, size = [], 0
            if size:
                yield from cut(held)

        schema = "row array<bigint>, id array<bigint>, label array<bigint>, vector array<array<bigint>>"
        return taken.select("row", "id", "label", "vector").mapInArrow(run, schema)

    def _search(self, block: Anchors, same_label: bool, bands: np.ndarray, k: int) -> DataFrame:
        """anchor (row), band, id, score: each task's `k` best of every anchor and band.

        `bands` has a lower and an upper score of each anchor and band (lower > upper: none).
        """
        sent, width = Sent(self.spark, (block, bands)), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, limits = sent.value
            n, per = limits.shape[:2]
            groups = [np.arange(start, min(start + GROUP, n)) for start in range(0, n, GROUP)]
            best = [Best(len(which) * per, k) for which in groups]
            for batch in batches:
                for i in range(batch.num_rows):
                    rows, ids, labels, vectors = (batch.column(c)[i].values for c in range(4))
                    named = ids.fill_null(0).to_numpy(zero_copy_only=False)
                    unnamed = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                    bucket = Bucket(rows.to_numpy(), named, labels.to_numpy(), matrix(vectors, width))
                    for which, kept in zip(groups, best, strict=True):
                        low, high = limits[which, :, 0], limits[which, :, 1]
                        low = np.where(low > high, MOST, np.maximum(low, kept.least.reshape(-1, per)))
                        at, row = candidates(bucket, anchors, which, low.min(axis=1), high.max(axis=1))
                        held = (anchors.labels[which[at]] == bucket.labels[row]) == same_label
                        held &= anchors.rows[which[at]] != bucket.rows[row]
                        at, row = at[held], row[held]
                        score = scores(bucket, anchors, which[at], row)
                        pair, band = np.nonzero((score[:, None] >= low[at]) & (score[:, None] <= high[at]))
                        row = row[pair]
                        kept.add(at[pair] * per + band, score[pair], bucket.ids[row], unnamed[row])
            for which, kept in zip(groups, best, strict=True):
                group, score, ids, unnamed = kept.held
                arrays = [
                    pa.array(anchors.rows[which[group // per]]), pa.array((group % per).astype(np.int32)),
                    pa.array(ids, pa.int64(), mask=unnamed.astype(bool)), pa.array(score),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "band", "id", "score"])

        return self.buckets.mapInArrow(run, "anchor long, band int, id long, score long")

    def _block(self, own: pa.Table, b: int) -> DataFrame:
        """The result for one block of anchors."""
        anchors = Anchors(own["row"].to_numpy(), own["label"].to_numpy(), matrix(own["vector"], self.width))
        free = np.array([LEAST, MOST])
        near = self._search(anchors, True, np.broadcast_to(free, (len(own), 1, 2)), self.positives)
        near = stage(merged_ranks(near, ["anchor"], self.positives).select("anchor", "rank", "id", "score"), f"{self.work}/positives-{b}")
        place = {row: i for i, row in enumerate(anchors.rows.tolist())}
        bands = np.empty((len(own), self.positives, 2), np.int64)
        bands[:] = [MOST, LEAST]
        for row, rank, _, score in near.collect():  # `positives` rows an anchor of the block
            limits = -(-self.low * score // 100), self.high * score // 100
            bands[place[row], rank - 1] = [max(LEAST, min(MOST, x)) for x in limits]
        far = merged_ranks(self._search(anchors, False, bands, self.negatives), ["anchor", "band"], self.negatives)
        names = near.select(
            "anchor", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        ids = self.spark.createDataFrame(own.select(["row", "id"])).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
        out = far.join(names, ["anchor", "band"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        )
        return stage(out, f"{self.work}/negatives-{b}")
