"""Similarity self-join of documents by the Jaccard similarity of their word n-grams, exact.

N-grams have one global order, rare ones first. Two sets that are similar enough share an n-gram
among the first few of each, so only those are listed by n-gram. The order is also cut into
fragments: a pair's overlap is counted in each fragment by itself and summed over them.

Documents with one set are one node. In a list of nodes that share an n-gram first only pairs with the
least node are compared; nodes that turn out linked form components, and then only pairs of different
components are left. So a group of similar documents costs about its size, not its square, and
no link between different components is missed.

Nodes of a long list whose components differ meet by a second common n-gram and by size, so that a list of
unlike nodes doesn't cost its square either.

Before its overlap is counted a pair must pass the parities of its sets: bit i tells whether an odd number
of n-grams hashes to i, so two sets differ in as many n-grams as their parities do in bits, at least.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import MaybeIn, Sent, map_batches, release, scratch, slices, stage, texts

FACTOR = 0x9E3779B97F4A7C15
PARITY_BITS, WIDE_BITS = 512, 4096
NARROW_WORDS = PARITY_BITS // 64
WIDE_FROM = 560  # sets of so many n-grams have wide parities as well
LONG_LIST = 8  # lists of so many nodes can have more pairs than entries: they check parities inside the join
MIX = np.uint64(0xFF51AFD7ED558CCD)
# The five primes of xxh64, and the bytes between words.
XXH = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
TOGETHER = 1 << 17  # bytes of text that are hashed at once


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """xxh64 of each word of a text, A-Z lower-cased, and where in the text it starts; whole arrays at a time."""
    data = np.frombuffer(b" " + text.lower() + b" " * 8, np.uint8)
    blank = BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    out = lengths.astype(np.uint64) + XXH[4]
    eights, fours = (np.lib.stride_tricks.sliding_window_view(data, k) for k in (8, 4))
    for k in range(3):
        at = np.flatnonzero(lengths >= 8 * (k + 1))
        lane = eights[starts[at] + 8 * k].view("<u8")[:, 0]
        out[at] = turned(out[at] ^ (turned(lane * XXH[1], 31) * XXH[0]), 27) * XXH[0] + XXH[3]
    rest = starts + (lengths & ~7)
    at = np.flatnonzero(lengths & 4)
    lane = fours[rest[at]].view("<u4")[:, 0].astype(np.uint64)
    out[at] = turned(out[at] ^ (lane * XXH[0]), 23) * XXH[1] + XXH[2]
    rest[at] += 4
    for k in range(3):
        at = np.flatnonzero((lengths & 3) > k)
        out[at] = turned(out[at] ^ (data[rest[at] + k].astype(np.uint64) * XXH[4]), 11) * XXH[0]
    out = (out ^ (out >> np.uint64(33))) * XXH[1]
    out = (out ^ (out >> np.uint64(29))) * XXH[2]
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(lengths >= 32).tolist():  # xxh64 has another way for these
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out, starts - 1


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of `width` words."""
    out = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for k in range(width):
        out *= np.uint64(FACTOR)
        out += words[k : k + len(out)]
    out ^= out >> np.uint64(33)
    out *= MIX
    out ^= out >> np.uint64(33)
    return out


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The distinct ones, sorted; sorts in place."""
    hashes.sort()
    new = hashes[1:] != hashes[:-1]
    return hashes.copy() if new.all() else hashes[np.concatenate(([True], new))]


def shingle_sets(contents: Iterable[bytes], size: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the distinct `size`-word n-grams of each text, sorted; of fewer words, the whole as one.

    Texts are hashed together, as many as `TOGETHER` bytes take and one at least; n-grams across texts are left out.
    """
    group, held = [], 0
    for text in contents:
        if group and held + len(text) > TOGETHER:
            yield from _sets_of_group(group, size)
            group, held = [], 0
        group.append(text)
        held += len(text) + 1
    yield from _sets_of_group(group, size)


def _sets_of_group(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    hashes, starts = word_hashes(b" ".join(group))
    grams = gram_hashes(hashes, size)
    after = np.cumsum([len(t) + 1 for t in group])
    begin = 0
    for end in np.searchsorted(starts, after).tolist():
        n = end - begin
        if n >= size:
            yield distinct(grams[begin : end - size + 1])
        else:
            yield gram_hashes(hashes[begin:end], n) if n else np.empty(0, np.uint64)
        begin = end


def shingles(text: bytes, size: int) -> np.ndarray:
    """The set of one text."""
    return next(shingle_sets([text], size))


def node_of(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def halves(nodes: list[bytes]) -> np.ndarray:
    """The two halves of 128-bit hashes."""
    return np.frombuffer(b"".join(nodes), "<i8").reshape(-1, 2)


def short_ids(nodes: list[bytes], turn: int) -> np.ndarray:
    """64 bits of 128-bit hashes: one half, and the other turned by `turn` bits."""
    one, two = halves(nodes).view(np.uint64).T
    turned = (two << np.uint64(turn)) | (two >> np.uint64(64 - turn)) if turn else two
    return (one ^ turned).view(np.int64)


def short_id(one: Column, two: Column, turn: int) -> Column:
    """`short_ids` in Spark."""
    turned = F.shiftleft(two, turn).bitwiseOR(F.shiftrightunsigned(two, 64 - turn)) if turn else two
    return one.bitwiseXOR(turned)


def unique_turn(hashes: DataFrame) -> int:
    """The first turn with which all of `hashes` (one, two; distinct) have short ids of their own."""
    for turn in range(64):
        if hashes.groupBy(short_id(F.col("one"), F.col("two"), turn)).count().where("count > 1").isEmpty():
            return turn
    raise ValueError("no short ids are unique")  # not to be expected: 64 tries on hashes of 128 bits


def parity_of(found: np.ndarray, bits: int) -> list[int]:
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def parities_of(found: np.ndarray) -> dict[str, list[int] | None]:
    wide = parity_of(found, WIDE_BITS) if len(found) >= WIDE_FROM else None
    return {"narrow": parity_of(found, PARITY_BITS), "wide": wide}


class Order:
    """The global order, from document frequencies counted in 2**log buckets of n-gram hashes.

    A bucket's count is at least that of each n-gram in it, so frequent n-grams come last. How well the
    order fits decides about work only, never about results. Its size is fixed: 2 MiB.
    """

    def __init__(self, counts: np.ndarray, fragments: int):
        self.shift = np.uint64(64 - int(len(counts)).bit_length() + 1)
        by_count = np.lexsort((np.arange(len(counts)), counts))
        self.rank = np.empty(len(counts), np.int32)
        self.rank[by_count] = np.arange(len(counts), dtype=np.int32)
        before = np.cumsum(counts[by_count]) - counts[by_count]
        self.fragment = np.empty(len(counts), np.int16)
        self.fragment[by_count] = before * fragments // max(1, counts.sum())
        # An n-gram of an outstandingly full bucket may be a group of its own: it is dealt in parts.
        full = max(1000.0, 8 * float(counts.mean()))
        self.parts = np.maximum(1, np.ceil(counts / full)).astype(np.int64)

    def sorted(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams in the global order, and their buckets."""
        bucket = (found >> self.shift).astype(np.int64)
        at = np.lexsort((found, self.rank[bucket]))
        return found[at], bucket[at]


def added_up(parts: DataFrame) -> DataFrame:
    """chunk, counts: sums of the tasks' counts (chunk, salt, counts), first within a salt, then over all."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        first = group.slice(0, 1)
        return pa.table({"chunk": first.column("chunk"), "salt": first.column("salt"), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, salt int, counts binary"
    once = parts.groupBy("chunk", "salt").applyInArrow(add, schema)
    return once.groupBy("chunk").applyInArrow(add, schema).select("chunk", "counts")


class JaccardJoin:
    """Links between `docs` (doc_id, text, anything else): Jaccard similarity of `percent` or more.

    Words are runs of anything but [\\x20\\x09-\\x0D], A-Z lower-cased. A document's set holds its
    distinct n-grams of `size` words; with fewer words, the whole sequence as one; null, empty and
    blank texts have empty sets, which are linked with nothing. Equal sets are linked. Repeated rows are
    documents like any others; null doc_ids are never the smallest of a component unless there
    is no other. An empty table gives no rows. Very long texts are sets like any others, held one at a time. Other
    columns play no part. N-grams are compared by 64-bit and sets by 128-bit hashes; sets travel as 64 bits of theirs, chosen
    so that no two share them.
    """

    def __init__(
        self, docs: DataFrame, size: int = 5, percent: int = 80, bucket_log: int = 18, fragments: int = 8, long_list: int = 64
    ):
        self.docs, self.size, self.percent, self.long_list = docs, size, percent, long_list
        self.spark, self.bucket_log = docs.sparkSession, bucket_log
        self.work = scratch(self.spark, "jaccard")
        profiled = stage(self._profiled(), f"{self.work}/profiled")
        counts = np.zeros(1 << bucket_log, np.int64)
        parts = profiled.where("chunk IS NOT NULL").select("chunk", F.col("n").alias("salt"), "counts")
        for chunk, own in added_up(parts).collect():  # one row a chunk, 2 MiB in all
            own = np.frombuffer(own, np.int64)
            counts[chunk * len(own) : (chunk + 1) * len(own)] = own
        self.order = Sent(self.spark, Order(counts, fragments))
        profiled = profiled.where("chunk IS NULL")
        hashed = profiled.where("n > 0").groupBy("one", "two").agg(F.min("doc_id").alias("doc_id"), F.first("parity").alias("parity"))
        hashed = stage(hashed, f"{self.work}/hashed")
        self.turn = unique_turn(hashed.select("one", "two"))
        node = short_id(F.col("one"), F.col("two"), self.turn).alias("node")
        self.documents = stage(profiled.select("doc_id", "n", node), f"{self.work}/documents")
        self.nodes = hashed.select(node, "doc_id", "parity")
        release(self.spark, f"{self.work}/profiled")
        entries = stage(self._listed(), f"{self.work}/listed")
        self.listed = entries.where(F.col("pos") < self._first(F.col("n")))
        first = self._star_pairs()
        self.labels = stage(components(self._similar(first, "first")), f"{self.work}/labels-first")
        mixed = self._mixed(self.listed.drop("least"), "first")
        second = self._pairs_to_largest(mixed, first)
        self._add_links(second, "second")
        left = self._mixed(mixed.select("gram", "node", "n", "pos"), "second")
        release(self.spark, f"{self.work}/mixed-first")
        self._add_links(self._pairs_left(left, entries, first.unionByName(second)), "left")
        release(self.spark, *(f"{self.work}/{name}" for name in ("listed", "pairs-first", "pairs-second", "pairs-left", "mixed-second", "labels-first", "labels-second")))

    def _first(self, n: Column) -> Column:
        """How many n-grams of a set of n are listed: similar sets have one in common among these, and two among one more."""
        return n - F.ceil(n.cast("long") * self.percent / 100).cast("int") + 1

    def _profiled(self) -> DataFrame:
        """Of each document doc_id, n (set size), one and two (set hash) and parity; of each task its bucket counts.

        The counts come in chunks: chunk, n (a salt from 0 to 63) and counts (packed integers).
        """
        size, log = self.size, self.bucket_log
        chunk_log = max(0, log - 10)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, names = np.zeros(1 << log, np.int64), ["doc_id", "n", "one", "two", "parity", "chunk", "counts"]
            parity = pa.struct([("narrow", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])
            salt = 0
            for batch in slices(batches):
                sets = [*shingle_sets(texts(batch.column(1)), size)]
                if not sets:
                    continue
                all_found = np.concatenate(sets)
                counts += np.bincount((all_found >> np.uint64(64 - log)).astype(np.int64), minlength=1 << log)
                salt = (salt + int(all_found[0] if len(all_found) else 0)) % 64
                n, nodes = [len(s) for s in sets], halves([node_of(s) for s in sets])
                arrays = [
                    batch.column(0), pa.array(n, pa.int32()), pa.array(nodes[:, 0]), pa.array(nodes[:, 1]),
                    pa.array([parities_of(s) for s in sets], parity), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)
            if counts.any():
                rows = counts.reshape(1 << chunk_log, -1)
                unknown = pa.nulls(len(rows), pa.int64())
                arrays = [
                    unknown, pa.array([salt] * len(rows), pa.int32()), unknown, unknown, pa.nulls(len(rows), parity),
                    pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

        rows = self.docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        schema = "doc_id long, n int, one long, two long, parity struct<narrow: array<long>, wide: array<long>>, chunk int, counts binary"
        return rows.mapInArrow(run, schema)

    def _listed(self) -> DataFrame:
        """gram, node, n, pos: the first n-grams of each set and one more, where different nodes share one.

        least is the least node of the list with its n and pos; null for that node itself. It is among the
        first n-grams of its own set. What is shuffled of an entry is four numbers.
        """
        size, percent, sent, turn = self.size, self.percent, self.order, self.turn

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            order, seen = sent.value, set()  # of a task's own documents
            for batch in slices(batches):
                grams, nodes, places, parts = [], [], [], []
                for found in shingle_sets(texts(batch.column(0)), size):
                    node = node_of(found)
                    if not len(found) or node in seen:
                        continue
                    seen.add(node)
                    n = len(found)
                    first = min(n, n - -(-percent * n // 100) + 2)
                    found, bucket = order.sorted(found)
                    grams.append(found[:first].view(np.int64))
                    dealt = order.parts[bucket[:first]]  # -1: not dealt in parts
                    parts.append(np.where(dealt > 1, int.from_bytes(node[:4]) % dealt, -1))
                    nodes.append(np.repeat(short_ids([node], turn), first))
                    places.append(n << 32 | np.arange(first, dtype=np.int64))
                if nodes:
                    arrays = [pa.array(np.concatenate(x)) for x in (parts, grams, nodes, places)]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "gram", "node", "place"])

        rows = self.docs.select(F.col("text").cast("string"))
        entries = rows.mapInArrow(run, "part long, gram long, node long, place long")
        n, pos = F.shiftright("place", 32).cast("int"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
        # Copies of a node from several tasks follow each other; nodes that are there by their one n-gram more come
        # last, and the first of the others is the list's least.
        one = Window.partitionBy("gram", "part").orderBy("extra", "node")
        whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        entries = entries.withColumn("extra", pos >= self._first(n)).withColumns({
            "before": F.lag("node").over(one), "least": F.first(F.struct("node", "place", "extra")).over(whole),
            "high": F.last("node").over(whole),
        })
        # An n-gram dealt in parts may have one node in a part and others elsewhere.
        entries = entries.where("(least.node <> high OR part >= 0) AND (before IS NULL OR before <> node)")
        own = F.col("least.place")
        least = F.struct(
            F.col("least.node").alias("node"), F.shiftright(own, 32).cast("int").alias("n"), own.bitwiseAND(0xFFFFFFFF).cast("int").alias("pos")
        )
        met = (F.col("node") != F.col("least.node")) & ~F.col("extra") & ~F.col("least.extra")
        return entries.select("gram", "node", n.alias("n"), pos.alias("pos"), F.when(met, least).alias("least"))

    def _may_link(self, n1: Column, pos1: Column, n2: Column, pos2: Column) -> Column:
        """Whether sets whose first common n-gram stands at these positions can overlap enough."""
        return (100 + self.percent) * F.least(n1 - pos1, n2 - pos2) >= self.percent * (n1 + n2)

    def _parities_allow(self, n1: Column, parity1: Column, n2: Column, parity2: Column) -> Column:
        """Whether sets with these parities can be similar enough; unknown parities allow it."""
        most = (100 - self.percent) * (n1 + n2)
        narrow = sum(F.bit_count(parity1["narrow"][i].bitwiseXOR(parity2["narrow"][i])) for i in range(PARITY_BITS // 64))
        wide = F.aggregate(
            F.zip_with(parity1["wide"], parity2["wide"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x
        )
        fits = [F.coalesce((100 + self.percent) * bits <= most, F.lit(True)) for bits in (narrow, wide)]
        return fits[0] & fits[1]

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) that pass their parities."""
        known = self.nodes.select("node", "parity")
        both = pairs.hint("merge").join(known.withColumnsRenamed({"node": "a", "parity": "sa"}), "a")
        both = both.hint("merge").join(known.withColumnsRenamed({"node": "b", "parity": "sb"}), "b")
        allowed = self._parities_allow(F.col("na"), F.col("sa"), F.col("nb"), F.col("sb"))
        return both.where(allowed).select("a", "b", "na", "nb")

    def _star_pairs(self) -> DataFrame:
        """a < b: each listed node with the least node of its list (or of its part, if it is dealt in parts)."""
        joined = self.listed.select(
            F.col("least.node").alias("a"), F.col("node").alias("b"), F.col("least.n").alias("na"), F.col("n").alias("nb"),
            F.col("least.pos").alias("pa"), F.col("pos").alias("pb"),
        )
        may = joined.where(self._may_link(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb")))
        pairs = may.select("a", "b", "na", "nb").distinct()
        return stage(self._checked(pairs), f"{self.work}/pairs-first")

    def _add_links(self, pairs: DataFrame, name: str) -> None:
        """Labels with the links among the pairs."""
        known = self.labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        self.labels = stage(components(known.unionAll(self._similar(pairs, name))), f"{self.work}/labels-{name}")

    def _mixed(self, entries: DataFrame, name: str) -> DataFrame:
        """Of lists with several components the entries, each with its component and the list's largest one.

        Entries of long lists have their parities too.
        """
        own = entries.join(self.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        own = stage(own, f"{self.work}/labelled-{name}")
        sizes = own.groupBy("gram", "label").count()
        most = sizes.groupBy("gram").agg(
            F.max(F.struct("count", "label"))["label"].alias("most"), F.count(F.lit(1)).alias("labels"),
            F.sum("count").alias("members"),
        ).where("labels > 1").drop("labels")
        mixed = own.join(most, "gram")
        known = self.nodes.select("node", "parity")
        none = F.lit(None).cast(known.schema["parity"].dataType)
        mixed = mixed.where(F.col("members") < LONG_LIST).withColumn("parity", none).unionByName(
            mixed.where(F.col("members") >= LONG_LIST).join(known, "node")
        )
        return stage(mixed, f"{self.work}/mixed-{name}")

    def _pairs_to_largest(self, mixed: DataFrame, done: DataFrame) -> DataFrame:
        """a < b: each entry outside its list's largest component with the first-standing node inside."""
        first = mixed.where("label = most").groupBy("gram").agg(F.min(F.struct("pos", "node", "n")).alias("x"))
        met = mixed.where("label <> most").join(first, "gram").where(
            self._may_link(F.col("n"), F.col("pos"), F.col("x.n"), F.col("x.pos"))
        )
        return self._new_pairs(met, (F.col("node"), F.col("n")), (F.col("x.node"), F.col("x.n")), done, "second")

    def _new_pairs(
        self, met: DataFrame, one: tuple[Column, Column], two: tuple[Column, Column], done: DataFrame, name: str
    ) -> DataFrame:
        """Distinct pairs (a < b, with their sizes) that were not compared yet and pass their parities."""
        swap = one[0] > two[0]
        pairs = met.select(
            F.least(one[0], two[0]).alias("a"), F.greatest(one[0], two[0]).alias("b"),
            F.when(swap, two[1]).otherwise(one[1]).alias("na"), F.when(swap, one[1]).otherwise(two[1]).alias("nb"),
        ).distinct()
        pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        return stage(self._checked(pairs), f"{self.work}/pairs-{name}")

    def _pairs_left(self, mixed: DataFrame, entries: DataFrame, done: DataFrame) -> DataFrame:
        """a < b: listed nodes of different components, but those compared already.

        Nodes of a long list meet by their second common n-gram as well, and by size: similar sets have two n-grams in common
        among the first few and one more of each, and the smaller has `percent` percent of the larger one's size. So many
        unlike nodes that share an n-gram don't all meet.
        """
        names = ["gram", "node", "n", "pos", "label", "most", "parity"]
        # Up to 50 percent, sets with one n-gram in common can be similar.
        long_list = self.long_list if self.percent > 50 else 1 << 62
        short = mixed.where(F.col("members") < long_list).select(*names)
        met = self._met(short, short, ["gram"])
        # Comparing wide parities is no generated code, so pairs of large sets have a join of their own.
        large = short.where(F.col("n") >= WIDE_FROM)
        met = met.unionByName(self._met(large, large, ["gram"], wide=True))
        more = entries.select("node", F.col("gram").alias("second"), F.col("pos").alias("pos2"))
        long = mixed.where(F.col("members") >= long_list).select(*names).join(more, "node").where("pos2 > pos")
        # The wide parities, which travel badly, are looked at when pairs are distinct.
        step = math.log(100 / self.percent + 1e-9) if self.percent < 100 else 1.0
        size = F.floor(F.log(F.col("n")) / step).cast("int")
        # Sizes that may fit are in one step or in neighbouring ones: the larger set goes to both.
        lower = long.withColumns({"step": size, "own": size})
        upper = long.withColumn("own", size).withColumn("step", F.explode(F.array("own", F.col("own") - 1)))
        met = met.unionByName(self._met(lower, upper, ["gram", "second", "step"]))
        return self._new_pairs(met, (F.col("a"), F.col("na")), (F.col("b"), F.col("nb")), done, "left")

    def _narrow_allows(self) -> Column:
        """Whether the narrow parities of a and b, a column a word, allow a link; the first words tell most unlike sets."""
        most = (100 - self.percent) * (F.col("na") + F.col("nb"))
        bits = [F.bit_count(F.col(f"sa{i}").bitwiseXOR(F.col(f"sb{i}"))) for i in range(NARROW_WORDS)]
        fits = [F.coalesce((100 + self.percent) * sum(bits[:k]) <= most, F.lit(True)) for k in (1, 2, 4, NARROW_WORDS)]
        return fits[0] & fits[1] & fits[2] & fits[3]

    def _met(self, ones: DataFrame, others: DataFrame, keys: list[str], wide: bool = False) -> DataFrame:
        """a, na, b, nb: nodes with equal keys, of different components and not both in the list's largest one, that may be similar.

        By a first n-gram alone, pairs of which both have wide parities are found with `wide` and left out without.
        """

        def sided(rows: DataFrame, side: str) -> DataFrame:
            parts = {f"s{side}{i}": F.col("parity")["narrow"][i] for i in range(NARROW_WORDS)}
            if wide:
                parts[f"w{side}"] = F.col("parity")["wide"]
            named = {"node": side, "n": f"n{side}", "pos": f"p{side}", "label": f"l{side}", "pos2": f"q{side}"}
            return rows.withColumns(parts).drop("parity").withColumnsRenamed(named)

        x, y = sided(ones, "a").drop("most", "own"), sided(others, "b")
        # Two of one table meet twice, and one of them counts; two sizes of neighbouring steps meet once.
        twice = F.col("a") < F.col("b")
        if "step" in keys:
            twice = twice | (F.col("own") != F.col("step"))
        may = (
            twice & (F.col("la") != F.col("lb")) & ((F.col("la") != F.col("most")) | (F.col("lb") != F.col("most")))
            & self._may_link(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"))
        )
        if "second" in keys:
            # Where the two n-grams are the first ones in common, the overlap is the first and what stands from the second on.
            may = may & self._may_link(F.col("na"), F.col("qa") - 1, F.col("nb"), F.col("qb") - 1)
        elif not wide:
            may = may & (F.least("na", "nb") < WIDE_FROM)
        may = may & self._narrow_allows()
        if wide:
            differ = F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
            fits = (100 + self.percent) * F.aggregate(differ, F.lit(0), lambda a, x: a + x) <= (100 - self.percent) * (F.col("na") + F.col("nb"))
            may = may & F.coalesce(fits, F.lit(True))
        return x.join(y, keys).where(may).select("a", "na", "b", "nb")

    def _segments(self, needed: DataFrame, name: str) -> DataFrame:
        """node, fragment, grams of the needed nodes, each from one of its documents."""
        ids = needed.join(self.nodes, "node")
        key = F.unhex(F.lpad(F.hex(F.xxhash64("doc_id")), 16, "0"))
        maybe = Sent(self.spark, MaybeIn(stage(ids.select(key.alias("key")), f"{self.work}/keys-{name}"), "key"))
        size, sent, turn = self.size, self.order, self.turn

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            order, maybe_in, seen = sent.value, maybe.value, set()
            for batch in slices(batches):
                batch = batch.filter(pa.array(maybe_in(batch.column(0).to_pylist())))
                nodes, fragments, grams = [], [], []
                for found in shingle_sets(texts(batch.column(1)), size):
                    node = node_of(found)
                    if not len(found) or node in seen:
                        continue
                    seen.add(node)
                    of, short = order.fragment[(found >> order.shift).astype(np.int64)], int(short_ids([node], turn)[0])
                    for f in np.unique(of).tolist():
                        nodes.append(short), fragments.append(f), grams.append(found[of == f].view(np.int64).tolist())
                if nodes:
                    arrays = [pa.array(nodes, pa.int64()), pa.array(fragments, pa.int32()), pa.array(grams, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["node", "fragment", "grams"])

        rows = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        found = rows.select(key, "text").mapInArrow(run, "node long, fragment int, grams array<long>")
        return stage(found.join(needed, "node", "left_semi").dropDuplicates(["node", "fragment"]), f"{self.work}/segments-{name}")

    def _similar(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are links: partial overlaps by fragment, summed."""
        needed = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{self.work}/needed-{name}")
        segments = self._segments(needed, name)
        of_a = segments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga"))
        of_b = segments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb"))
        # Pairs grow with the corpus, so they are joined by shuffling at every size.
        met = pairs.hint("merge").join(of_a, "a").hint("merge").join(of_b, ["b", "fragment"])
        parts = met.select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part"))
        summed = parts.groupBy("a", "b").agg(F.sum("part").alias("o"), F.first("na").alias("na"), F.first("nb").alias("nb"))
        links = summed.where(100 * F.col("o") >= self.percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")
        links = stage(links, f"{self.work}/links-{name}")
        release(self.spark, *(f"{self.work}/{table}-{name}" for table in ("needed", "keys", "segments")))
        return links

    def kept_rows(self) -> DataFrame:
        """One document of each component, with all its columns: the least doc_id's (null is the largest).

        Of rows that share this doc_id the one with the least node stays, and of equal nodes any one. Documents with
        empty sets all stay. Rows that are certainly kept are not shuffled.
        """
        own = F.xxhash64(F.col("doc_id").cast("long"))
        key = F.unhex(F.lpad(F.hex(own), 16, "0"))
        of_component = self.labels.join(self.nodes.select("node"), "node", "right").select("node", F.coalesce("label", "node").alias("label"))
        grouped = self.documents.where("n > 0").join(stage(of_component, scratch(self.spark, "of-component")), "node")
        grouped = grouped.select("doc_id", "node", "label")
        order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
        # Components of one row have nothing to lose; of the others all rows but one go.
        large = grouped.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("keeper")).where("rows > 1")
        large = stage(large, scratch(self.spark, "large"))
        judged = grouped.join(large, "label").select(key.alias("key"), "node", "label", "keeper")
        judged = stage(judged.distinct(), scratch(self.spark, "judged"))
        maybe, size, names, turn = Sent(self.spark, MaybeIn(judged, "key")), self.size, self.docs.columns, self.turn
        at, schema = names.index("text"), self.docs.schema

        def make(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
            mask = maybe.value(batch.column(len(names)).to_pylist())
            batch = batch.filter(pa.array(mask == wanted))
            if not wanted:
                return batch.select(names)
            nodes = [node_of(x) for x in shingle_sets(texts(batch.column(at)), size)]
            return batch.append_column("_llm_node", pa.array(short_ids(nodes, turn) if nodes else [], pa.int64()))

        rows = self.docs.withColumn("_llm_key", key)
        sure = map_batches(rows, lambda batch: make(batch, False), schema)
        wide = type(schema)(list(schema.fields)).add("_llm_key", "binary").add("_llm_node", "long")
        unsure = map_batches(rows, lambda batch: make(batch, True), wide).withColumn("_llm_row", F.monotonically_increasing_id())
        unsure = stage(unsure, scratch(self.spark, "unsure"))
        own = unsure.select("_llm_row", F.col("doc_id").cast("long").alias("doc_id"), F.col("_llm_node").alias("node"))
        own = own.join(judged.select("node", "label", "keeper").distinct(), "node")
        keepers = own.where((F.col("node") == F.col("keeper.node")) & F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")))
        stays = keepers.groupBy("label").agg(F.min("_llm_row").alias("_llm_row")).select("_llm_row")
        gone = own.select("_llm_row").join(stays, "_llm_row", "left_anti")
        return sure.unionByName(unsure.join(gone, "_llm_row", "left_anti").select(*names))

    def groups(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, component_id (its component's least doc_id)."""
        return self._by_document().drop("node")

    def _by_document(self) -> DataFrame:
        labelled = self.nodes.join(self.labels, "node")
        least = labelled.groupBy("label").agg(F.min("doc_id").alias("of_all"))
        of_label = labelled.join(least, "label").select("node", "of_all")
        of_node = self.nodes.join(of_label, "node", "left").select("node", F.coalesce("of_all", "doc_id").alias("component_id"))
        of_node = stage(of_node, scratch(self.spark, "component-ids"))
        full = self.documents.where("n > 0").join(of_node, "node")
        empty = self.documents.where("n = 0").withColumn("component_id", F.col("doc_id"))
        names = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "node"]
        return full.select(*names).unionAll(empty.select(*names))
