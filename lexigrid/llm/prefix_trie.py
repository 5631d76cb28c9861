"""The trie of conversation prefixes: which ones conversations share, and what sharing them saves.

A conversation is a path of nodes from the root; conversations that begin with the same turns share
nodes. Depth is cut into bands of a fixed height. A conversation travels as one short row a band, never whole: ids
of prefixes are hashed inside each band, and the bands' hashes are hashed in bands of their own.

Totals of subtrees are rolled up the same way. Inside a band every node adds its values to its
ancestors of that band only. The roots of the bands form a trie of their own, `height` times less deep, which is rolled
up by the same two steps; their completed totals are then added to the ancestors in the band above. So the
rounds grow with the logarithm of the depth and a node makes `height` rows at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import in_order, sums_before
from .shared import scratch, stage


def short_hash(content: Column) -> Column:
    """The first 16 bytes of the SHA-256."""
    return F.substring(F.unhex(F.sha2(content, 256)), 1, 16)


def turn_items(turns: DataFrame) -> DataFrame:
    """conv_id, pos, item, weight of `turns` (conv_id, turn, role, text, anything else).

    pos is a turn's place in its conversation from 1, by turn (null first); equal turns stand by item, the
    hash of role and text (null counts as empty). weight is the text's number of code points. Rows with a null conv_id take
    no part. Places are distributed prefix sums, so a long conversation is no single group.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    item = short_hash(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), item.alias("item"), F.length(text).cast("long").alias("weight"),
        F.monotonically_increasing_id().alias("row"),
    )
    work = scratch(turns.sparkSession, "turns")
    keys = [F.col(c) for c in ("conv_id", "turn", "item", "row")]
    placed = sums_before(in_order(stage(rows, f"{work}/items"), keys, f"{work}/ordered"), ["conv_id"], F.lit(1), "before")
    return placed.select("conv_id", (F.col("before") + 1).alias("pos"), "item", "weight")


def prefix_bands(items: DataFrame, height: int, work: str) -> DataFrame:
    """conv_id, band, up, ids, weights of `items` (conv_id, pos gapless from 0, item, weight).

    ids are those of the prefixes that end in the band, up is the one that ends the band before (null in the first).
    """
    step = lambda ids, x: F.array_append(ids, short_hash(F.concat(F.coalesce(F.get(ids, F.size(ids) - 1), F.lit(b"")), x["item"])))
    rows = items.groupBy("conv_id", F.expr(f"pos DIV {height}").alias("band")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "item", "weight"))).alias("held")  # `height` at most
    )
    own = F.aggregate("held", F.array().cast("array<binary>"), step)
    rows = stage(rows.select("conv_id", "band", own.alias("own"), F.transform("held", lambda x: x["weight"]).alias("weights")), f"{work}/own")
    full = rows.where(F.size("own") == height)
    if full.isEmpty():
        return rows.select("conv_id", "band", F.lit(None).cast("binary").alias("up"), F.col("own").alias("ids"), "weights")
    ends = full.select("conv_id", F.col("band").alias("pos"), F.element_at("own", -1).alias("item"), F.lit(0).cast("long").alias("weight"))
    known = prefix_bands(ends, height, f"{work}/of-bands").select(
        "conv_id", F.posexplode("ids").alias("at", "id"), "band"
    ).select("conv_id", (F.col("band") * height + F.col("at")).alias("band"), "id")
    last = known.select("conv_id", "band", F.col("id").alias("last"))
    up = known.select("conv_id", (F.col("band") + 1).alias("band"), F.col("id").alias("up"))
    joined = rows.join(up, ["conv_id", "band"], "left").join(last, ["conv_id", "band"], "left")
    ids = F.transform(
        "own",
        lambda x, i: F.when(i == height - 1, F.col("last")).when(F.col("up").isNull(), x).otherwise(short_hash(F.concat("up", x))),
    )
    return stage(joined.select("conv_id", "band", "up", ids.alias("ids"), "weights"), f"{work}/ids")


def rolled_up(paths: DataFrame, values: DataFrame, names: list[str], height: int, work: str) -> DataFrame:
    """node and `names`: sums over the subtree of each node.

    `paths` (conv_id, band, ids) has the nodes of each conversation from depth 0; `values` (conv_id, depth, node, names)
    has every node once, under one conversation that holds it.
    """
    at = (F.col("depth") % height).cast("int").alias("at")
    held = values.groupBy("conv_id", F.expr(f"depth DIV {height}").alias("band")).agg(
        F.array_sort(F.collect_list(F.struct(at, *names))).alias("held")  # `height` at most
    )

    def from_here(name: str, i: Column) -> Column:
        return F.aggregate(F.filter("held", lambda x: x["at"] >= i), F.lit(0).cast("long"), lambda a, x: a + x[name])

    # The nodes of one conversation in one band add up first: one row for each of their ancestors.
    added = F.transform(
        F.sequence(F.lit(0), F.element_at("held", -1)["at"]),
        lambda i: F.struct(F.get("ids", i).alias("node"), *(from_here(n, i).alias(n) for n in names)),
    )
    inside = paths.join(held, ["conv_id", "band"]).select(F.inline(added)).groupBy("node").agg(*(F.sum(n).alias(n) for n in names))
    roots = values.where((F.col("depth") > 0) & (F.col("depth") % height == 0))
    if roots.isEmpty():
        return inside
    inside = stage(inside, f"{work}/inside")
    band = F.col("band")
    root_paths = paths.groupBy("conv_id", F.expr(f"band DIV {height}").alias("above")).agg(
        F.array_sort(F.collect_list(F.struct("band", F.get("ids", F.lit(0)).alias("id")))).alias("held")
    ).select("conv_id", F.col("above").alias("band"), F.transform("held", lambda x: x["id"]).alias("ids"))
    root_values = values.where(F.col("depth") % height == 0).select(
        "conv_id", F.expr(f"depth DIV {height}").alias("depth"), "node"
    ).join(inside, "node")
    totals = stage(rolled_up(root_paths, root_values, names, height, f"{work}/roots"), f"{work}/totals")
    below = roots.select("conv_id", (F.expr(f"depth DIV {height}") - 1).alias("band"), "node").join(totals, "node").drop("node")
    over = paths.join(below, ["conv_id", "band"]).select(F.explode("ids").alias("node"), *names)
    return inside.unionByName(over).groupBy("node").agg(*(F.sum(n).alias(n) for n in names))


class PrefixTrie:
    """The trie of `items` (conv_id, pos gapless from 1, item, weight), as `turn_items` makes them.

    `members` (conv_id, distinct) names all conversations, those without any turn too: they end at
    the root. Nodes are compared by 128-bit hashes of their turns. Equal conversations share all nodes, and a
    conversation may be as long as it likes. Without members there is no node, not even the root.
    """

    def __init__(self, items: DataFrame, members: DataFrame, height: int = 32):
        self.height, self.work = height, scratch(items.sparkSession, "trie")
        start = members.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("item"), F.lit(0).cast("long").alias("weight"))
        known = items.join(members.select("conv_id"), "conv_id", "left_semi").select("conv_id", "pos", "item", "weight")
        self.paths = prefix_bands(start.unionByName(known), height, f"{self.work}/paths")
        each = F.transform("ids", lambda x, i: F.struct(
            x.alias("node"), (F.col("band") * height + i).alias("depth"),
            F.when(i == 0, F.col("up")).otherwise(F.get("ids", i - 1)).alias("parent"), F.get("weights", i).alias("weight"),
        ))
        self.own = stage(
            self.paths.select("conv_id", F.inline(each)).groupBy("node").agg(
                F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
                F.first("weight").alias("weight"), F.count(F.lit(1)).alias("n_convs"),
            ),
            f"{self.work}/nodes",
        )

    def nodes(self) -> DataFrame:
        """node, conv_id (smallest member), depth, parent, parent_conv_id, n_convs, n_children, n_leaves, saved.

        n_leaves and saved are totals of the node's subtree: nodes without children, and the weight that
        members after the first share.
        """
        children = self.own.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
        own = self.own.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        own = stage(own, f"{self.work}/own")
        values = own.select(
            "conv_id", "depth", "node", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("weight")).alias("saved"),
        )
        totals = rolled_up(self.paths.select("conv_id", "band", "ids"), values, ["n_leaves", "saved"], self.height, f"{self.work}/rollup")
        above = own.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        return own.drop("weight").join(totals, "node").join(above, "parent", "left").select(
            "node", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"
        )

    def ends(self) -> DataFrame:
        """node, conv_id: the node in which each conversation ends."""
        last = self.paths.groupBy("conv_id").agg(F.max_by(F.element_at("ids", -1), "band").alias("node"))
        return last.select("node", "conv_id")


def digests(members: DataFrame) -> DataFrame:
    """node, digest of `members` (node, conv_id): SHA-256 of the conv_ids, ascending, comma-joined, as lowercase hex.

    Ids are joined in pieces of 1024 neighbouring ids at most; the pieces of a node go through its digest one by one.
    """
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = members.groupBy("node", F.shiftright("conv_id", 10).alias("piece")).agg(piece.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            nodes, found = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        nodes.append(node), found.append(state.hexdigest())
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found)], ["node", "digest"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "digest"])

    return pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids").mapInArrow(run, "node binary, digest string")
