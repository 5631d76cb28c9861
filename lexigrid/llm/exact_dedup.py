"""Exact deduplication as a stateful stream.

Each arriving text leaves a digest; a streaming aggregation keeps, per digest and without expiry,
the identifier and locator of the row that stays. Its state is on disk (RocksDB) and survives in
the stream's checkpoint. A digest met more than once is a hit, and hits are compared byte by
byte with the row that stays; what differs in spite of an equal digest forms groups of its own.
A digest met very often is compared in parts, each with the content of the row that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import UPPER, MaybeIn, map_batches, scratch, stage, texts

# State on disk; each batch saves what it changed, small stores don't reserve disk they won't fill, and
# all stores of an executor share one bounded piece of memory. A store is closed when its batch is saved: an executor
# has as many open as it runs tasks, not one for each partition of the shuffle, and none after the stream.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


def arrivals(docs: DataFrame, digest: Callable[[bytes], bytes] = sha256) -> DataFrame:
    """doc_id, locator (the file the row came from) and digest of each row's normalised text."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [digest(t.lower()) for t in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "locator", "digest"]
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.input_file_name(), F.col("text").cast("string"))
    return map_batches(rows, make, "doc_id long, locator string, digest binary")


def keyed_state(spark: SparkSession, folder: str, work: str, files_per_batch: int = 1000) -> DataFrame:
    """Runs the stream over the arrivals in `folder`: digest, keeper (doc_id, locator), n.

    Every micro-batch reports the keys it changed; the last report of a key is its state. A
    second call with the same `work` goes on where the first ended. The digest is grouped in
    each task before it is shuffled, so a third of all rows with one digest is one row a task.
    """
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        (
            spark.readStream.schema("doc_id long, locator string, digest binary")
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("n"))
            .writeStream.outputMode("update")
            .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{work}/reports/batch={batch}"))
            .option("checkpointLocation", f"{work}/stream")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    schema = "digest binary, keeper struct<doc_id: long, locator: string>, n long, batch int"
    reports = spark.read.schema(schema).parquet(f"{work}/reports")
    return reports.groupBy("digest").agg(
        F.max_by("keeper", "batch").alias("keeper"), F.max_by("n", "batch").alias("n")
    )


PART = 1000


def parts() -> Column:
    """In how many parts the rows of a digest that has been met `n` times are compared."""
    return F.ceil(F.col("n") / PART)


class Dedup:
    """Exact duplicates of `docs` (doc_id, text, anything else).

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts
    are equal to each other. Of equal texts the row with the largest doc_id stays (null is the
    smallest); of rows that share that doc_id, one stays. An empty table gives empty results.
    Other columns play no part, whatever their names.
    """

    def __init__(
        self,
        docs: DataFrame,
        digest: Callable[[bytes], bytes] = sha256,
        files_per_batch: int = 1000,
    ):
        self.docs, self.digest, spark = docs, digest, docs.sparkSession
        work = scratch(spark, "exact")
        self.arrived = stage(arrivals(docs, digest), f"{work}/arrivals")
        if self.arrived.isEmpty():
            self.state = self.arrived.selectExpr("digest", "struct(doc_id, locator) AS keeper", "1L AS n")
        else:
            self.state = stage(keyed_state(spark, f"{work}/arrivals", work, files_per_batch), f"{work}/state")
        self.hits = self.state.where("n > 1")
        self.maybe = MaybeIn(self.hits, "digest")
        # A digest of many rows is dealt in parts of about `PART` rows, as its state counts them. The join is written
        # by itself, so that adaptive execution may split what a digest brings to it.
        known = self.hits.select(F.col("digest").alias("_llm_digest"), F.col("keeper").alias("_llm_keeper"), parts().alias("_llm_parts"))
        rows = self._rows(hits=True).withColumn("_llm_row", F.monotonically_increasing_id()).join(known, "_llm_digest", "left")
        part = F.coalesce(F.pmod(F.xxhash64("_llm_row"), "_llm_parts"), F.lit(0))
        self.candidates = stage(rows.withColumn("_llm_part", part), f"{work}/candidates")
        self.checked = stage(self._checked(), f"{work}/checked")

    def _rows(self, hits: bool) -> DataFrame:
        """The rows whose digest may be a hit, with digest and locator; or all others as they are."""
        digest, maybe, names = self.digest, self.maybe, self.docs.columns
        at = names.index("text")

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [digest(t.lower()) for t in texts(batch.column(at))]
            mask = maybe(found)
            if not hits:
                return batch.select(names).filter(pa.array(~mask))
            return batch.append_column("_llm_digest", pa.array(found, pa.binary())).filter(pa.array(mask))

        fields = self.docs.schema.fields
        schema = type(self.docs.schema)(list(fields))
        if not hits:
            return map_batches(self.docs, make, schema)
        schema = schema.add("_llm_file", "string").add("_llm_digest", "binary")
        return map_batches(self.docs.withColumn("_llm_file", F.input_file_name()), make, schema)

    def _checked(self) -> DataFrame:
        """row, doc_id, keep_id, group_size, kept, digest of each hit, bytes compared."""
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        hit = self.candidates.where("_llm_parts IS NOT NULL").select(
            F.col("_llm_row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("_llm_file").alias("locator"),
            F.col("_llm_digest").alias("digest"), F.col("_llm_part").alias("part"), F.col("_llm_parts").alias("parts"),
            F.col("_llm_keeper").alias("keeper"), F.translate(text, UPPER, UPPER.lower()).alias("content"),
        )
        every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
        kept = (
            hit.where(F.struct("doc_id", "locator").eqNullSafe(F.col("keeper")))
            .groupBy("digest", "parts")
            .agg(F.min("content").alias("kept_content"))
            .select("digest", "kept_content", every_part)
        )
        compared = hit.join(kept, ["digest", "part"]).select(
            "row", "doc_id", "digest", "part", "parts",
            F.when(F.col("content") != F.col("kept_content"), F.col("content")).alias("other"),
        )
        compared = stage(compared, scratch(self.docs.sparkSession, "compared"))
        groups = compared.groupBy("digest", "parts", "other").agg(
            F.max(F.struct("doc_id", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
        ).select("keeper", "group_size", F.col("digest").alias("g_digest"), F.col("other").alias("g_other"), every_part)
        groups = groups.withColumnRenamed("part", "g_part")
        same = (F.col("digest") == F.col("g_digest")) & (F.col("part") == F.col("g_part")) & F.col("other").eqNullSafe(F.col("g_other"))
        return compared.join(groups, same).select(
            "row", "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size",
            (F.col("row") == F.col("keeper.row")).alias("kept"), "digest",
        )

    def decisions(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, digest."""
        single = self.arrived.join(self.hits.select("digest"), "digest", "left_anti").select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), "digest",
        )
        return single.unionByName(self.checked.drop("row"))

    def kept_rows(self) -> DataFrame:
        """The rows that stay, with all their columns; rows without a hit are never shuffled."""
        dropped = self.checked.where("NOT kept").select(F.col("row").alias("_llm_row"))
        of_hits = self.candidates.join(dropped, "_llm_row", "left_anti").select(*self.docs.columns)
        return self._rows(hits=False).unionByName(of_hits)
