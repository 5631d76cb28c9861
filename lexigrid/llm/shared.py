"""What several operators need: shared folders, text rules, bounded membership filters."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is. Pure ASCII takes the faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that no model learns from (null ids never belong to it)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


LOCAL: dict[str, tempfile.TemporaryDirectory] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share.

    Where spark.checkpoint.dir is unset, a local session gets a temporary folder, which goes when the process ends; any other
    session is refused, since its executors would not see the driver's disk. Every operator starts here,
    so this also lowers Spark's default of 10,000 rows a batch for Python, which is far too much
    memory where a row is a whole document; any other value is left as it is.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in LOCAL:
            LOCAL[application] = tempfile.TemporaryDirectory(prefix="lexigrid-", ignore_cleanup_errors=True)
        shared = LOCAL[application].name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Writes `df` to a shared folder and reads it back: its lineage ends there.

    The shuffle files of this one job go when it has ended, not when the driver collects its garbage; until
    then lost executors are made up for as ever, and afterwards the written table is all that is read.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *paths: str) -> None:
    """Deletes staged tables that nothing will read any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that a worker holds less at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """One part of a record batch in, at most one batch out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = make(batch)
            if made is not None and made.num_rows:
                yield made

    return df.mapInArrow(run, schema)


class Sent:
    """An object of this package, of bounded size, broadcast to the tasks.

    It travels with its class, and a worker process that runs several tasks loads it once.
    """

    def __init__(self, spark: SparkSession, held: object):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(held))

    @property
    def value(self):
        if not hasattr(self.packed, "loaded"):
            self.packed.loaded = cloudpickle.loads(self.packed.value)
        return self.packed.loaded


class MaybeIn:
    """A bitmap over 16-byte (or longer) hashes: "no" is certain, "yes" has to be checked.

    It gets about 16 bits a hash, 2**max_log bits (16 MiB by default) at most, so it may be sent
    to every task. When full it says "yes" more often, which costs work and changes no result.
    """

    def __init__(self, hashes: DataFrame, column: str, max_log: int = 27):
        n = hashes.count()
        self.mask = (1 << min(max_log, max(15, int(n * 16).bit_length()))) - 1
        head = F.conv(F.hex(F.substring(column, 1, 4)), 16, 10).cast("long").bitwiseAND(self.mask)
        chunks = (
            hashes.select(head.alias("p"))
            .groupBy(F.shiftright("p", 15).alias("chunk"))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(32767)).alias("bits"))
            .collect()
        )
        self.bits = np.zeros((self.mask + 1) // 8, np.uint8)
        for chunk, bits in chunks:
            self.bits[chunk * 4096 : (chunk + 1) * 4096] = np.frombuffer(bits, np.uint8)

    def __call__(self, hashes: list[bytes]) -> np.ndarray:
        if not hashes:
            return np.zeros(0, bool)
        p = np.frombuffer(b"".join(h[:4] for h in hashes), ">u4").astype(np.int64) & self.mask
        return (self.bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
