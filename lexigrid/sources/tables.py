"""Parquet tables as corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *columns: str, partitions: int | None = None) -> DataFrame:
    """The named columns of a parquet table.

    With `partitions` the rows are dealt out evenly over so many, which is a shuffle of all of them;
    it is for a small table whose files hold one row group each. None never shuffles.
    """
    table = spark.read.parquet(path).select(*columns)
    return table if partitions is None else table.repartition(partitions)
