"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Scan tasks take up to 256 MB, many small files packed together or part of a
# large one: counts are added up inside a task first, so larger tasks send fewer
# rows to the shuffle. Small inputs are still split over all cores. Adaptive
# execution merges small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}



def build_session(app_name: str = "lexigrid", master: str | None = None, **settings: str) -> SparkSession:
    """A session with `settings`, and with `SETTINGS` where the user has set nothing else.

    What spark-submit or the cluster's defaults say stays as it is.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if key not in settings and not given.contains(key):
            spark.conf.set(key, value)
    return spark
