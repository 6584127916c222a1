"""A session for local runs and tests. On a cluster the session is given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sitelens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SITELENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Settings that queries rely on when keys are skewed: joins are re-planned from measured sizes,
#: and a partition far larger than the others is split even if that costs another shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Adaptive execution merges shuffle partitions up to this size. Keys compress well, so a partition of
#: Spark's default 64 MB holds millions of rows; one task sorts and aggregates them several times
#: over and would need gigabytes. Small partitions bound that memory, however large the tables.
PARTITION_SETTING, PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20


def prepare(spark: SparkSession) -> None:
    """Apply the skew settings to a session, and the size of partitions unless it is smaller there."""
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    parse = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if parse(spark.conf.get(PARTITION_SETTING, "64m")) > PARTITION_BYTES:
        spark.conf.set(PARTITION_SETTING, f"{PARTITION_BYTES}b")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables; else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/sitelens").rstrip("/")
