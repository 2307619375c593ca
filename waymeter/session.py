"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Of tables that jobs and streams keep for themselves: a third smaller than with the default of Spark.
PACKED = {"compression": "zstd"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def local_session(cores: int | str = "*", app: str = "waymeter", **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster spark-submit makes it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark removes them once their plans are collected."""
    gc.collect()
    for _ in range(2):
        # what the first round finds unreachable may have held on to more
        spark.sparkContext._jvm.System.gc()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder under the shared checkpoint folder.

    The folder comes from spark.checkpoint.dir, which on a cluster every executor
    reaches. Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="waymeter-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
