"""Writing, refreshing and reading mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

TABLES = [
    "metric_catalog", "fact_metric_bucket", "latest_metric_snapshot",
    "driver_location_timeseries", "booking_route_segments",
]
# Columns a table is partitioned by, so that filters on them prune folders.
PARTITIONS = {
    "fact_metric_bucket": ["bucket_granularity", "bucket_date"],
    "driver_location_timeseries": ["event_date"],
    "booking_route_segments": ["event_month"],
}
# The date that folders go by.
DATES = {
    "bucket_date": "CAST(bucket_start AS DATE)",
    "event_date": "CAST(event_time AS DATE)",
    "event_month": "trunc(event_time, 'MM')",
}
# Times of a row whose maxima tell how fresh a table is: event, ingestion.
FRESHNESS = {
    "fact_metric_bucket": ("last_event_at", "last_ingested_at"),
    "latest_metric_snapshot": ("event_time", "last_ingested_at"),
    "driver_location_timeseries": ("event_time", "received_at"),
    "booking_route_segments": ("event_time", "received_at"),
}
FRESHNESS_ROW = "source_name string, last_event_time timestamp_ntz, last_ingested_at timestamp_ntz"


def with_dates(df: DataFrame, name: str) -> DataFrame:
    """Rows of a mart table with the dates of their folders."""
    dates = [c for c in PARTITIONS.get(name, []) if c in DATES and c not in df.columns]
    return df.withColumns({c: F.expr(DATES[c]) for c in dates})


def write_table(df: DataFrame, path: str, name: str, mode: str = "overwrite", refresh: bool = False) -> None:
    """Write a mart table as Parquet, partitioned by granularity and day where it has them.

    With ``refresh`` only the folders that ``df`` has rows for are overwritten. The newest times
    are observed while writing and kept beside the table, so freshness needs no scan.
    """
    df, parts = with_dates(df, name), PARTITIONS.get(name, [])
    if parts:
        # rows of one folder meet in few tasks; rebalance splits large folders and joins small ones
        df = df.hint("rebalance", *parts)
    seen = None
    if name in FRESHNESS:
        event, ingested = FRESHNESS[name]
        seen = Observation(f"freshness of {name}")
        df = df.observe(seen, F.max(event).alias("event"), F.max(ingested).alias("ingested"))
    writer = df.write.mode(mode).partitionBy(*parts)
    if refresh and parts:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{path}/{name}")
    if seen is not None:
        row = [(name, seen.get["event"], seen.get["ingested"])]
        spark = df.sparkSession
        spark.createDataFrame(row, FRESHNESS_ROW).write.mode("append" if refresh else mode).parquet(f"{path}/freshness/{name}")


def read_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Newest event and ingestion time of every table, from what was observed when they were written."""
    rows = spark.read.schema(FRESHNESS_ROW).parquet(*[f"{path}/freshness/{name}" for name in FRESHNESS])
    return rows.groupBy("source_name").agg(F.max("last_event_time").alias("last_event_time"), F.max("last_ingested_at").alias("last_ingested_at"))


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown mart table {name!r}")
    return spark.read.parquet(f"{path}/{name}").drop(*DATES)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int, **options: str) -> DataFrame:
    """Read a mart table from a database in ``parts`` parallel ranges of a column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts, **options)
        .load()
    )
