"""Mart tables: upserts, snapshots, latest-by-key documents, delta logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import fields, timing
from waymeter.operators import buckets
from waymeter.operators.keyed import latest, union_all
from waymeter.session import PACKED, release
from waymeter.schema import COORDINATE, DIMENSIONS, FACT, FACT_KEY, LOCATION, MEASURES, ROUTE, SNAPSHOT, SNAPSHOT_KEY
from waymeter.sources import marts as tables
from waymeter.sources.versions import Folder, Manifests


def fact_table(facts: DataFrame) -> DataFrame:
    return facts.select(*FACT)


def latest_snapshot(facts: DataFrame) -> DataFrame:
    """Latest value per metric and scope.

    All granularities share one key, and the last one processed stays. The fixed rule is
    the MONTH bucket of the newest event, with the highest event time seen. A plain
    aggregate over the MONTH facts.
    """
    months = facts.filter(F.col("bucket_granularity") == "MONTH")
    row = F.struct(*MEASURES, "metric_unit", "last_ingested_at", "last_updated")
    newest = F.struct("seq", "bucket_start")
    return (
        months.groupBy(*SNAPSHOT_KEY)
        .agg(F.max_by(row, newest).alias("r"), F.max("last_event_at").alias("event_time"))
        .select(*SNAPSHOT_KEY, "r.*", "event_time", F.lit("MONTH").alias("data_granularity"))
        .select(*SNAPSHOT)
    )


def location_timeseries(enriched: DataFrame) -> DataFrame:
    """One row per driver and event time, the last to arrive. Heading and speed are never known."""
    rows = enriched.select(
        "driver_id",
        F.coalesce("updated_at", "ingest_ts").alias("event_time"),
        *[fields.blank(F.col(d)).alias(d) for d in DIMENSIONS],
        F.col("lat").cast(COORDINATE).alias("latitude"),
        F.col("lon").cast(COORDINATE).alias("longitude"),
        F.lit(None).cast("decimal(6,2)").alias("heading_degree"),
        F.lit(None).cast("decimal(10,2)").alias("speed_kmh"),
        fields.blank(F.col("availability")).alias("driver_status"),
        F.col("ingest_ts").alias("received_at"),
        "seq",
    )
    return latest(rows, ["driver_id", "event_time"], "seq", LOCATION[2:])


def route_segments(segments: DataFrame) -> DataFrame:
    """One row per booking, segment type and sequence number, the last to arrive."""
    return latest(segments, ROUTE[:3], "seq", ROUTE[3:])


def document() -> Column:
    """A driver position as the JSON document that the map reads."""
    moment = F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.to_json(
        F.struct(
            F.col("driver_id").alias("driverId"),
            fields.blank(F.col("availability")).alias("availability"),
            fields.blank(F.col("service_type")).alias("serviceType"),
            fields.blank(F.col("service_tier")).alias("serviceTier"),
            fields.blank(F.col("area_code")).alias("areaCode"),
            moment.alias("@timestamp"),
            F.struct("lat", "lon").alias("location"),
        )
    )


def latest_documents(enriched: DataFrame) -> DataFrame:
    """Latest document per driver, by arrival."""
    rows = enriched.select("driver_id", "seq", document().alias("document"))
    return latest(rows, ["driver_id"], "seq", ["document"])


def daily_documents(enriched: DataFrame, prefix: str = "driver_locations_timeseries") -> DataFrame:
    """Every document with the name of its UTC-day partition."""
    return enriched.select(
        timing.utc_day_name(prefix, F.col("updated_at")).alias("index_name"),
        F.date_format("updated_at", "yyyy.MM.dd").alias("event_day"),
        "driver_id",
        "seq",
        document().alias("document"),
    )


def append_daily_documents(enriched: DataFrame, path: str, batch_id: int) -> None:
    """Documents of one batch to a folder of their own, below it one folder per UTC day; a replay overwrites them."""
    daily_documents(enriched).drop("index_name").write.partitionBy("event_day").mode("overwrite").json(f"{path}/batch_id={batch_id}")


def upsert(current: DataFrame, incoming: DataFrame, key: str, do_update: bool = False) -> DataFrame:
    """Merge rows by key, on the columns that ``current`` has.

    Without ``do_update`` an existing key keeps its row. With it, the incoming row's
    columns replace the current ones and columns it lacks stay as they are. Of several
    incoming rows with one key the last by ``seq`` counts, or any one if there is none.
    """
    if key not in incoming.columns:
        raise ValueError(f"key column {key!r} is missing")
    shared = [c for c in current.columns if c in incoming.columns]
    given = [c for c in shared if c != key]
    order = F.col("seq") if "seq" in incoming.columns else F.struct(*given)
    fresh = latest(incoming, [key], order, given) if given else incoming.select(key).distinct()
    if not do_update:
        new = fresh.join(current.select(key), key, "left_anti")
        return current.unionByName(new, allowMissingColumns=True)
    renamed = fresh.select(key, *[F.col(c).alias(f"{c}_new") for c in given], F.lit(True).alias("_hit"))
    merged = current.withColumn("_old", F.lit(True)).join(renamed, key, "full")
    picked = [
        F.col(c) if c == key or c not in given else F.when(F.col("_hit"), F.col(f"{c}_new")).otherwise(F.col(c)).alias(c)
        for c in current.columns
    ]
    return merged.select(*picked)


class FactLog:
    """Fact table kept as a log of deltas, for streams.

    Every micro-batch writes its minute totals to a folder of its own, so a replayed
    batch overwrites itself and late rows simply add to their bucket. Reading sums the
    deltas. After every ``compact_every`` batches their deltas are folded into a new base, which
    a manifest swaps in at once: readers take the base it names and the deltas beyond it. Deltas
    and bases of which the last two manifests need nothing go, so the folders stay few.
    """

    COLUMNS = (
        "metric_name string, metric_unit string, service_type string, service_tier string, area_code string, "
        "bucket_start timestamp_ntz, metric_value decimal(34,9), numerator_value decimal(34,9), "
        "denominator_value decimal(34,9), sample_size decimal(34,9), first_event_at timestamp_ntz, "
        "last_event_at timestamp_ntz, last_ingested_at timestamp_ntz, processing_lag_ms int, seq bigint"
    )

    def __init__(self, spark, path: str, compact_every: int = 50):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every

    def _manifests(self, source: str) -> Manifests:
        return Manifests(Folder(self.spark, f"{self.path}/{source}"), keep=2)

    def write(self, minutes: DataFrame, source: str, batch_id: int) -> None:
        """Store one micro-batch of minute totals, and compact when enough are waiting."""
        shaped = minutes.to(self.spark.createDataFrame([], self.COLUMNS).schema)
        shaped.write.mode("overwrite").options(**PACKED).parquet(f"{self.path}/{source}/delta/batch_id={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(source)

    def _deltas(self, source: str, beyond: int) -> list[int]:
        """Complete deltas that no base has taken in."""
        found = Folder(self.spark, f"{self.path}/{source}").matches("delta/batch_id=*/_SUCCESS")
        return sorted(n for n in (int(name.split("=")[1]) for name in found) if n > beyond)

    def _stored(self, source: str) -> tuple[dict, list[int]]:
        manifest = self._manifests(source).load()
        return manifest, self._deltas(source, manifest.get("upto", -1))

    def _read(self, source: str, manifest: dict, deltas: list[int]) -> DataFrame:
        paths = [f"{self.path}/{source}/{manifest['base']}"] if manifest else []
        paths += [f"{self.path}/{source}/delta/batch_id={n}" for n in deltas]
        return self.spark.read.schema(self.COLUMNS).parquet(*paths) if paths else self.spark.createDataFrame([], self.COLUMNS)

    def minutes(self, source: str) -> DataFrame:
        """Minute totals of one source; a minute may come in several rows."""
        return self._read(source, *self._stored(source))

    def compact(self, source: str) -> None:
        """Fold all complete deltas of a source into a new base."""
        manifest, deltas = self._stored(source)
        if not deltas:
            return
        # a delta has a key once, so sums in each task before the shuffle would take time and save nothing
        placed = self._read(source, manifest, deltas).repartition(*DIMENSIONS, "bucket_start")
        merged = merge_minutes(placed).to(self.spark.createDataFrame([], self.COLUMNS).schema)
        base = f"base/upto={deltas[-1]}"
        merged.write.mode("overwrite").options(**PACKED).parquet(f"{self.path}/{source}/{base}")
        kept = self._manifests(source).put(deltas[-1], {"base": base, "upto": deltas[-1]})
        folder = Folder(self.spark, f"{self.path}/{source}")
        for name in folder.names("base"):
            if f"base/{name}" not in [m["base"] for m in kept]:
                folder.delete(f"base/{name}")
        # who has just read the manifest before this one still finds its deltas
        gone = kept[0]["upto"] if len(kept) > 1 else -1
        for name in folder.names("delta"):
            if int(name.split("=")[1]) <= gone:
                folder.delete(f"delta/{name}")

    def delta(self, source: str, batch_id: int) -> DataFrame:
        """Minute totals of one micro-batch that no base has taken in yet."""
        return self.spark.read.schema(self.COLUMNS).parquet(f"{self.path}/{source}/delta/batch_id={batch_id}")

    def all_minutes(self, sources: list[str]) -> DataFrame:
        return union_all([self.minutes(source) for source in sources])


#: Minute rows that a step of a build or refresh rolls up, and the most steps of one.
ROWS_PER_STEP = 4_000_000
MOST_STEPS = 16


def _steps(minutes: DataFrame, folders: list, rows_per_step: int) -> list[list]:
    """Folders (granularity, date) in order of their dates, in steps of about so many minute rows each."""
    # one row per day of the calendar
    counts = {r[0]: r[1] for r in minutes.groupBy(F.col("bucket_start").cast("date")).agg(F.count(F.lit(1))).collect()}
    dates = sorted({f["bucket_date"] for f in folders} | {d for d in counts if d is not None})
    least = max(rows_per_step, sum(counts.values()) / MOST_STEPS)
    step_of, seen = {}, 0
    for date in dates:
        step_of[date] = int(seen // least)
        seen += counts.get(date, 0)
    steps: dict[int, list] = {}
    for folder in folders:
        steps.setdefault(step_of[folder["bucket_date"]], []).append(folder)
    return [steps[n] for n in sorted(steps)]


def _write_folders(minutes: DataFrame, folders: DataFrame, path: str, granularities: tuple[str, ...], rows_per_step: int) -> None:
    """Overwrite these folders of the stored fact table, step by step; shuffle files of a step go before the next one."""
    spark = minutes.sparkSession
    # at most one row per granularity and day
    wanted = folders.filter("bucket_date IS NOT NULL").collect()
    for step in _steps(minutes, wanted, rows_per_step):
        own = spark.createDataFrame(step, folders.schema)
        tables.write_table(buckets.roll_up(minutes, granularities, own), path, "fact_metric_bucket", refresh=True)
        release(spark)


def build_facts(log: FactLog, source: str, path: str, granularities: tuple[str, ...] = timing.GRANULARITIES, rows_per_step: int = ROWS_PER_STEP) -> None:
    """The stored fact table anew from all that the log has of a source."""
    minutes = log.minutes(source)
    # what has no bucket has no day to be cut by; written first, as that empties the table
    undated = buckets.roll_up(minutes.filter("bucket_start IS NULL"), granularities)
    tables.write_table(undated, path, "fact_metric_bucket")
    _write_folders(minutes, buckets.touched_folders(minutes, granularities), path, granularities, rows_per_step)


def refresh_facts(
    log: FactLog, source: str, batch_id: int, path: str, granularities: tuple[str, ...] = timing.GRANULARITIES, rows_per_step: int = ROWS_PER_STEP
) -> None:
    """Roll up again, and overwrite, only the folders of the stored fact table that a batch adds to."""
    _write_folders(log.minutes(source), buckets.touched_folders(log.delta(source, batch_id), granularities), path, granularities, rows_per_step)


def newer(columns: list[str], key: list[str]):
    """Combine rows of a keyed table: of each key the row with the highest ``seq`` stays."""

    def combine(current: DataFrame, rows: DataFrame) -> DataFrame:
        both = current.unionByName(rows.select(*current.columns))
        return latest(both, key, "seq", [c for c in current.columns if c not in key]).select(*columns)

    return combine


def add_totals(current: DataFrame, rows: DataFrame) -> DataFrame:
    """Combine rows of a keyed table of bucket totals: measures add up."""
    return merge_minutes(current.unionByName(rows.select(*current.columns))).to(current.schema)


def merge_minutes(minutes: DataFrame) -> DataFrame:
    """Minute rows of one key summed into one."""
    return minutes.groupBy("metric_name", "metric_unit", *DIMENSIONS, "bucket_start").agg(
        *[F.sum(name).cast("decimal(34,9)").alias(name) for name in MEASURES],
        F.min("first_event_at").alias("first_event_at"),
        *[F.max(n).alias(n) for n in ("last_event_at", "last_ingested_at", "processing_lag_ms", "seq")],
    )


def upsert_facts(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Overwrite facts by key with the incoming running totals.

    Measures and lag come from the incoming row; first event keeps the minimum, last
    event and ingestion the maximum of both.
    """
    tagged = current.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    values = [*MEASURES, "processing_lag_ms"]
    return (
        tagged.groupBy(*FACT_KEY)
        .agg(
            F.max_by(F.struct(*values), "_new").alias("r"),
            F.min("first_event_at").alias("first_event_at"),
            F.max("last_event_at").alias("last_event_at"),
            F.max("last_ingested_at").alias("last_ingested_at"),
            F.max("last_updated").alias("last_updated"),
        )
        .select(*FACT_KEY, "r.*", "first_event_at", "last_event_at", "last_ingested_at", "last_updated")
        .select(*FACT)
    )


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 500, **options: str) -> None:
    """Append rows to a database table over JDBC."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_rows, **options).mode("append").save()
