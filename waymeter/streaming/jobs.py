"""Streaming jobs: change streams in, mart tables out.

Every job is a ``foreachBatch`` query. A micro-batch writes to a folder named by its
batch id, so a batch that is replayed after a failure overwrites its own output and
nothing is counted twice. Late rows become additions to their bucket.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from waymeter.functions import fields, timing
from waymeter.operators import activity, bookings as b, buckets, drivers, marts
from waymeter.operators.keyed import latest
from waymeter.schema import DIMENSIONS, DRIVER_LOCATION, WIDE
from waymeter.session import PACKED, ROCKSDB_PROVIDER
from waymeter.sources.catalog import UNITS
from waymeter.sources.versions import KeyedTable
from waymeter.streaming import processors as p

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_STARTING = threading.Lock()


def micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")


def from_micros(column: str) -> Column:
    return F.timestamp_micros(F.col(column)).cast("timestamp_ntz")


def _day_number(column: str) -> Column:
    return F.datediff(timing.local_day(F.col(column)), F.lit("1970-01-01").cast("date"))


def _records(fired: DataFrame) -> DataFrame:
    unit = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    return fired.select(
        "metric_name",
        unit[F.col("metric_name")].alias("metric_unit"),
        F.col("numerator").cast(WIDE).alias("metric_value"),
        F.col("numerator").cast(WIDE).alias("numerator_value"),
        F.col("denominator").cast(WIDE).alias("denominator_value"),
        F.lit(0).cast(WIDE).alias("sample_size"),
        from_micros("event_us").alias("event_time"),
        from_micros("processed_us").alias("processed_at"),
        *DIMENSIONS,
        "seq",
    )


def _passenger_trips(activity: DataFrame, delay: str | None = None) -> DataFrame:
    """Completed trips. With a delay all activity moves the watermark, whatever became of the trip."""
    rows = activity.withColumn("event_time", F.coalesce("event_time", "ingest_ts"))
    rows = rows.withColumn("event_ts", F.col("event_time").cast("timestamp"))
    done = F.upper("type") == "COMPLETED"
    if delay is not None:
        # a condition on the event time stays above the watermark
        rows, done = rows.withWatermark("event_ts", delay), F.when(F.col("event_ts").isNotNull(), done)
    return rows.filter(done).select(
        "passenger_id", "seq", "event_ts", micros("event_time").alias("event_us"),
        micros("ingest_ts").alias("ingest_us"), _day_number("event_time").alias("day"),
    )


def _half(rows: DataFrame, key: str, processor: p.StatefulProcessor, event_time: bool = False) -> DataFrame:
    """One half of an activity processor; in event time, rows behind the watermark are dropped."""
    timed, mode = (rows, "EventTime") if event_time else (rows.drop("event_ts"), "ProcessingTime")
    fired = timed.groupBy(key).transformWithState(statefulProcessor=processor, outputStructType=p.RECORD_OUT, outputMode="Append", timeMode=mode)
    return _records(fired)


def live_passenger_records(activity: DataFrame) -> DataFrame:
    """Active, retained and returned passengers of a stream; however late a trip is, it counts."""
    return _half(_passenger_trips(activity), "passenger_id", p.PassengerDays(p.RECORDS))


def live_passenger_churn(activity: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """Churned passengers of a stream, by timers of the event time. Start it with ``event_time=True``."""
    return _half(_passenger_trips(activity, delay), "passenger_id", p.PassengerDays(p.CHURN), event_time=True)


def live_passenger_days(bookings: DataFrame, delay: str = "5 minutes", idle_days: int = p.STATE_DAYS) -> DataFrame:
    """Passenger KPIs per day straight from booking changes: (window, metric_name, day, records).

    One query with three stateful operators. Booking lives fire triggers, which carry the event
    time of their change on; completed trips go through the passenger processor, whose records carry
    the time they were decided at; a window over that time counts them. A day may come
    in several windows, as churn is decided days after it is due. What idles for ``idle_days`` is forgotten. Start it with ``event_time=True``.
    """
    times = {"created": "created_at", "accepted": "accepted_at", "start": "start_trip_at", "completed": "completed_at", "updated": "updated_at", "ingest": "ingest_ts"}
    rows = bookings.withColumn("event_ts", F.coalesce("updated_at", "created_at", "ingest_ts").cast("timestamp")).withWatermark("event_ts", delay)
    rows = rows.withColumns({f"{name}_us": micros(column) for name, column in times.items()}).drop(*times.values())
    chained = {"outputMode": "Append", "timeMode": "EventTime", "eventTimeColumnName": "event_ts"}
    fired = rows.groupBy("booking_id").transformWithState(
        statefulProcessor=p.BookingLife(carry_time=True, idle_days=idle_days), outputStructType=f"{p.TRIGGER_OUT}, event_ts timestamp", **chained
    )
    trips = fired.filter("kind = 'COMPLETED' AND passenger_id <> ''").withColumn("event_time", from_micros("event_us"))
    trips = trips.select("passenger_id", "seq", "event_ts", "event_us", "ingest_us", _day_number("event_time").alias("day"))
    found = trips.groupBy("passenger_id").transformWithState(
        statefulProcessor=p.PassengerDays(p.BOTH, idle_days), outputStructType=f"{p.RECORD_OUT}, event_ts timestamp", **chained
    )
    day = timing.local_day(from_micros("event_us")).alias("day")
    return found.groupBy(F.window("event_ts", "1 day"), "metric_name", day).agg(F.count(F.lit(1)).alias("records"))


def _driver_rows(locations: DataFrame, profiles: DataFrame) -> DataFrame:
    positions = locations.select(
        "driver_id", "op", "seq", "ingest_ts", "lat", "lon", "availability",
        F.coalesce("updated_at", "ingest_ts").alias("event_time"), F.lit(True).alias("is_location"),
    )
    changes = profiles.select(
        "driver_id", "op", "seq", "ingest_ts", *DIMENSIONS, F.coalesce("updated_at", "created_at", "ingest_ts").alias("event_time"), F.lit(False).alias("is_location")
    )
    return positions.unionByName(changes, allowMissingColumns=True)


def _timed_driver_rows(locations: DataFrame, profiles: DataFrame) -> DataFrame:
    # profile changes are never late, and only positions move the watermark
    moment = F.when(F.col("is_location"), F.col("event_time").cast("timestamp"))
    return _driver_rows(locations, profiles).select(
        "driver_id", "seq", "is_location", *DIMENSIONS, moment.alias("event_ts"),
        F.upper(fields.blank(F.col("availability"))).alias("availability"),
        micros("event_time").alias("event_us"),
        micros("ingest_ts").alias("ingest_us"),
        _day_number("event_time").alias("day"),
        F.floor(micros("event_time") / 60_000_000).cast("bigint").alias("minute"),
    )


def live_driver_records(locations: DataFrame, profiles: DataFrame) -> DataFrame:
    """Driver KPI records of a stream of positions and profile changes, churn left out; late rows count."""
    return _half(_timed_driver_rows(locations, profiles), "driver_id", p.DriverDays(p.RECORDS))


def live_driver_churn(locations: DataFrame, profiles: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """Churned drivers of a stream, by timers of the event time. Start it with ``event_time=True``."""
    rows = _timed_driver_rows(locations, profiles).withWatermark("event_ts", delay)
    return _half(rows, "driver_id", p.DriverDays(p.CHURN), event_time=True)


def start(
    rows: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    event_time: bool = False,
) -> StreamingQuery:
    """Start a query; by default one micro-batch every five seconds.

    A run over what is there now (``availableNow``) in processing-time mode would go on
    with empty batches for as long as state has a time to live, so empty batches are off
    there. Event-time queries keep them: their last timers fire in one.
    """
    conf = rows.sparkSession.conf
    # a query copies the settings of its session when it starts; they are set for that moment only
    needed = {NO_DATA_BATCHES: "true" if event_time else "false", STATE_STORE: ROCKSDB_PROVIDER}
    with _STARTING:
        before = {name: conf.get(name, None) for name in needed}
        for name, value in needed.items():
            conf.set(name, value)
        try:
            writer = rows.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).outputMode("append")
            return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
        finally:
            for name, value in before.items():
                conf.unset(name) if value is None else conf.set(name, value)


class BookingJob:
    """Bookings to facts, passenger activity and routes, through one trigger table.

    Lives that are open at the end of a batch go to a keyed table, and the next batch starts from them: it runs the
    operator of batch over its own changes and what is known of the lives they go on with. A life that nothing comes
    to for ``idle_days`` is forgotten. Rows are never too late to count.
    """

    def __init__(self, spark: SparkSession, path: str, idle_days: int = p.STATE_DAYS):
        self.spark, self.path, self.idle_days, self.log = spark, path.rstrip("/"), idle_days, marts.FactLog(spark, f"{path}/facts")
        self.lives = KeyedTable(spark, f"{self.path}/lives", b.OPEN_LIFE, ["booking_id"])

    def fire(self, changes: DataFrame, batch_id: int, now: float | None = None) -> DataFrame:
        """Write the triggers of one batch and the lives it leaves open; the triggers as stored."""
        moment = int(time.time() if now is None else now)
        rows = changes.persist()
        found = None
        try:
            before = self.lives.read(batch_id, self.lives.touched(rows)).filter(F.col("touched") > moment - self.idle_days * 86_400)
            known = before.join(rows.select("booking_id").distinct(), "booking_id", "left_semi")
            both = rows.unionByName(b.known_changes(known), allowMissingColumns=True)
            # used twice, and dearer to make than to keep
            found = b.booking_lives(both, keys=rows).persist()
            folder = f"{self.path}/triggers/batch_id={batch_id}"
            b.new_triggers(found).write.mode("overwrite").options(**PACKED).parquet(folder)
            lives = b.open_lives(found).withColumn("touched", F.lit(moment).cast("bigint"))
            self.lives.merge(lives, batch_id, _replaced(moment - self.idle_days * 86_400))
        finally:
            rows.unpersist()
            if found is not None:
                found.unpersist()
        return rows.sparkSession.read.schema(b.TRIGGER).parquet(folder)

    def write_changes(self, changes: DataFrame, batch_id: int) -> None:
        self._publish(self.fire(changes, batch_id), batch_id)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Triggers are written once and read back, so what made them runs once per batch."""
        folder = f"{self.path}/triggers/batch_id={batch_id}"
        batch.write.mode("overwrite").options(**PACKED).parquet(folder)
        self._publish(batch.sparkSession.read.schema(b.TRIGGER).parquet(folder), batch_id)

    def _publish(self, stored: DataFrame, batch_id: int) -> None:
        self.log.write(marts.merge_minutes(b.trigger_minutes(stored, placed=True)), "bookings", batch_id)
        b.trigger_activity(stored).write.mode("overwrite").options(**PACKED).parquet(f"{self.path}/activity/batch_id={batch_id}")
        b.trigger_routes(stored).write.mode("overwrite").options(**PACKED).parquet(f"{self.path}/routes/batch_id={batch_id}")

    def start(self, bookings: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start(bookings, self.write_changes, f"{self.path}/checkpoint/bookings", trigger)

    def activity(self) -> DataFrame:
        """Passenger activity as a stream of what this job has written."""
        shape = "passenger_id string, type string, event_time timestamp_ntz, seq bigint, ingest_ts timestamp_ntz, batch_id bigint"
        return self.spark.readStream.schema(shape).parquet(f"{self.path}/activity").drop("batch_id")

    def routes(self) -> DataFrame:
        """Route segments written so far, the last of each key."""
        return marts.route_segments(self.spark.read.parquet(f"{self.path}/routes").drop("batch_id"))


class RecordJob:
    """Any stream of metric records to the fact log."""

    def __init__(self, spark: SparkSession, path: str, source: str):
        self.path, self.source, self.log = path.rstrip("/"), source, marts.FactLog(spark, f"{path}/facts")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        self.log.write(buckets.minute_totals(batch), self.source, batch_id)

    def start(self, records: DataFrame, trigger: dict | None = None, event_time: bool = False) -> StreamingQuery:
        return start(records, self.write_batch, f"{self.path}/checkpoint/{self.source}", trigger, event_time)


class PassengerDayJob:
    """Passenger KPIs per day by one query from booking changes on: lives, then activity, then counts per day.

    A batch fires the triggers of its booking lives, and takes their completed trips on top of the last trip
    known of each passenger; both are keyed tables. The newest time of a change is how far the stream has come,
    and a churn counts in the batch that passes it. Counts are written per batch and summed when read. A passenger
    without a trip for ``idle_days`` after the churn is forgotten. Rows are never too late to count.
    """

    LAST = "passenger_id string, event_time timestamp_ntz, counted boolean"

    def __init__(self, spark: SparkSession, path: str, idle_days: int = p.STATE_DAYS):
        self.spark, self.path, self.idle_days = spark, path.rstrip("/"), idle_days
        self.bookings = BookingJob(spark, self.path, idle_days)
        self.last = KeyedTable(spark, f"{self.path}/last", self.LAST, ["passenger_id"])
        self.clock = KeyedTable(spark, f"{self.path}/clock", "name string, at timestamp_ntz", ["name"], buckets=1)

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        moments = [changes.agg(F.max(F.coalesce("updated_at", "created_at", "ingest_ts"))).first()[0], *[r["at"] for r in self.clock.read(batch_id).collect()]]
        moment = max((m for m in moments if m is not None), default=None)
        now = F.lit(moment and str(moment)).cast("timestamp_ntz")
        trips = b.trigger_activity(self.bookings.fire(changes, batch_id)).filter("type = 'COMPLETED'")
        gone = F.coalesce(F.col("event_time") + timing.days(activity.CHURN_DAYS + self.idle_days) <= now, F.lit(False))
        known = self.last.read(batch_id).filter(~gone)
        found = activity.passenger_activity_records(trips, now, known=known)
        day = timing.local_day(F.col("event_time")).alias("day")
        found.groupBy("metric_name", day).agg(F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(f"{self.path}/days/batch_id={batch_id}")
        counted = F.coalesce(F.expr(activity.churn_due("event_time")) <= now, F.lit(False))
        newest = latest(trips, ["passenger_id"], "seq", ["event_time"]).withColumn("counted", counted)
        churned = known.filter(~F.col("counted") & counted).join(newest, "passenger_id", "left_anti").withColumn("counted", F.lit(True))
        changed = newest.unionByName(churned).persist()
        try:
            self.last.merge(changed, batch_id, lambda table, rows: table.filter(~gone).join(rows, "passenger_id", "left_anti").unionByName(rows))
        finally:
            changed.unpersist()
        self.clock.merge(changes.sparkSession.range(1).select(F.lit("changes").alias("name"), now.alias("at")), batch_id, lambda table, rows: rows)

    def start(self, bookings: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start(bookings, self.write_batch, f"{self.path}/checkpoint", trigger)

    def days(self) -> DataFrame:
        shape = "metric_name string, day date, records bigint, batch_id bigint"
        return self.spark.read.schema(shape).parquet(f"{self.path}/days").groupBy("metric_name", "day").agg(F.sum("records").alias("records"))


class RegistrationJob:
    """First ``c`` change of each key to the fact log; keys seen are a table that each batch merges into."""

    def __init__(self, spark: SparkSession, path: str, source: str, key: str, metric: str, dimensions: list[str]):
        self.path, self.source, self.key, self.metric, self.dimensions = path.rstrip("/"), source, key, metric, dimensions
        self.log = marts.FactLog(spark, f"{path}/facts")
        self.seen = KeyedTable(spark, f"{path}/seen/{source}", f"{key} string", [key])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        created = batch.filter("lower(op) = 'c'").persist()
        try:
            known = self.seen.read(batch_id, self.seen.touched(created))
            fresh = activity.registrations(created.join(known, self.key, "left_anti"), self.key, self.metric, self.dimensions)
            self.log.write(buckets.minute_totals(fresh), self.source, batch_id)
            self.seen.merge(created.select(self.key).distinct(), batch_id, lambda now, rows: now.union(rows).distinct())
        finally:
            created.unpersist()

    def start(self, changes: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start(changes, self.write_batch, f"{self.path}/checkpoint/{self.source}", trigger)


class SnapshotJob:
    """Metric records to the latest value of each metric and scope, kept as month totals by key."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.months = KeyedTable(spark, f"{path}/months", marts.FactLog.COLUMNS, ["metric_name", *DIMENSIONS])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        folder = f"{self.path}/totals/batch_id={batch_id}"
        session = batch.sparkSession
        shape = session.createDataFrame([], marts.FactLog.COLUMNS).schema
        buckets.minute_totals(batch, "MONTH").to(shape).write.mode("overwrite").parquet(folder)
        self.months.merge(session.read.schema(shape).parquet(folder), batch_id, marts.add_totals)

    def start(self, records: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start(records, self.write_batch, f"{self.path}/checkpoint", trigger)

    def snapshot(self) -> DataFrame:
        return marts.latest_snapshot(buckets.roll_up(self.months.read(), ("MONTH",)))


class LocationJob:
    """Positions and profile changes to the time series, the latest documents and daily documents.

    A batch looks profiles up as they stood when each position came: among its own changes,
    and before those in the table of profiles, of which it reads and writes the buckets it touches.
    """

    PROFILE = "driver_id string, service_type string, service_tier string, area_code string"
    DOCUMENT = "driver_id string, seq bigint, document string"
    POSITION = f"{DRIVER_LOCATION}, service_type string, service_tier string, area_code string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.profiles = KeyedTable(spark, f"{self.path}/profiles", self.PROFILE, ["driver_id"])
        self.documents = KeyedTable(spark, f"{self.path}/documents", self.DOCUMENT, ["driver_id"])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            positions = rows.filter("is_location").select("driver_id", "op", "availability", "lat", "lon", F.col("event_time").alias("updated_at"), "seq", "ingest_ts")
            changes = rows.filter("NOT is_location").select("driver_id", "seq", "ingest_ts", *DIMENSIONS)
            before = self.profiles.read(batch_id, self.profiles.touched(rows)).join(rows.select("driver_id").distinct(), "driver_id", "left_semi")
            known = before.select("driver_id", F.lit(-(2**63)).alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ingest_ts"), *DIMENSIONS)
            folder = f"{self.path}/positions/batch_id={batch_id}"
            drivers.enrich_locations(positions, changes.unionByName(known)).write.mode("overwrite").parquet(folder)
            stored = rows.sparkSession.read.schema(self.POSITION).parquet(folder)
            self.profiles.merge(changes, batch_id, _last_fields)
            documents = stored.select("driver_id", "seq", marts.document().alias("document"))
            self.documents.merge(documents, batch_id, marts.newer(["driver_id", "seq", "document"], ["driver_id"]))
            marts.append_daily_documents(stored, f"{self.path}/daily", batch_id)
        finally:
            rows.unpersist()

    def start(self, locations: DataFrame, profiles: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return start(_driver_rows(locations, profiles), self.write_batch, f"{self.path}/checkpoint/locations", trigger)

    def positions(self) -> DataFrame:
        return self.spark.read.schema(f"{self.POSITION}, batch_id bigint").parquet(f"{self.path}/positions").drop("batch_id")

    def timeseries(self) -> DataFrame:
        return marts.location_timeseries(self.positions())

    def latest_documents(self) -> DataFrame:
        return self.documents.read().select("driver_id", "document")

    def daily_documents(self) -> DataFrame:
        shape = "driver_id string, seq bigint, document string, event_day string, batch_id bigint"
        return self.spark.read.schema(shape).json(f"{self.path}/daily").drop("batch_id")


def _replaced(idle_before: int):
    """Combine open lives: bookings with changes have their new one or none, and idle ones go."""

    def combine(current: DataFrame, rows: DataFrame) -> DataFrame:
        kept = current.filter(F.col("touched") > idle_before).join(rows.select("booking_id"), "booking_id", "left_anti")
        return kept.unionByName(rows.filter("known IS NOT NULL").select(*kept.columns))

    return combine


def _last_fields(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Profiles with the last non-empty value of each field; ``current`` is older than every change."""
    both = current.withColumn("seq", F.lit(-(2**63))).unionByName(changes.select("driver_id", *DIMENSIONS, "seq"))
    last = [F.max_by(d, F.when(F.col(d) != "", F.col("seq"))).alias(d) for d in DIMENSIONS]
    return both.groupBy("driver_id").agg(*last)


def facts_of(log: marts.FactLog, sources: list[str], granularities: tuple[str, ...] = timing.GRANULARITIES) -> DataFrame:
    """The fact table as the log has it now."""
    return buckets.roll_up(log.all_minutes(sources), granularities)
