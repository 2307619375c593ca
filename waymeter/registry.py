"""Every query by name, bound to the given tables.

A query takes (spark, sf_dir) and gives a DataFrame over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from waymeter.functions import fields, metrics as m, money, points, timing
from waymeter.operators import activity, bookings as b, buckets, drivers, marts
from waymeter.operators.keyed import union_all
from waymeter.plans import cohorts, quality, views
from waymeter.schema import DIMENSIONS, FACT, MEASURES, RECORD
from waymeter.session import PACKED, release, work_folder
from waymeter.sources import cdc, marts as marts_io, testbed as bed
from waymeter.sources.catalog import is_valid, metric_catalog
from waymeter.sources.versions import Folder
from waymeter.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ALL = ("bookings", "drivers", "passengers")
CHANGES_PER_FILE = 250_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- shared inputs -----------------------------------------------------------------
# Frames are lazy: what is kept here is the plan, not data.


def forget_plans() -> None:
    for shared in (triggers, minutes, enriched, stored_changes):
        shared.cache_clear()


@lru_cache(maxsize=32)
def triggers(spark, sf, dedupe_terminal=False) -> DataFrame:
    return b.booking_triggers(bed.bookings(spark, sf), dedupe_terminal, keys=bed.booking_keys(spark, sf))


def _all_records(spark, sf, parts=ALL) -> list[DataFrame]:
    """Metric records of the chosen producers."""
    records = []
    if "drivers" in parts:
        records += [
            drivers.driver_records(bed.driver_locations(spark, sf), bed.driver_profiles(spark, sf)),
            activity.driver_registrations(bed.driver_profiles(spark, sf)),
        ]
    if "passengers" in parts:
        records += [
            activity.passenger_activity_records(bed.passenger_activity(spark, sf)),
            activity.passenger_registrations(bed.passengers(spark, sf)),
        ]
    if "bookings" in parts:
        records.append(b.trigger_records(triggers(spark, sf)))
    return records


@lru_cache(maxsize=32)
def minutes(spark, sf, parts=ALL, level="MINUTE") -> DataFrame:
    """Minute totals of the chosen producers, or totals of a coarser level."""
    records = _all_records(spark, sf, [part for part in parts if part != "bookings"])
    found = [buckets.minute_totals(union_all(records), level)] if records else []
    if "bookings" in parts:
        found.append(b.trigger_minutes(triggers(spark, sf), level))
    shared = ["metric_name", "metric_unit", *DIMENSIONS, "bucket_start", *MEASURES, "first_event_at", "last_event_at", "last_ingested_at", "processing_lag_ms", "seq"]
    return union_all([f.select(*shared) for f in found])


def facts(spark, sf, *granularities: str, parts=ALL) -> DataFrame:
    # a single granularity needs no minutes in between
    level = granularities[0] if len(granularities) == 1 else "MINUTE"
    return buckets.roll_up(minutes(spark, sf, parts, level), granularities or timing.GRANULARITIES)


def snapshot(spark, sf, parts=ALL) -> DataFrame:
    return marts.latest_snapshot(facts(spark, sf, "MONTH", parts=parts))


@lru_cache(maxsize=32)
def enriched(spark, sf) -> DataFrame:
    return drivers.enrich_locations(bed.driver_locations(spark, sf), bed.driver_profiles(spark, sf))


def routes(spark, sf) -> DataFrame:
    # routes need neither money nor any trigger but the request
    asked = b.booking_triggers(bed.bookings(spark, sf, money=False), keys=bed.booking_keys(spark, sf), kinds=("REQUESTED",))
    return marts.route_segments(b.trigger_routes(asked))


def events_end(spark, sf):
    return bed.table(spark, sf, "events").agg(F.max("ts")).scalar()


@lru_cache(maxsize=32)
def stored_changes(spark, sf, entity: str) -> DataFrame:
    """Change records of one entity as files, the way a change stream leaves them."""
    folder = work_folder(spark, f"{entity}-changes")
    made = {
        "booking": bed.booking_envelopes, "passenger": bed.passenger_envelopes,
        "driver": bed.driver_envelopes, "location": bed.location_envelopes,
    }
    # compressed files cannot be split, so none holds more than one task should read
    packed = {"compression": "gzip", "maxRecordsPerFile": CHANGES_PER_FILE}
    made[entity](spark, sf).write.options(timestampNTZFormat=cdc.NTZ_TEXT, **packed).json(folder)
    return cdc.file_source(spark, folder, streaming=False)


# ---- sources, projections, scalar functions ----------------------------------------


@query
def cdc_bookings(spark, sf):
    return cdc.bookings(stored_changes(spark, sf, "booking"))


@query
def cdc_passengers(spark, sf):
    return cdc.passengers(stored_changes(spark, sf, "passenger"))


@query
def cdc_drivers(spark, sf):
    return cdc.drivers(stored_changes(spark, sf, "driver"))


@query
def cdc_driver_locations(spark, sf):
    return cdc.driver_locations(stored_changes(spark, sf, "location"))


@query
def cdc_file_source(spark, sf):
    """Change records through files, from a start time on."""
    folder = work_folder(spark, "cdc")
    bed.passenger_envelopes(spark, sf).write.option("timestampNTZFormat", cdc.NTZ_TEXT).json(folder)
    since = "TIMESTAMP:1705276800000"  # 2024-01-15T00:00:00Z
    return cdc.parse_passengers(cdc.file_source(spark, folder, since, streaming=False))


@query
def cdc_event_time(spark, sf):
    return cdc.event_time(stored_changes(spark, sf, "passenger")).select("seq", "event_ts")


@query
def time_buckets(spark, sf):
    ends = None
    rows = buckets.expand_granularities(bed.table(spark, sf, "events").select("event_id", F.col("ts").alias("event_time")))
    for name in timing.GRANULARITIES:
        hit, end = F.col("bucket_granularity") == name, timing.bucket_end(F.col("bucket_start"), name)
        ends = F.when(hit, end) if ends is None else ends.when(hit, end)
    return rows.select("event_id", "bucket_granularity", "bucket_start", ends.alias("bucket_end"))


@query
def time_differences(spark, sf):
    o = bed.orders(spark, sf)
    return o.select(
        "booking_id",
        timing.seconds_between(F.col("created_at"), F.col("completed_at")).alias("lead_seconds"),
        timing.day_gap(F.col("created_at"), F.col("completed_at") + timing.days(2)).alias("day_gap"),
        timing.processing_lag_ms(F.col("completed_at"), F.col("accepted_at")).alias("no_lag_ms"),
        timing.processing_lag_ms(F.col("accepted_at"), F.col("completed_at")).alias("lag_ms"),
        timing.rounded_seconds(F.col("created_at"), F.col("start_trip_at") + F.expr("INTERVAL '0.5' SECOND")).alias("rounded_seconds"),
        F.col("completed_at").cast("date").alias("completed_date"),
    )


@query
def text_functions(spark, sf):
    name = F.concat(F.lit("service-"), F.col("n_name"), F.lit("TypeCode"))
    c = bed.table(spark, sf, "customer").join(bed.table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
    tier = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    state = F.element_at(F.array(*map(F.lit, ["AVAILABLE", "BUSY", "ONLINE", "OFF"])), (F.col("c_custkey") % 4 + 1).cast("int"))
    return c.select(
        "c_custkey",
        fields.snake(name).alias("snake"),
        fields.camel(F.concat_ws("_", F.lower("n_name"), F.lit("CODE"))).alias("camel"),
        fields.first_non_empty(tier, F.col("n_name")).alias("first_text"),
        fields.resolve(tier, F.lit(None).cast("string")).alias("resolved"),
        fields.is_online(state).alias("online"),
        fields.status_has(F.concat(F.lit("driver_"), F.lower(state)), "AVAIL").alias("status_hit"),
    )


@query
def number_fields(spark, sf):
    text = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'bad' WHEN 1 THEN '' WHEN 2 THEN '1e2' WHEN 3 THEN CAST(o_orderkey AS STRING) END")
    return bed.table(spark, sf, "orders").select("o_orderkey", fields.number(text).alias("number"))


@query
def decoded_points(spark, sf):
    rows = bed.driver_locations(spark, sf)
    wkb = bed.wkb_of(F.col("lat"), F.col("lon"))
    text = F.when(F.col("seq") % 3 == 0, F.base64(wkb)).when(F.col("seq") % 3 == 1, F.hex(wkb)).otherwise("POINT(1 2)")
    return points.decode_points(rows.select("seq", "lat", "lon"), {"p": text}).selectExpr("seq", "p_lon AS lon", "p_lat AS lat")


@query
def revenue_columns(spark, sf):
    fee, discount = F.col("platform_fee"), F.col("discount_amount")
    return bed.orders(spark, sf).select(
        "booking_id",
        money.gross_service_value(fee, discount).alias("gsv"),
        F.round(money.revenue_net(fee), 4).alias("revenue_net"),
        money.net_driver_income(fee, discount).alias("net_driver_income"),
    )


@query
def metric_keys(spark, sf):
    return facts(spark, sf).select(m.metric_key().alias("metric_key"), "metric_value")


# ---- stateful producers ------------------------------------------------------------


@query
def booking_triggers(spark, sf):
    return triggers(spark, sf).select("booking_id", "passenger_id", "kind", "event_time", *DIMENSIONS, *b.TRIGGER_VALUES, "seq")


def _shown(records: DataFrame) -> DataFrame:
    return records.select(
        "metric_name", "metric_unit", *DIMENSIONS, "event_time", "processed_at",
        *[F.col(c).cast("decimal(20,6)").alias(c) for c in MEASURES], "seq",
    )


@query
def booking_records(spark, sf):
    return _shown(b.trigger_records(triggers(spark, sf)))


def _repeated_ends(spark, sf) -> DataFrame:
    changes = bed.bookings(spark, sf)
    again = changes.filter("status = 'COMPLETED' AND CAST(booking_id AS BIGINT) % 5 = 0").withColumn("seq", F.col("seq") + 1)
    return changes.unionByName(again)


@query
def booking_repeated_ends(spark, sf):
    """A COMPLETED change that comes again starts and ends a new life."""
    rows = b.trigger_records(b.booking_triggers(_repeated_ends(spark, sf)))
    return rows.groupBy("metric_name").agg(F.sum("metric_value").cast("decimal(20,6)").alias("metric_value"), F.count(F.lit(1)).alias("records"))


@query
def booking_first_ends(spark, sf):
    """The same changes with everything after the first end ignored."""
    rows = b.trigger_records(b.booking_triggers(_repeated_ends(spark, sf), dedupe_terminal=True))
    return rows.groupBy("metric_name").agg(F.sum("metric_value").cast("decimal(20,6)").alias("metric_value"), F.count(F.lit(1)).alias("records"))


@query
def passenger_registrations(spark, sf):
    return _shown(activity.passenger_registrations(bed.passengers(spark, sf)))


@query
def driver_registrations(spark, sf):
    return _shown(activity.driver_registrations(bed.driver_profiles(spark, sf)))


@query
def passenger_activity_records(spark, sf):
    return _shown(activity.passenger_activity_records(bed.passenger_activity(spark, sf)))


@query
def driver_records(spark, sf):
    return _shown(drivers.driver_records(bed.driver_locations(spark, sf), bed.driver_profiles(spark, sf)))


@query
def booking_activity(spark, sf):
    return b.trigger_activity(triggers(spark, sf)).select("passenger_id", "type", "event_time", "seq")


@query
def booking_passenger_days(spark, sf):
    """Activity of bookings chained into passenger KPIs, summed per metric and day."""
    trips = b.trigger_activity(triggers(spark, sf))
    found = activity.passenger_activity_records(trips)
    return found.groupBy("metric_name", timing.local_day(F.col("event_time")).alias("day")).agg(F.count(F.lit(1)).alias("records"))


@query
def booking_routes(spark, sf):
    return routes(spark, sf)


@query
def granularity_records(spark, sf):
    rows = buckets.expand_granularities(activity.passenger_registrations(bed.passengers(spark, sf)))
    return rows.select("metric_name", "bucket_granularity", "bucket_start", "event_time", "seq")


# ---- joins -------------------------------------------------------------------------


@query
def enriched_locations(spark, sf):
    return enriched(spark, sf).select("driver_id", "seq", "updated_at", "availability", *DIMENSIONS, "lat", "lon")


@query
def sticky_dimensions(spark, sf):
    """Driver KPIs from positions that carry their own fields only now and then."""
    seen = F.col("seq") % 3 == 0
    own = bed.driver_locations(spark, sf).withColumns(
        {
            "service_type": F.when(seen, F.concat(F.lit("S"), F.col("seq") % 2)).otherwise(""),
            "service_tier": F.lit(""),
            "area_code": F.when(F.col("seq") % 5 == 0, F.concat(F.lit("A"), F.col("seq") % 4)),
        }
    )
    return drivers.driver_records(own).groupBy("metric_name", *DIMENSIONS).agg(F.sum("metric_value").cast("decimal(20,6)").alias("metric_value"))


@query
def missing_fares(spark, sf):
    """Bookings without any fare line."""
    o = bed.table(spark, sf, "orders").select(F.col("o_orderkey").alias("booking_id"))
    lines = bed.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("booking_id"))
    return quality.missing_entities(o, lines, "booking_id")


def _earnings(spark, sf) -> tuple[DataFrame, DataFrame]:
    people = bed.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("driver_id"))
    # one more driver, who has earned nothing
    people = people.unionByName(people.agg((F.max("driver_id") + 1).alias("driver_id")))
    net = F.expr("CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(6,4)))) AS BIGINT)")
    paid = bed.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("driver_id"), net.alias("amount"))
    return people, paid


@query
def driver_earnings(spark, sf):
    return quality.driver_earnings(_earnings(spark, sf)[1])


@query
def driver_balances(spark, sf):
    return quality.driver_balances(*_earnings(spark, sf))


@query
def payout_ledger(spark, sf):
    return quality.payouts(quality.driver_balances(*_earnings(spark, sf)))


# ---- aggregation -------------------------------------------------------------------


@query
def fact_metric_bucket(spark, sf):
    """The whole fact table: all producers, all granularities."""
    return facts(spark, sf).select(*FACT)


@query
def driver_facts(spark, sf):
    return facts(spark, sf, parts=("drivers",)).select(*FACT)


@query
def passenger_facts(spark, sf):
    return facts(spark, sf, parts=("passengers",)).select(*FACT)


@query
def rejected_facts(spark, sf):
    """Facts that break a constraint: unknown metric, bad granularity, negative measure."""
    rows = facts(spark, sf, "DAY")
    spoiled = rows.withColumns(
        {
            "metric_name": F.expr("CASE WHEN seq % 4 = 1 THEN 'no_such_metric' ELSE metric_name END"),
            "bucket_granularity": F.expr("CASE WHEN seq % 4 = 2 THEN 'YEAR' ELSE bucket_granularity END"),
            "metric_value": F.expr("CASE WHEN seq % 4 = 3 THEN -metric_value ELSE metric_value END"),
        }
    )
    kept, rejected = buckets.split_valid(spoiled, metric_catalog(spark))
    tally = [f.groupBy("metric_name", F.lit(name).alias("verdict")).agg(F.count(F.lit(1)).alias("facts")) for name, f in (("kept", kept), ("rejected", rejected))]
    return union_all(tally)


@query
def catalog_coverage(spark, sf):
    """Facts per catalog metric; metrics nobody produces show zero."""
    counts = facts(spark, sf, "MONTH").groupBy("metric_name").agg(F.count(F.lit(1)).alias("facts"))
    cat = metric_catalog(spark).select("metric_name", "subject_area", "default_unit", "is_additive", is_valid().alias("valid"))
    return cat.join(counts, "metric_name", "left").withColumn("facts", F.coalesce("facts", F.lit(0)))


# ---- views -------------------------------------------------------------------------


@query
def vw_metric_minute(spark, sf):
    return views.metric_view(facts(spark, sf, "MINUTE"), metric_catalog(spark), "MINUTE", 6)


@query
def vw_metric_hourly(spark, sf):
    return views.metric_view(facts(spark, sf, "HOUR"), metric_catalog(spark), "HOUR", 6)


@query
def vw_metric_daily(spark, sf):
    return views.metric_view(facts(spark, sf, "DAY"), metric_catalog(spark), "DAY", 6)


def stored_facts(spark, sf, *granularities: str) -> DataFrame:
    """Facts by way of the partitioned mart table, as a dashboard would read them."""
    path = work_folder(spark, "mart")
    marts_io.write_table(facts(spark, sf, *granularities), path, "fact_metric_bucket")
    return marts_io.read_table(spark, path, "fact_metric_bucket")


@query
def mart_roundtrip(spark, sf):
    return stored_facts(spark, sf, "DAY", "MONTH").filter("bucket_granularity = 'MONTH'").select(*FACT)


@query
def vw_metric_daily_stored(spark, sf):
    return views.metric_view(stored_facts(spark, sf, "DAY", "MONTH"), metric_catalog(spark), "DAY", 6)


@query
def mart_refresh(spark, sf):
    """The fact mart built from the records up to 1996, then refreshed where the later ones fall."""
    path, log = work_folder(spark, "refreshed-mart"), marts.FactLog(spark, work_folder(spark, "refreshed-log"))
    everything, levels = minutes(spark, sf), ("DAY", "WEEK", "MONTH")
    later = F.col("bucket_start") >= F.lit("1997-01-01").cast("timestamp_ntz")
    log.write(everything.filter(~later), "all", 0)
    release(spark)
    marts.build_facts(log, "all", path, levels)
    log.write(everything.filter(later), "all", 1)
    release(spark)
    marts.refresh_facts(log, "all", 1, path, levels)
    return marts_io.read_table(spark, path, "fact_metric_bucket").select(*FACT)


@query
def vw_metric_weekly(spark, sf):
    return views.metric_view(facts(spark, sf, "WEEK"), metric_catalog(spark), "WEEK", 6)


@query
def vw_metric_monthly(spark, sf):
    return views.metric_view(facts(spark, sf, "MONTH"), metric_catalog(spark), "MONTH", 6)


@query
def vw_metric_scope_snapshot(spark, sf):
    return views.scope_snapshot(facts(spark, sf, "MINUTE"), metric_catalog(spark), "MINUTE", 6)


@query
def vw_metric_scope_all_granularities(spark, sf):
    """The scope snapshot over all five granularities at once."""
    return views.scope_snapshot(facts(spark, sf), metric_catalog(spark), None, 6)


@query
def realtime_kpi_metrics(spark, sf):
    return views.realtime_kpis(snapshot(spark, sf), metric_catalog(spark), 6).drop("description")


@query
def vw_latest_driver_location(spark, sf):
    return views.latest_driver_location(marts.location_timeseries(enriched(spark, sf))).drop("heading_degree", "speed_kmh")


@query
def vw_booking_route_paths(spark, sf):
    paths = views.booking_route_paths(routes(spark, sf))
    return paths.select(
        "booking_id", "segment_type", F.size("path_points").cast("bigint").alias("points"),
        F.array_join(F.transform("path_points", lambda p: F.concat_ws(" ", p["sequence_no"], p["lat"], p["lng"], F.date_format(p["event_time"], "yyyy-MM-dd HH:mm:ss"))), ";").alias("path"),
        "started_at", "ended_at", "last_received_at",
    )


def _freshness(spark, sf) -> DataFrame:
    """Freshness of the mart tables as written: the newest times are observed on the way out."""
    path = work_folder(spark, "fresh-mart")
    marts_io.write_table(facts(spark, sf, "MONTH"), path, "fact_metric_bucket")
    marts_io.write_table(marts.latest_snapshot(marts_io.read_table(spark, path, "fact_metric_bucket")), path, "latest_metric_snapshot")
    marts_io.write_table(marts.location_timeseries(enriched(spark, sf)), path, "driver_location_timeseries")
    marts_io.write_table(routes(spark, sf), path, "booking_route_segments")
    return views.with_lags(marts_io.read_freshness(spark, path), events_end(spark, sf) + timing.minutes(1))


@query
def vw_data_freshness(spark, sf):
    return _freshness(spark, sf)


@query
def dashboard_operations_realtime(spark, sf):
    # read twice, and dearer to make than to keep
    path = work_folder(spark, "operations-mart")
    marts_io.write_table(snapshot(spark, sf, parts=("bookings",)), path, "latest_metric_snapshot")
    rows = marts_io.read_table(spark, path, "latest_metric_snapshot")
    return views.operations_realtime(rows, rows.agg(F.max("last_updated")).scalar())


@query
def dashboard_operations_hourly(spark, sf):
    rows = facts(spark, sf, "HOUR", parts=("bookings",))
    end = bed.table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()
    return views.operations_hourly(rows, metric_catalog(spark), end, 6)


@query
def dashboard_driver_analytics(spark, sf):
    rows = facts(spark, sf, "DAY", "MONTH")
    return views.driver_analytics(marts.latest_snapshot(rows), rows, metric_catalog(spark), events_end(spark, sf))


@query
def dashboard_passenger_analytics(spark, sf):
    return views.passenger_analytics(facts(spark, sf, "DAY", parts=("passengers",)), metric_catalog(spark), events_end(spark, sf))


@query
def latest_kpis(spark, sf):
    return views.latest_kpis(snapshot(spark, sf))


@query
def latest_minutes(spark, sf):
    return views.latest_minutes(facts(spark, sf, "MINUTE"))


# ---- mart tables -------------------------------------------------------------------


@query
def fact_upsert(spark, sf):
    """Facts of half the driver stream, overwritten by the totals of all of it."""
    everything = facts(spark, sf, "DAY", parts=("drivers",))
    early = bed.driver_locations(spark, sf).filter("seq % 2 = 0")
    half = buckets.bucket_facts(drivers.driver_records(early, bed.driver_profiles(spark, sf)), ("DAY",))
    return marts.upsert_facts(half.select(*FACT), everything.select(*FACT))


@query
def latest_metric_snapshot(spark, sf):
    return snapshot(spark, sf)


@query
def driver_location_timeseries(spark, sf):
    return marts.location_timeseries(enriched(spark, sf)).drop("heading_degree", "speed_kmh")


@query
def latest_documents(spark, sf):
    return _shown_documents(marts.latest_documents(enriched(spark, sf)))


@query
def daily_documents(spark, sf):
    """Documents appended to one folder per UTC day, counted back per day and state."""
    folder = work_folder(spark, "documents")
    marts.append_daily_documents(enriched(spark, sf), folder, 0)
    back = spark.read.schema("driver_id string, seq bigint, document string, event_day string").json(folder)
    return _tallied_documents(back)


def _tallied_documents(documents: DataFrame) -> DataFrame:
    return documents.groupBy("event_day", F.get_json_object("document", "$.availability").alias("availability")).agg(
        F.count(F.lit(1)).alias("documents"), F.max("seq").alias("last_seq")
    )


def _altered_customers(spark, sf) -> tuple[DataFrame, DataFrame]:
    people = bed.table(spark, sf, "customer")
    altered = people.filter("c_custkey % 3 = 0").selectExpr("c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 10000000 END AS c_custkey", "concat(c_name, '!') AS c_name", "c_nationkey", "c_custkey AS unknown_column")
    return people, altered


@query
def upsert_do_nothing(spark, sf):
    return marts.upsert(*_altered_customers(spark, sf), "c_custkey")


@query
def upsert_do_update(spark, sf):
    return marts.upsert(*_altered_customers(spark, sf), "c_custkey", do_update=True)


# ---- audits ------------------------------------------------------------------------


@query
def audit_request_count(spark, sf):
    return quality.request_count_check(bed.bookings(spark, sf), facts(spark, sf, "MINUTE", parts=("bookings",)), F.lit("1995-01-01").cast("timestamp_ntz"))


@query
def audit_acceptance_rate(spark, sf):
    return quality.acceptance_check(facts(spark, sf, "HOUR", parts=("bookings",)), limit=None)


@query
def audit_acceptance_top(spark, sf):
    return quality.acceptance_check(facts(spark, sf, "DAY", parts=("bookings",)), "DAY")


@query
def audit_money(spark, sf):
    return quality.money_check(facts(spark, sf, "HOUR", parts=("bookings",)), limit=None)


@query
def audit_late_events(spark, sf):
    return quality.late_events(bed.bookings(spark, sf), facts(spark, sf, "MINUTE", parts=("bookings",)))


@query
def audit_sla(spark, sf):
    return quality.sla_status(_freshness(spark, sf))


@query
def audit_fares(spark, sf):
    whole = "CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST({} AS DECIMAL(6,4))) AS BIGINT)"
    lines = bed.table(spark, sf, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS booking_id",
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,4))) AS BIGINT) AS before_discount",
        f"{whole.format('l_discount')} AS discount",
        f"{whole.format('l_tax')} AS additional",
        "l_linenumber",
    )
    fares = lines.selectExpr("*", "before_discount - discount AS after_discount", "before_discount DIV 5 AS fee").selectExpr(
        "*", "after_discount + additional + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS total", "after_discount - fee + additional AS driver_income"
    )
    return quality.fare_check(fares)


@query
def audit_recent_writes(spark, sf):
    return quality.recent_writes(facts(spark, sf, "MINUTE"), events_end(spark, sf))


@query
def audit_completeness(spark, sf):
    return quality.completeness(_repeated_ends(spark, sf).unionByName(bed.bookings(spark, sf).filter("seq % 8 = 0")), facts(spark, sf, "DAY", parts=("bookings",)))


# ---- cohorts -----------------------------------------------------------------------


@query
def active_shifted(spark, sf):
    rows = facts(spark, sf, "DAY", parts=("drivers", "passengers"))
    return cohorts.shifted_active(rows, ["passenger", "driver"])


@query
def retention_churn_rates(spark, sf):
    rows = facts(spark, sf, "DAY", parts=("drivers", "passengers"))
    return cohorts.rates(rows, ["passenger", "driver"])


@query
def passenger_cohorts(spark, sf):
    return cohorts.cohort_retention(bed.passenger_activity(spark, sf).filter("type = 'COMPLETED'"), "passenger_id")


@query
def supply_demand_map(spark, sf):
    places = bed.driver_locations(spark, sf).withColumnRenamed("updated_at", "event_time")
    demand = places.filter("availability = 'BUSY'").select("lat", "lon", "event_time")
    return cohorts.heat_map(demand, places)


# ---- streams -----------------------------------------------------------------------


SLICE = "_slice"


def _slices(spark, rows: DataFrame, name: str, parts: int = 3, *more: DataFrame):
    """Rows as a file stream that grows by one slice of ``seq`` at a time, and at last by what ``more`` has.

    Yields the stream after each slice was written. A run over what is there takes a slice as
    one micro-batch, however many files it has, so the order of files never matters.
    """
    folder = work_folder(spark, name)
    files, feed = Folder(spark, folder), spark.readStream.schema(rows.schema)
    rows.write.options(**PACKED).parquet(f"{folder}/all")
    release(spark)
    kept = spark.read.schema(rows.schema).parquet(f"{folder}/all")
    low, high = kept.agg(F.min("seq"), F.max("seq")).first()
    slice_of = F.floor((F.col("seq") - low) * parts / (high - low + 1)) if low is not None else F.lit(0)
    # all slices in one pass; then they only have to be moved, and rows are there once
    kept.withColumn(SLICE, slice_of.cast("int")).write.partitionBy(SLICE).options(**PACKED).parquet(f"{folder}/slices")
    files.delete("all")
    files.make("feed")
    for i in range(parts):
        found = [file for file in files.names(f"slices/{SLICE}={i}") if file.endswith(".parquet")]
        for file in found:
            files.move(f"slices/{SLICE}={i}/{file}", f"feed/{i}-{file}")
        if not found:
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(f"{folder}/feed")
        yield feed.parquet(f"{folder}/feed")
        release(spark)
    for slice_ in more:
        slice_.write.mode("append").parquet(f"{folder}/feed")
        yield feed.parquet(f"{folder}/feed")
        release(spark)


def _finish(running) -> None:
    try:
        # a run over what is there ends by itself, however much that is
        running.awaitTermination()
    finally:
        running.stop()


NOW = {"availableNow": True}


@query
def stream_booking_facts(spark, sf):
    """Daily booking facts by way of the live job: JSON changes, state, delta log, roll-up."""
    job = jobs.BookingJob(spark, work_folder(spark, "booking-job"))
    for feed in _slices(spark, stored_changes(spark, sf, "booking"), "booking-feed"):
        _finish(job.start(cdc.bookings(feed), NOW))
    job.log.compact("bookings")
    return jobs.facts_of(job.log, ["bookings"], ("DAY",)).select(*FACT)


@query
def stream_registrations(spark, sf):
    log = work_folder(spark, "registrations")
    people = jobs.RegistrationJob(spark, log, "passengers", "passenger_id", "new_passenger", [])
    cars = jobs.RegistrationJob(spark, log, "drivers", "driver_id", "new_driver", DIMENSIONS)
    for feed in _slices(spark, bed.passengers(spark, sf), "people-feed"):
        _finish(people.start(feed, NOW))
    for feed in _slices(spark, bed.driver_profiles(spark, sf), "cars-feed"):
        _finish(cars.start(feed, NOW))
    return jobs.facts_of(cars.log, ["passengers", "drivers"]).select(*FACT)


def _parted(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions and profile changes of one feed."""
    profiles = feed.filter("NOT is_location").withColumns({"created_at": F.col("event_time"), "updated_at": F.col("event_time")})
    return feed.filter("is_location").withColumnRenamed("event_time", "updated_at"), profiles


def _driver_feed(spark, sf, name: str):
    """Positions and profile changes as one feed, so that arrival order decides who sees what."""
    return _slices(spark, jobs._driver_rows(bed.driver_locations(spark, sf), bed.driver_profiles(spark, sf)), name)


def _location_job(spark, sf) -> jobs.LocationJob:
    job = jobs.LocationJob(spark, work_folder(spark, "location-job"))
    for feed in _driver_feed(spark, sf, "location-feed"):
        _finish(job.start(*_parted(feed), NOW))
    return job


@query
def stream_locations(spark, sf):
    return _location_job(spark, sf).timeseries().drop("heading_degree", "speed_kmh")


def _shown_documents(documents: DataFrame) -> DataFrame:
    doc = F.col("document")
    return documents.select(
        "driver_id",
        *[F.get_json_object(doc, f"$.{n}").alias(n) for n in ("availability", "serviceType", "areaCode")],
        F.get_json_object(doc, "$.location.lat").cast("double").alias("lat"),
        F.get_json_object(doc, "$.@timestamp").alias("moment"),
    )


@query
def stream_documents(spark, sf):
    """Latest documents as the live job keeps them, batch by batch."""
    return _shown_documents(_location_job(spark, sf).latest_documents())


@query
def stream_daily_documents(spark, sf):
    """Daily documents of the live job, counted back per day and state."""
    return _tallied_documents(_location_job(spark, sf).daily_documents())


@query
def stream_driver_records(spark, sf):
    """Daily driver facts of the live job, churn left to its own query."""
    job = jobs.RecordJob(spark, work_folder(spark, "driver-job"), "drivers")
    for feed in _driver_feed(spark, sf, "driver-feed"):
        _finish(job.start(jobs.live_driver_records(*_parted(feed)), NOW))
    return jobs.facts_of(job.log, ["drivers"], ("DAY",)).select(*FACT)


@query
def stream_driver_churn(spark, sf):
    """Daily churn of drivers by event-time timers of the live job."""
    job = jobs.RecordJob(spark, work_folder(spark, "driver-churn-job"), "churn")
    for feed in _driver_feed(spark, sf, "driver-churn-feed"):
        _finish(job.start(jobs.live_driver_churn(*_parted(feed)), NOW, event_time=True))
    return jobs.facts_of(job.log, ["churn"], ("DAY",)).select(*FACT)


@query
def stream_passenger_churn(spark, sf):
    """Daily churn of passengers by event-time timers of the live job."""
    job = jobs.RecordJob(spark, work_folder(spark, "passenger-churn-job"), "churn")
    for feed in _slices(spark, bed.passenger_activity(spark, sf), "churn-feed"):
        _finish(job.start(jobs.live_passenger_churn(feed), NOW, event_time=True))
    return jobs.facts_of(job.log, ["churn"], ("DAY",)).select(*FACT)


@query
def stream_passenger_records(spark, sf):
    """Daily passenger facts of the live job, churn left to its own query."""
    job = jobs.RecordJob(spark, work_folder(spark, "passenger-job"), "passengers")
    for feed in _slices(spark, bed.passenger_activity(spark, sf), "activity-feed"):
        _finish(job.start(jobs.live_passenger_records(feed), NOW))
    return jobs.facts_of(job.log, ["passengers"], ("DAY",)).select(*FACT)


@query
def stream_chained(spark, sf):
    """Passenger KPIs per day by one query from booking changes on: lives, then activity, then counts.

    Changes arrive in the order of their times. Two last changes, forty and eighty days on, take the
    stream past every churn.
    """
    # batch forgets nobody
    job = jobs.PassengerDayJob(spark, work_folder(spark, "chained-job"), idle_days=36_500)
    changes = _by_time(bed.bookings(spark, sf))
    end = changes.agg(F.max("updated_at")).scalar()
    for feed in _slices(spark, changes, "chained-feed", 3, *[_closing(spark, changes, end + timing.days(n)) for n in (40, 80)]):
        _finish(job.start(feed, NOW))
    return job.days()


def _by_time(changes: DataFrame) -> DataFrame:
    """Changes numbered by their times, to the microsecond and then by their number so far."""
    return changes.withColumn("seq", jobs.micros("updated_at") + F.pmod("seq", F.lit(1_000)))


def _closing(spark, changes: DataFrame, moment) -> DataFrame:
    """One change of no booking at a moment."""
    values = {"booking_id": F.lit("closing"), "op": F.lit("u"), "status": F.lit(""), "created_at": moment, "updated_at": moment, "ingest_ts": moment}
    last = [values[f.name].alias(f.name) if f.name in values else F.lit(None).cast(f.dataType).alias(f.name) for f in changes.schema if f.name != "seq"]
    return spark.range(1).select(*last).withColumn("seq", jobs.micros("updated_at")).select(*changes.columns)


@query
def stream_snapshot(spark, sf):
    """The latest snapshot as a keyed table that each batch merges into; the second batch comes twice."""
    job = jobs.SnapshotJob(spark, work_folder(spark, "snapshot-job"))
    records = union_all([r.select(*RECORD) for r in _all_records(spark, sf)])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        job.write_batch(batch, batch_id)
        if batch_id == 1:
            job.write_batch(batch, batch_id)

    for feed in _slices(spark, records, "record-feed"):
        _finish(jobs.start(feed, write_batch, f"{job.path}/checkpoint", NOW))
    return job.snapshot()


@query
def stream_replay(spark, sf):
    """Daily booking facts of a job that dies twice after its state was committed and before its sink was."""
    job = jobs.BookingJob(spark, work_folder(spark, "replay-job"))
    for number, feed in enumerate(_slices(spark, stored_changes(spark, sf, "booking"), "replay-feed")):
        if number < 2:
            _die_after_state(job, cdc.bookings(feed))
        _finish(job.start(cdc.bookings(feed), NOW))
    return jobs.facts_of(job.log, ["bookings"], ("DAY",)).select(*FACT)


class Died(RuntimeError):
    pass


def _die_after_state(job: jobs.BookingJob, bookings: DataFrame) -> None:
    def write_half(batch: DataFrame, batch_id: int) -> None:
        # all of the state is computed and committed with this; the facts are never written
        job.fire(batch, batch_id)
        raise Died("stopped between state and sink")

    running = jobs.start(bookings, write_half, f"{job.path}/checkpoint/bookings", NOW)
    try:
        running.awaitTermination()
    except StreamingQueryException as error:
        if "stopped between state and sink" not in str(error):
            raise
    else:
        raise AssertionError("the job was to die")


@query
def stream_late_booking(spark, sf):
    """Requests per minute, hour and day where every seventh booking comes long after its time.

    Two sources of one job: what is on time, and what comes behind the watermark of the first. Buckets
    that were closed long ago are corrected.
    """
    job = jobs.BookingJob(spark, work_folder(spark, "late-job"))
    late = F.pmod(F.col("booking_id").cast("bigint"), F.lit(7)) == 0
    changes = bed.bookings(spark, sf)
    held_back = F.when(late, F.col("seq") + changes.agg(F.max("seq")).scalar() + 1).otherwise(F.col("seq"))
    for feed in _slices(spark, changes.withColumn("seq", held_back), "late-feed", 4):
        _finish(job.start(feed, NOW))
    found = jobs.facts_of(job.log, ["bookings"], ("MINUTE", "HOUR", "DAY"))
    return found.filter("metric_name = 'request_order'").select(*[c for c in FACT if c not in ("last_updated",)])
