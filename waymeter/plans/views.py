"""Reporting views over the mart tables.

Each is a function of its input frames. Where a view looks back from now, ``as_of`` is
an explicit parameter, so results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import timing
from waymeter.operators.buckets import ratio_of
from waymeter.operators.keyed import latest, union_all
from waymeter.schema import LOCATION, MEASURES, SCOPE

BUCKET_COLUMN = {
    "MINUTE": "bucket_start", "HOUR": "bucket_hour", "DAY": "bucket_day",
    "WEEK": "bucket_week", "MONTH": "bucket_month",
}
DESCRIPTION = ["display_name", "subject_area", "metric_group", "value_type", "default_unit"]

# Metrics shown on each dashboard.
OPERATIONS_REALTIME = [
    "request_order", "accept_order", "acceptance_rate", "completed_order", "completed_rate", "gsv",
    "revenue_vat", "revenue_net", "cancel_order", "cancel_rate", "order_time", "board_time",
    "lead_time", "accept_time",
]
OPERATIONS_HOURLY = ["request_order", "accept_order", "completed_order", "cancel_order"]
DRIVER_REALTIME = ["online_driver", "busy_driver", "net_driver_income"]
DRIVER_DAILY = ["new_driver", "active_driver", "retention_driver", "churn_driver", "productivity"]
PASSENGER_DAILY = [
    "new_passenger", "active_passenger", "retention_passenger", "churn_passenger", "return_passenger",
]


def _shown(digits: int | None) -> Column:
    return ratio_of(F.col("is_additive"), *[F.col(name) for name in MEASURES], digits=digits)


def _described(facts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Facts with their catalog row; supporting metrics are hidden.

    The catalog is a constant of 41 rows, so broadcasting it is always safe.
    """
    return facts.join(F.broadcast(catalog.filter("subject_area <> 'Derived'")), "metric_name")


def metric_view(facts: DataFrame, catalog: DataFrame, granularity: str, digits: int | None = None) -> DataFrame:
    """Metrics of one granularity with rates worked out."""
    bucket = BUCKET_COLUMN[granularity]
    method = ["aggregation_method"] if granularity == "MINUTE" else []
    # filtered before the join, so the fact scan prunes to one granularity
    rows = _described(facts.filter(F.col("bucket_granularity") == granularity), catalog)
    return rows.select(
        F.col("bucket_start").alias(bucket),
        *SCOPE,
        "metric_name",
        *DESCRIPTION,
        *method,
        "lower_is_better",
        _shown(digits).alias("metric_value"),
        *MEASURES[1:],
        "first_event_at",
        "last_event_at",
        "last_ingested_at",
        "processing_lag_ms",
        "last_updated",
    )


def scope_snapshot(
    facts: DataFrame, catalog: DataFrame, granularity: str | None = "MINUTE", digits: int | None = None
) -> DataFrame:
    """Totals per metric and scope over all time.

    One granularity is summed; None sums all five, which counts additive metrics five
    times. Facts are summed before the catalog is joined.
    """
    rows = facts if granularity is None else facts.filter(F.col("bucket_granularity") == granularity)
    totals = rows.groupBy(*SCOPE, "metric_name").agg(
        *[F.sum(name).alias(name) for name in MEASURES],
        F.max("last_event_at").alias("last_event_at"),
        F.max("last_ingested_at").alias("last_ingested_at"),
    )
    return _described(totals, catalog).select(
        *SCOPE,
        "metric_name",
        *DESCRIPTION,
        "lower_is_better",
        _shown(digits).alias("metric_value"),
        *MEASURES[1:],
        "last_event_at",
        "last_ingested_at",
    )


def realtime_kpis(snapshot: DataFrame, catalog: DataFrame, digits: int | None = None) -> DataFrame:
    """Latest KPIs with their catalog description."""
    known = F.broadcast(catalog)
    rows = snapshot.join(known, "metric_name", "left").filter("subject_area <> 'Derived'")
    return rows.select(
        "metric_name", "display_name", "subject_area", "metric_group", "value_type",
        F.coalesce("metric_unit", "default_unit").alias("unit"),
        "description", "aggregation_method", "lower_is_better", "is_realtime", "data_granularity",
        *SCOPE,
        _shown(digits).alias("metric_value"),
        *MEASURES[1:],
        "event_time", "last_ingested_at", "last_updated",
    )


def latest_driver_location(locations: DataFrame) -> DataFrame:
    """Newest position per driver."""
    return latest(locations, ["driver_id"], "event_time", [c for c in LOCATION if c != "driver_id"])


def booking_route_paths(segments: DataFrame) -> DataFrame:
    """Points of each path in order, as one array per booking and segment type.

    The result holds a whole path in one row, so a path is gathered in one place; a
    path has one point per sequence number.
    """
    point = F.struct(
        "sequence_no", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), "event_time"
    )
    return segments.groupBy("booking_id", "segment_type").agg(
        F.array_sort(F.collect_list(point)).alias("path_points"),
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("ended_at"),
        F.max("received_at").alias("last_received_at"),
    )


def data_freshness(
    facts: DataFrame, snapshot: DataFrame, locations: DataFrame, segments: DataFrame, as_of: Column
) -> DataFrame:
    """Ingestion and processing lag of the four mart tables."""
    sources = {
        "fact_metric_bucket": (facts, "last_event_at", "last_ingested_at"),
        "latest_metric_snapshot": (snapshot, "event_time", "last_ingested_at"),
        "driver_location_timeseries": (locations, "event_time", "received_at"),
        "booking_route_segments": (segments, "event_time", "received_at"),
    }
    ends = [
        frame.agg(F.max(event).alias("last_event_time"), F.max(received).alias("last_ingested_at")).select(
            F.lit(name).alias("source_name"), "last_event_time", "last_ingested_at"
        )
        for name, (frame, event, received) in sources.items()
    ]
    return with_lags(union_all(ends), as_of)


def with_lags(ends: DataFrame, as_of: Column) -> DataFrame:
    """Ingestion and processing lag, from the newest times of each table."""
    return ends.select(
        "*",
        timing.rounded_seconds(F.col("last_ingested_at"), as_of).alias("ingestion_lag_seconds"),
        timing.rounded_seconds(F.col("last_event_time"), F.col("last_ingested_at")).alias("processing_lag_seconds"),
    )


def operations_realtime(snapshot: DataFrame, as_of: Column) -> DataFrame:
    """Operation KPIs updated in the last five minutes; raw values with their parts."""
    recent = F.col("last_updated") >= as_of - timing.minutes(5)
    return snapshot.filter(F.col("metric_name").isin(OPERATIONS_REALTIME) & recent).select(
        "metric_name", "service_type", "service_tier", "area_code", *MEASURES[:3], "metric_unit",
        "event_time", "last_updated",
    )


def operations_hourly(facts: DataFrame, catalog: DataFrame, as_of: Column, digits: int | None = None) -> DataFrame:
    """Hourly operation counts of the last 24 hours."""
    wanted = facts.filter(F.col("metric_name").isin(OPERATIONS_HOURLY) & (F.col("bucket_start") >= as_of - timing.days(1)))
    return metric_view(wanted, catalog, "HOUR", digits).select(
        "bucket_hour", "metric_name", "service_type", "service_tier", "area_code", *MEASURES[:3]
    )


def _recent_days(facts: DataFrame, names: list[str], as_of: Column) -> DataFrame:
    start = as_of.cast("date").cast("timestamp_ntz") - timing.days(90)
    return facts.filter(F.col("metric_name").isin(names) & (F.col("bucket_start") >= start))


def driver_analytics(
    snapshot: DataFrame, facts: DataFrame, catalog: DataFrame, as_of: Column, digits: int = 6
) -> DataFrame:
    """Live driver KPIs and 90 days of daily ones, in one list."""
    live = snapshot.filter(F.col("metric_name").isin(DRIVER_REALTIME)).select(
        "metric_name", "service_type", "service_tier", "area_code",
        F.col("metric_value").cast("double").alias("metric_value"), "last_updated",
    )
    days = metric_view(_recent_days(facts, DRIVER_DAILY, as_of), catalog, "DAY")
    daily = (
        days.groupBy(F.col("bucket_day").cast("date").alias("date"), "metric_name", "service_type", "service_tier", "area_code")
        .agg(F.round(F.sum("metric_value"), digits).alias("metric_value"))
        .select(
            "metric_name", "service_type", "service_tier", "area_code", "metric_value",
            F.col("date").cast("timestamp_ntz").alias("last_updated"),
        )
    )
    return live.union(daily)


def passenger_analytics(facts: DataFrame, catalog: DataFrame, as_of: Column) -> DataFrame:
    """Daily passenger KPIs of 90 days by cohort."""
    days = metric_view(_recent_days(facts, PASSENGER_DAILY, as_of), catalog, "DAY")
    return days.groupBy(F.col("bucket_day").cast("date").alias("date"), "metric_name", "cohort_key").agg(
        *[F.sum(name).alias(name) for name in MEASURES[:3]]
    )


def latest_kpis(snapshot: DataFrame, limit: int = 10) -> DataFrame:
    """The most recently updated KPIs."""
    tie_break = [F.col(c) for c in ("metric_name", *SCOPE)]
    return (
        snapshot.orderBy(F.col("last_updated").desc(), *tie_break)
        .limit(limit)
        .select("metric_name", "service_type", "service_tier", "area_code", "metric_value", "last_updated")
    )


def latest_minutes(facts: DataFrame, limit: int = 10) -> DataFrame:
    """The newest minute facts."""
    tie_break = [F.col(c) for c in ("metric_name", *SCOPE)]
    return (
        facts.filter("bucket_granularity = 'MINUTE'")
        .orderBy(F.col("bucket_start").desc(), *tie_break)
        .limit(limit)
        .select("bucket_start", "metric_name", "service_type", "service_tier", "area_code", "metric_value")
    )


def register_views(facts: DataFrame, snapshot: DataFrame, locations: DataFrame, segments: DataFrame, catalog: DataFrame, as_of: Column) -> None:
    """Register every report as a temporary view, for SQL clients of the session."""
    reports = {
        "vw_metric_minute": metric_view(facts, catalog, "MINUTE"),
        "vw_metric_hourly": metric_view(facts, catalog, "HOUR"),
        "vw_metric_daily": metric_view(facts, catalog, "DAY"),
        "vw_metric_weekly": metric_view(facts, catalog, "WEEK"),
        "vw_metric_monthly": metric_view(facts, catalog, "MONTH"),
        "vw_metric_scope_snapshot": scope_snapshot(facts, catalog),
        "realtime_kpi_metrics": realtime_kpis(snapshot, catalog),
        "vw_latest_driver_location": latest_driver_location(locations),
        "vw_booking_route_paths": booking_route_paths(segments),
        "vw_data_freshness": data_freshness(facts, snapshot, locations, segments, as_of),
        "dashboard_operations_realtime": operations_realtime(snapshot, as_of),
        "dashboard_operations_hourly": operations_hourly(facts, catalog, as_of),
        "dashboard_driver_analytics": driver_analytics(snapshot, facts, catalog, as_of),
        "dashboard_passenger_analytics": passenger_analytics(facts, catalog, as_of),
    }
    for name, frame in reports.items():
        frame.createOrReplaceTempView(name)
