"""Registered queries against independent SQL on the smallest tables.

All of them run with WAYMETER_ALL=1; by default a cross-section does, to stay quick.
"""

import os

import check
import pytest

import __spark_entry__ as entry_point

SF = f"{check.TESTDATA}/sf0.001"
QUICK = [
    "cdc_bookings", "cdc_drivers", "cdc_driver_locations", "cdc_file_source", "time_buckets", "time_differences",
    "text_functions", "number_fields", "decoded_points", "revenue_columns", "booking_records", "booking_repeated_ends",
    "passenger_activity_records", "driver_records", "booking_routes", "enriched_locations", "sticky_dimensions",
    "missing_fares", "payout_ledger", "fact_metric_bucket", "rejected_facts", "catalog_coverage", "vw_metric_daily",
    "vw_metric_scope_snapshot", "realtime_kpi_metrics", "vw_latest_driver_location", "vw_booking_route_paths",
    "vw_data_freshness", "dashboard_driver_analytics", "dashboard_passenger_analytics", "latest_minutes", "fact_upsert",
    "latest_documents", "daily_documents", "upsert_do_nothing", "upsert_do_update", "audit_request_count",
    "audit_acceptance_top", "audit_money", "audit_fares", "audit_completeness", "active_shifted",
    "retention_churn_rates", "passenger_cohorts", "supply_demand_map", "stream_registrations", "stream_booking_facts",
    "stream_locations", "stream_driver_records", "stream_passenger_records", "mart_roundtrip", "vw_metric_daily_stored",
    "stream_driver_churn", "stream_passenger_churn", "stream_documents", "stream_snapshot", "stream_late_booking", "stream_chained",
]
from oracle.sql import ORACLE  # noqa: E402
from waymeter.registry import QUERIES  # noqa: E402

CHOSEN = list(QUERIES) if os.environ.get("WAYMETER_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_oracle(spark, con, name):
    assert check.differences(spark, con, name, QUERIES[name], ORACLE[name], SF) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_point_has_them_all():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_stored_views_prune_folders(spark):
    from waymeter import registry

    plan = registry.stored_facts(spark, SF, "DAY", "MONTH").filter("bucket_granularity = 'DAY'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_granularity" in plan


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert "metric_value" in df.columns and df.limit(1).count() == 1
