"""Row shapes shared by every operator. Timestamps are UTC (see functions.timing)."""

from __future__ import annotations

WIDE = "decimal(24,9)"  # a measure in flight: exact sums, whatever the order of rows
MART = "decimal(20,6)"  # a measure in a mart table
COORDINATE = "decimal(10,6)"

BOOKING = (
    "booking_id string, passenger_id string, op string, status string, service_type string, "
    "service_tier string, area_code string, platform_fee double, discount_amount double, "
    "pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, "
    "created_at timestamp_ntz, accepted_at timestamp_ntz, start_trip_at timestamp_ntz, "
    "completed_at timestamp_ntz, updated_at timestamp_ntz, seq bigint, ingest_ts timestamp_ntz"
)
PASSENGER = (
    "passenger_id string, op string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "seq bigint, ingest_ts timestamp_ntz"
)
DRIVER = (
    "driver_id string, op string, service_type string, service_tier string, area_code string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, seq bigint, ingest_ts timestamp_ntz"
)
DRIVER_LOCATION = (
    "driver_id string, op string, availability string, lat double, lon double, "
    "updated_at timestamp_ntz, seq bigint, ingest_ts timestamp_ntz"
)

DIMENSIONS = ["service_type", "service_tier", "area_code"]
SCOPE = [*DIMENSIONS, "cohort_key", "entity_type", "entity_id"]
MEASURES = ["metric_value", "numerator_value", "denominator_value", "sample_size"]
FACT_KEY = ["metric_name", "bucket_start", "bucket_granularity", *SCOPE]
SNAPSHOT_KEY = ["metric_name", *SCOPE]

# Rows a metric producer gives: one per contribution, before any bucketing.
RECORD = [
    "metric_name", "metric_unit", *DIMENSIONS, "event_time", "processed_at", *MEASURES, "seq",
]
FACT = [
    *FACT_KEY, *MEASURES, "first_event_at", "last_event_at", "last_ingested_at",
    "processing_lag_ms", "last_updated",
]
SNAPSHOT = [
    *SNAPSHOT_KEY, *MEASURES, "metric_unit", "data_granularity", "event_time",
    "last_ingested_at", "last_updated",
]
LOCATION = [
    "driver_id", "event_time", *DIMENSIONS, "latitude", "longitude", "heading_degree",
    "speed_kmh", "driver_status", "received_at",
]
ROUTE = ["booking_id", "segment_type", "sequence_no", "latitude", "longitude", "event_time", "received_at"]
