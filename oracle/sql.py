"""Oracle SQL by query name."""

from __future__ import annotations

import re

from oracle.parts import BOOKING_METRICS, CTES, DIMS, GRANS, MEASURES, SNAPSHOT, booking_records, bucket, compose, day, facts_cte, passenger_activity

FACT = "metric_name, bucket_start, bucket_granularity, service_type, service_tier, area_code, cohort_key, entity_type, entity_id, metric_value, numerator_value, denominator_value, sample_size, first_event_at, last_event_at, last_ingested_at, processing_lag_ms, last_updated"
RECORD = f"metric_name, metric_unit, {DIMS}, ev AS event_time, proc AS processed_at, " + ", ".join(f"CAST({m} AS DECIMAL(20,6)) AS {m}" for m in MEASURES) + ", seq"
DESCRIPTION = "c.display_name, c.subject_area, c.metric_group, c.value_type, c.default_unit"
SCOPE = "f.service_type, f.service_tier, f.area_code, f.cohort_key, f.entity_type, f.entity_id"


def shown(prefix: str = "f.", digits: int | None = 6) -> str:
    v, n, d, s = (f"CAST({prefix}{m} AS DOUBLE)" for m in MEASURES)
    value = f"CASE WHEN c.is_additive THEN {v} WHEN {d} > 0 THEN {n} / {d} WHEN {s} > 0 THEN {n} / {s} END"
    return value if digits is None else f"round({value}, {digits})"


def on_facts(body: str, records: str = "records_all", grans=GRANS, **more: str) -> str:
    return compose(body, facts=facts_cte(records, grans), snapshot=SNAPSHOT, **more)


def view(gran: str, column: str, method: str = "") -> str:
    return on_facts(
        f"SELECT f.bucket_start AS {column}, {SCOPE}, f.metric_name, {DESCRIPTION}, {method} c.lower_is_better, {shown()} AS metric_value, "
        "f.numerator_value, f.denominator_value, f.sample_size, f.first_event_at, f.last_event_at, f.last_ingested_at, f.processing_lag_ms, f.last_updated "
        "FROM facts f JOIN catalog c ON c.metric_name = f.metric_name WHERE c.subject_area <> 'Derived'",
        grans=[gran],
    )


def scope_view(grans) -> str:
    totals = f"SELECT {SCOPE}, f.metric_name, " + ", ".join(f"sum(f.{m}) AS {m}" for m in MEASURES) + f", max(f.last_event_at) AS last_event_at, max(f.last_ingested_at) AS last_ingested_at FROM facts f GROUP BY {SCOPE}, f.metric_name"
    return on_facts(
        f"SELECT {SCOPE}, f.metric_name, {DESCRIPTION}, c.lower_is_better, {shown()} AS metric_value, f.numerator_value, f.denominator_value, f.sample_size, f.last_event_at, f.last_ingested_at "
        "FROM totals f JOIN catalog c ON c.metric_name = f.metric_name WHERE c.subject_area <> 'Derived'",
        grans=grans,
        totals=totals,
    )


def freshness() -> str:
    lag = "CAST(round((epoch_us({b}) - epoch_us({a})) / 1000000.0) AS INTEGER)"
    ends = """SELECT 'fact_metric_bucket' AS source_name, max(last_event_at) AS last_event_time, max(last_ingested_at) AS last_ingested_at FROM facts
        UNION ALL SELECT 'latest_metric_snapshot', max(event_time), max(last_ingested_at) FROM snapshot
        UNION ALL SELECT 'driver_location_timeseries', max(event_time), max(received_at) FROM timeseries
        UNION ALL SELECT 'booking_route_segments', max(event_time), max(received_at) FROM segments"""
    now = "((SELECT max(ts) FROM events) + INTERVAL 1 MINUTE)"
    return f"SELECT *, {lag.format(a='last_ingested_at', b=now)} AS ingestion_lag_seconds, {lag.format(a='last_event_time', b='last_ingested_at')} AS processing_lag_seconds FROM ({ends})"


REPEATED = (
    "SELECT * FROM records_b UNION ALL SELECT * FROM ("
    + booking_records("o", [(*m[:8], f"{m[8]} AND k%5 = 0") for m in BOOKING_METRICS if m[2] == "completed_at" and m[0] not in ("board_time", "board_time_total")])
    + ")"
)
TALLY = "SELECT metric_name, CAST(sum(metric_value) AS DECIMAL(20,6)) AS metric_value, count(*) AS records FROM {} GROUP BY metric_name"

ORACLE: dict[str, str] = {
    "cdc_bookings": compose(
        f"""SELECT booking_id, passenger_id, op, status, {DIMS}, fee AS platform_fee, CASE WHEN k%7 = 0 THEN 0 ELSE discount END AS discount_amount,
        pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, created_at, CASE WHEN step >= 1 THEN accepted_at END AS accepted_at,
        CASE WHEN step >= 2 AND outcome = 'F' THEN start_trip_at END AS start_trip_at, CASE WHEN step = 3 AND outcome = 'F' THEN completed_at END AS completed_at,
        updated_at, seq, updated_at + to_seconds(k%4+1) AS ingest_ts FROM changes"""
    ),
    "cdc_passengers": compose(
        "SELECT id AS passenger_id, CASE event_type WHEN 'signup' THEN 'c' ELSE 'u' END AS op, date_trunc('second', ts) AS created_at, date_trunc('second', ts) AS updated_at, seq, ingest AS ingest_ts FROM ev WHERE event_type IN ('signup','view') AND seq%5 <> 0"
    ),
    "cdc_drivers": compose(
        """SELECT id AS driver_id, 'c' AS op, pst AS service_type, CAST(NULL AS VARCHAR) AS service_tier, coalesce(parea, '') AS area_code, date_trunc('second', ts) AS created_at, date_trunc('second', ts) AS updated_at, seq, ingest AS ingest_ts
        FROM profiled WHERE event_type = 'signup' AND seq%5 <> 0"""
    ),
    "cdc_driver_locations": compose(
        "SELECT id AS driver_id, 'r' AS op, avail AS availability, lat, lon, date_trunc('second', ts) AS updated_at, seq, ingest AS ingest_ts FROM located WHERE seq%4 <> 3"
    ),
    "cdc_file_source": compose(
        """SELECT id AS passenger_id, CASE WHEN seq%5 = 0 THEN 'r' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op, date_trunc('second', ts) AS created_at, date_trunc('second', ts) AS updated_at, seq, ingest AS ingest_ts
        FROM ev WHERE event_type IN ('signup','view') AND ingest >= TIMESTAMP '2024-01-15 00:00:00'"""
    ),
    "cdc_event_time": compose("SELECT seq, date_trunc('second', ts) AS event_ts FROM ev WHERE event_type IN ('signup','view')"),
    "time_buckets": " UNION ALL ".join(
        f"SELECT event_id, '{g}' AS bucket_granularity, {bucket(g, 'ts')} AS bucket_start, {bucket(g, 'ts')} + INTERVAL 8 HOUR + INTERVAL 1 {g} - INTERVAL 8 HOUR AS bucket_end FROM events" for g in GRANS
    ),
    "time_differences": compose(
        f"""SELECT booking_id, CAST((k%5+1 + k%7+1 + k%26+5)*60 AS DOUBLE) AS lead_seconds, CAST(date_diff('day', {day('created_at')}, {day("completed_at + INTERVAL 2 DAY")}) AS INTEGER) AS day_gap, 0 AS no_lag_ms,
        CAST((k%7+1 + k%26+5)*60000 AS INTEGER) AS lag_ms, CAST((k%5+1 + k%7+1)*60 + 1 AS INTEGER) AS rounded_seconds, CAST(completed_at AS DATE) AS completed_date FROM base"""
    ),
    "text_functions": r"""SELECT c_custkey, lower(regexp_replace(replace('service-' || n_name || 'TypeCode', '-', '_'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake,
        'nation' || split_part(n_name, '_', 2) || 'Code' AS camel,
        coalesce(nullif(CASE WHEN c_custkey%3 = 0 THEN '' ELSE c_mktsegment END, ''), n_name) AS first_text,
        CASE WHEN c_custkey%3 = 0 THEN '' ELSE c_mktsegment END AS resolved, c_custkey%4 <> 3 AS online, c_custkey%4 = 0 AS status_hit
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "number_fields": "SELECT o_orderkey, CASE o_orderkey%5 WHEN 2 THEN 100.0 WHEN 3 THEN CAST(o_orderkey AS DOUBLE) ELSE 0.0 END AS number FROM orders",
    "decoded_points": compose("SELECT seq, CASE WHEN seq%3 < 2 THEN lon END AS lon, CASE WHEN seq%3 < 2 THEN lat END AS lat FROM located"),
    "revenue_columns": compose("SELECT booking_id, fee + discount AS gsv, round(fee * (CAST(1 AS DOUBLE) / CAST(1.1 AS DOUBLE)), 4) AS revenue_net, greatest(0, fee + discount - fee) AS net_driver_income FROM o"),
    "metric_keys": on_facts(
        "SELECT concat_ws('|', metric_name, bucket_granularity, strftime(bucket_start, '%Y-%m-%dT%H:%M:%SZ'), service_type, service_tier, area_code, cohort_key, entity_type, entity_id) AS metric_key, metric_value FROM facts",
    ),
    "booking_triggers": compose(
        " UNION ALL ".join(
            f"SELECT booking_id, passenger_id, '{kind}' AS kind, {at} AS event_time, {DIMS}, CAST({fee} AS DOUBLE) AS platform_fee, CAST({discount} AS DOUBLE) AS discount_amount, "
            f"CAST({accept} AS DOUBLE) AS accept_seconds, CAST({board} AS DOUBLE) AS board_seconds, CAST({lead} AS DOUBLE) AS lead_seconds, "
            + ", ".join(f"CAST({p if kind == 'REQUESTED' else 'NULL'} AS DOUBLE) AS {p}" for p in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"))
            + f", k*4+{step} AS seq FROM o WHERE {where}"
            for kind, at, fee, discount, accept, board, lead, step, where in (
                ("REQUESTED", "created_at", "NULL", "NULL", "NULL", "NULL", "NULL", 0, "true"),
                ("ACCEPTED", "accepted_at", "NULL", "NULL", "(k%5+1)*60", "NULL", "NULL", 1, "outcome IN ('F','P')"),
                ("COMPLETED", "completed_at", "fee", "discount", "NULL", "(k%26+5)*60", "(k%5+1+k%7+1+k%26+5)*60", 3, "outcome = 'F'"),
                ("CANCELED", "canceled_at", "NULL", "NULL", "NULL", "NULL", "NULL", 3, "outcome = 'P'"),
            )
        )
    ),
    "booking_records": compose(f"SELECT {RECORD} FROM records_b"),
    "booking_repeated_ends": compose(TALLY.format("repeated"), repeated=REPEATED),
    "booking_first_ends": compose(TALLY.format("records_b")),
    "passenger_registrations": compose(f"SELECT {RECORD} FROM new_passengers"),
    "driver_registrations": compose(f"SELECT {RECORD} FROM new_drivers"),
    "passenger_activity_records": compose(f"SELECT {RECORD} FROM activity"),
    "driver_records": compose(f"SELECT {RECORD} FROM driving"),
    "booking_activity": compose(
        """SELECT passenger_id, 'REQUESTED' AS type, created_at AS event_time, k*4 AS seq FROM o
        UNION ALL SELECT passenger_id, 'ACCEPTED', accepted_at, k*4+1 FROM o WHERE outcome IN ('F','P')
        UNION ALL SELECT passenger_id, 'COMPLETED', completed_at, k*4+3 FROM o WHERE outcome = 'F'
        UNION ALL SELECT passenger_id, 'CANCELED', canceled_at, k*4+3 FROM o WHERE outcome = 'P'"""
    ),
    "booking_passenger_days": compose(
        f"SELECT metric_name, {day('ev')} AS day, count(*) AS records FROM found GROUP BY ALL",
        trips2=f"""SELECT passenger_id AS id, completed_at AS ts, completed_at + to_seconds(k%4+1) AS ingest, k*4+3 AS seq, {day('completed_at')} AS d,
            lag(completed_at) OVER w AS pts, lag({day('completed_at')}) OVER w AS pday, lead(k) OVER w AS nseq,
            (SELECT max(greatest(CASE WHEN outcome = 'F' THEN completed_at WHEN outcome = 'P' THEN canceled_at END, created_at)) FROM o) AS stream_end
            FROM o WHERE outcome = 'F' WINDOW w AS (PARTITION BY passenger_id ORDER BY k)""",
        found=passenger_activity("trips2"),
    ),
    "booking_routes": compose("SELECT * FROM segments"),
    "granularity_records": compose(
        " UNION ALL ".join(f"SELECT metric_name, '{g}' AS bucket_granularity, {bucket(g, 'ev')} AS bucket_start, ev AS event_time, seq FROM new_passengers" for g in GRANS)
    ),
    "enriched_locations": compose(f"SELECT id AS driver_id, seq, ts AS updated_at, avail AS availability, {DIMS}, lat, lon FROM located"),
    "sticky_dimensions": compose(
        f"SELECT metric_name, {DIMS}, CAST(sum(metric_value) AS DECIMAL(20,6)) AS metric_value FROM driving GROUP BY ALL",
        carried="""SELECT *, coalesce(last_value(CASE WHEN seq%3 = 0 THEN 'S' || CAST(seq%2 AS VARCHAR) END IGNORE NULLS) OVER w, '') AS service_type, '' AS service_tier,
            coalesce(last_value(CASE WHEN seq%5 = 0 THEN 'A' || CAST(seq%4 AS VARCHAR) END IGNORE NULLS) OVER w, '') AS area_code
            FROM ev WHERE event_type <> 'signup' WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
    ),
    "missing_fares": "SELECT o_orderkey AS booking_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "fact_metric_bucket": on_facts(f"SELECT {FACT} FROM facts"),
    "driver_facts": on_facts(f"SELECT {FACT} FROM facts", "records_d"),
    "passenger_facts": on_facts(f"SELECT {FACT} FROM facts", "records_p"),
    "rejected_facts": on_facts(
        """SELECT CASE WHEN seq%4 = 1 THEN 'no_such_metric' ELSE metric_name END AS metric_name,
        CASE WHEN seq%4 = 1 OR seq%4 = 2 OR (seq%4 = 3 AND metric_value > 0) THEN 'rejected' ELSE 'kept' END AS verdict, count(*) AS facts FROM facts GROUP BY ALL""",
        grans=["DAY"],
    ),
    "catalog_coverage": on_facts(
        "SELECT c.metric_name, c.subject_area, c.default_unit, c.is_additive, true AS valid, count(f.metric_name) AS facts FROM catalog c LEFT JOIN facts f ON f.metric_name = c.metric_name GROUP BY ALL",
        grans=["MONTH"],
    ),
    "vw_metric_minute": view("MINUTE", "bucket_start", "c.aggregation_method,"),
    "vw_metric_hourly": view("HOUR", "bucket_hour"),
    "vw_metric_daily": view("DAY", "bucket_day"),
    "vw_metric_weekly": view("WEEK", "bucket_week"),
    "vw_metric_monthly": view("MONTH", "bucket_month"),
    "vw_metric_scope_snapshot": scope_view(["MINUTE"]),
    "vw_metric_scope_all_granularities": scope_view(GRANS),
    "realtime_kpi_metrics": on_facts(
        f"""SELECT f.metric_name, c.display_name, c.subject_area, c.metric_group, c.value_type, coalesce(f.metric_unit, c.default_unit) AS unit, c.aggregation_method, c.lower_is_better, c.is_realtime,
        f.data_granularity, {SCOPE}, {shown()} AS metric_value, f.numerator_value, f.denominator_value, f.sample_size, f.event_time, f.last_ingested_at, f.last_updated
        FROM snapshot f LEFT JOIN catalog c ON c.metric_name = f.metric_name WHERE c.subject_area <> 'Derived'""",
        grans=["MONTH"],
    ),
    "vw_latest_driver_location": compose(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY event_time DESC) AS rn FROM timeseries) WHERE rn = 1"
    ),
    "vw_booking_route_paths": compose(
        """SELECT booking_id, segment_type, count(*) AS points,
        string_agg(concat_ws(' ', sequence_no, latitude, longitude, strftime(event_time, '%Y-%m-%d %H:%M:%S')), ';' ORDER BY sequence_no) AS path,
        min(event_time) AS started_at, max(event_time) AS ended_at, max(received_at) AS last_received_at FROM segments GROUP BY booking_id, segment_type"""
    ),
    "vw_data_freshness": on_facts(freshness(), grans=["MONTH"]),
    "audit_sla": on_facts(
        f"SELECT source_name, ingestion_lag_seconds, processing_lag_seconds, CASE WHEN ingestion_lag_seconds > 5 THEN 'LAGGING' ELSE 'OK' END AS status FROM ({freshness()})",
        grans=["MONTH"],
    ),
    "dashboard_operations_realtime": on_facts(
        f"""SELECT metric_name, {DIMS}, metric_value, numerator_value, denominator_value, metric_unit, event_time, last_updated FROM snapshot
        WHERE metric_name IN ('request_order','accept_order','acceptance_rate','completed_order','completed_rate','gsv','revenue_vat','revenue_net','cancel_order','cancel_rate','order_time','board_time','lead_time','accept_time')
        AND last_updated >= (SELECT max(last_updated) FROM snapshot) - INTERVAL 5 MINUTE""",
        "records_b", ["MONTH"],
    ),
    "dashboard_operations_hourly": on_facts(
        f"""SELECT f.bucket_start AS bucket_hour, f.metric_name, {DIMS}, {shown()} AS metric_value, f.numerator_value, f.denominator_value FROM facts f JOIN catalog c ON c.metric_name = f.metric_name
        WHERE f.metric_name IN ('request_order','accept_order','completed_order','cancel_order') AND f.bucket_start >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 24 HOUR""",
        "records_b", ["HOUR"],
    ),
    "dashboard_driver_analytics": on_facts(
        f"""SELECT metric_name, {DIMS}, CAST(metric_value AS DOUBLE) AS metric_value, last_updated FROM snapshot WHERE metric_name IN ('online_driver','busy_driver','net_driver_income')
        UNION ALL SELECT f.metric_name, {DIMS}, round(sum({shown(digits=None)}), 6), CAST(CAST(bucket_start AS DATE) AS TIMESTAMP) FROM facts f JOIN catalog c ON c.metric_name = f.metric_name
        WHERE bucket_granularity = 'DAY' AND f.metric_name IN ('new_driver','active_driver','retention_driver','churn_driver','productivity')
        AND bucket_start >= CAST(CAST((SELECT max(ts) FROM events) AS DATE) AS TIMESTAMP) - INTERVAL 90 DAY GROUP BY f.metric_name, {DIMS}, CAST(bucket_start AS DATE)""",
        grans=["DAY", "MONTH"],
    ),
    "dashboard_passenger_analytics": on_facts(
        """SELECT CAST(bucket_start AS DATE) AS date, metric_name, cohort_key, CAST(sum(metric_value) AS DOUBLE) AS metric_value, sum(numerator_value) AS numerator_value, sum(denominator_value) AS denominator_value FROM facts
        WHERE metric_name IN ('new_passenger','active_passenger','retention_passenger','churn_passenger','return_passenger')
        AND bucket_start >= CAST(CAST((SELECT max(ts) FROM events) AS DATE) AS TIMESTAMP) - INTERVAL 90 DAY GROUP BY ALL""",
        "records_p", ["DAY"],
    ),
    "latest_kpis": on_facts(
        f"SELECT metric_name, {DIMS}, metric_value, last_updated FROM snapshot ORDER BY last_updated DESC, metric_name, {DIMS} LIMIT 10", grans=["MONTH"]
    ),
    "latest_minutes": on_facts(
        f"SELECT bucket_start, metric_name, {DIMS}, metric_value FROM facts ORDER BY bucket_start DESC, metric_name, {DIMS} LIMIT 10", grans=["MINUTE"]
    ),
    "latest_metric_snapshot": on_facts("SELECT * FROM snapshot", grans=["MONTH"]),
    "driver_location_timeseries": compose("SELECT * FROM timeseries"),
    "latest_documents": compose(
        """SELECT id AS driver_id, avail AS availability, service_type AS "serviceType", area_code AS "areaCode", lat, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS moment
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM located) WHERE rn = 1"""
    ),
    "daily_documents": compose("SELECT strftime(ts, '%Y.%m.%d') AS event_day, avail AS availability, count(*) AS documents, max(seq) AS last_seq FROM located GROUP BY ALL"),
    "upsert_do_nothing": """SELECT * FROM customer UNION ALL
        SELECT c_custkey + 10000000, c_name || '!', c_nationkey, NULL, NULL FROM customer WHERE c_custkey%3 = 0 AND c_custkey%2 = 1""",
    "upsert_do_update": """SELECT c_custkey, CASE WHEN c_custkey%6 = 0 THEN c_name || '!' ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL
        SELECT c_custkey + 10000000, c_name || '!', c_nationkey, NULL, NULL FROM customer WHERE c_custkey%3 = 0 AND c_custkey%2 = 1""",
    "audit_request_count": on_facts(
        """SELECT e AS expected_count, a AS actual_count, abs(e - a) AS diff, round(CASE WHEN e > 0 THEN abs(e - a) / e * 100.0 ELSE 0.0 END, 6) AS diff_pct, CASE WHEN e > 0 THEN abs(e - a) / e * 100.0 ELSE 0.0 END <= 1.0 AS passed
        FROM (SELECT (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01') AS e,
        (SELECT CAST(sum(metric_value) AS BIGINT) FROM facts WHERE metric_name = 'request_order' AND bucket_start >= TIMESTAMP '1995-01-01') AS a)""",
        "records_b", ["MINUTE"],
    ),
    **{
        name: on_facts(
            f"""SELECT bucket_start, round(c, 6) AS calculated_rate, round(r, 6) AS reported_rate, round(abs(c - r), 6) AS diff, round(abs(c - r), 6) <= 0.01 AS passed FROM (
            SELECT bucket_start, CASE WHEN q > 0 THEN CAST(a AS DOUBLE) / CAST(q AS DOUBLE) ELSE 0 END AS c, CASE WHEN d > 0 THEN CAST(n AS DOUBLE) / CAST(d AS DOUBLE) ELSE 0 END AS r FROM (
            SELECT bucket_start, sum(CASE WHEN metric_name = 'request_order' THEN metric_value ELSE 0 END) AS q, sum(CASE WHEN metric_name = 'accept_order' THEN metric_value ELSE 0 END) AS a,
            sum(CASE WHEN metric_name = 'acceptance_rate' THEN numerator_value ELSE 0 END) AS n, sum(CASE WHEN metric_name = 'acceptance_rate' THEN denominator_value ELSE 0 END) AS d
            FROM facts WHERE metric_name IN ('request_order','accept_order','acceptance_rate') GROUP BY bucket_start)) {tail}""",
            "records_b", [gran],
        )
        for name, gran, tail in (("audit_acceptance_rate", "HOUR", ""), ("audit_acceptance_top", "DAY", "ORDER BY diff DESC, bucket_start LIMIT 10"))
    },
    "audit_money": on_facts(
        """SELECT *, CAST(abs(gsv - (revenue_vat + discount_order)) AS DECIMAL(30,6)) AS gsv_check, round(abs(CAST(revenue_net AS DOUBLE) - CAST(revenue_vat AS DOUBLE) / 1.1), 3) AS net_check, abs(gsv - (revenue_vat + discount_order)) <= 1 AND abs(CAST(revenue_net AS DOUBLE) - CAST(revenue_vat AS DOUBLE) / 1.1) <= 1 AS passed FROM (
        SELECT bucket_start, """
        + ", ".join(f"CAST(sum(CASE WHEN metric_name = '{n}' THEN metric_value ELSE 0 END) AS DECIMAL(30,6)) AS {n}" for n in ("gsv", "revenue_vat", "revenue_net", "discount_order"))
        + " FROM facts GROUP BY bucket_start) WHERE gsv > 0",
        "records_b", ["HOUR"],
    ),
    "audit_late_events": compose(
        f"""SELECT {bucket('MINUTE', 'created_at')} AS bucket_start, count(*) AS bookings, count(DISTINCT (service_type, service_tier, area_code)) AS rows_found, true AS found FROM o GROUP BY 1"""
    ),
    "audit_fares": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS booking_id, true AS discount_ok, l_linenumber <> 7 AS total_ok, true AS income_ok FROM lineitem""",
    "audit_recent_writes": on_facts(
        "SELECT count(*) AS recent_rows, count(*) > 0 AS passed FROM facts WHERE last_updated >= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE", grans=["MINUTE"]
    ),
    "audit_completeness": compose(
        f"""SELECT day, sum(copies) AS change_rows, count(*) AS distinct_changes, sum(req) AS requests, sum(req) AS reported,
        round(1.0 - count(*) / sum(copies), 6) AS duplication_rate, CAST(1 AS DOUBLE) AS completeness FROM (
        SELECT {day('created_at')} AS day, booking_id, seq, CASE WHEN seq%8 = 0 THEN 2 ELSE 1 END AS copies, CASE WHEN op = 'c' THEN 1 ELSE 0 END AS req FROM changes
        UNION ALL SELECT {day('created_at')}, booking_id, seq+1, 1, 0 FROM changes WHERE status = 'COMPLETED' AND k%5 = 0) GROUP BY day"""
    ),
    "driver_earnings": "SELECT l_suppkey AS driver_id, CAST(sum(CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(6,4))), 0) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY 1",
}
_BALANCES = "SELECT s_suppkey AS driver_id, CAST(coalesce(amount, 0) AS BIGINT) AS balance FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT max(s_suppkey) + 1 FROM supplier) LEFT JOIN earned ON earned.driver_id = s_suppkey"
ORACLE["driver_balances"] = compose(_BALANCES, earned=ORACLE["driver_earnings"])
ORACLE["payout_ledger"] = compose(
    """SELECT driver_id, 'TRANSACTION' AS entry, 'PAYOUT' AS detail, balance AS amount, CAST(NULL AS BIGINT) AS previous_balance, CAST(NULL AS BIGINT) AS new_balance FROM balances WHERE balance > 0
    UNION ALL SELECT driver_id, 'HISTORY', 'EARNINGS', balance, 0, balance FROM balances WHERE balance > 0""",
    earned=ORACLE["driver_earnings"], balances=_BALANCES,
)
_DAYS = f"SELECT metric_name, {day('bucket_start')} AS day, {DIMS}, sum(metric_value) AS value FROM facts GROUP BY ALL"
ORACLE["active_shifted"] = on_facts(
    " UNION ALL ".join(
        f"SELECT 'active_{who}_{tag}' AS metric_name, day + {n} AS day, {DIMS}, CAST(value AS DECIMAL(30,6)) AS metric_value FROM days WHERE metric_name = 'active_{who}'"
        for who in ("passenger", "driver") for tag, n in (("prev", 1), ("tminus3", 3))
    ),
    "records_dp", ["DAY"], days=_DAYS,
)
ORACLE["retention_churn_rates"] = on_facts(
    " UNION ALL ".join(
        f"""SELECT '{kind}_rate_{who}' AS metric_name, h.day, h.service_type, h.service_tier, h.area_code, CAST(h.value AS BIGINT) AS numerator_value, CAST(coalesce(a.value, 0) AS BIGINT) AS denominator_value,
        round(CAST(h.value AS DOUBLE) / CAST(a.value AS DOUBLE), 6) AS metric_value FROM days h LEFT JOIN days a ON a.metric_name = 'active_{who}' AND a.day + {n} = h.day
        AND a.service_type = h.service_type AND a.service_tier = h.service_tier AND a.area_code = h.area_code WHERE h.metric_name = '{kind}_{who}'"""
        for who in ("passenger", "driver") for kind, n in (("retention", 1), ("churn", 3))
    ),
    "records_dp", ["DAY"], days=_DAYS,
)
ORACLE["passenger_cohorts"] = compose(
    """SELECT cohort_day, d AS day, CAST(d - cohort_day AS INTEGER) AS age_days, count(*) AS users, sum(n) AS trips, round(sum(n) / count(*), 6) AS trips_per_user
    FROM (SELECT id, d, count(*) AS n, min(d) OVER (PARTITION BY id) AS cohort_day FROM ev WHERE event_type = 'purchase' GROUP BY id, d) GROUP BY ALL"""
)
ORACLE["supply_demand_map"] = compose(
    f"""SELECT b AS bucket_start, y AS cell_lat, x AS cell_lon, sum(r) AS requests, sum(f) AS drivers, sum(r) - sum(f) AS gap FROM (
    SELECT {bucket('HOUR', 'ts')} AS b, CAST(floor(lat * 100) AS INTEGER) AS y, CAST(floor(lon * 100) AS INTEGER) AS x, 1 AS r, 0 AS f FROM located WHERE avail = 'BUSY'
    UNION ALL SELECT b, y, x, 0, count(DISTINCT id) FROM (SELECT {bucket('HOUR', 'ts')} AS b, CAST(floor(lat * 100) AS INTEGER) AS y, CAST(floor(lon * 100) AS INTEGER) AS x, id FROM located WHERE avail IN ('AVAILABLE','ONLINE')) GROUP BY b, y, x) GROUP BY ALL"""
)
# the JSON feed spoils the discount of every seventh booking
_FEED = [(*m[:3], m[3].replace("discount", "(CASE WHEN k%7 = 0 THEN 0 ELSE discount END)"), m[4].replace("discount", "(CASE WHEN k%7 = 0 THEN 0 ELSE discount END)"), *m[5:8], m[8].replace("discount", "(CASE WHEN k%7 = 0 THEN 0 ELSE discount END)")) for m in BOOKING_METRICS]
ORACLE["stream_booking_facts"] = on_facts(f"SELECT {FACT} FROM facts", "records_feed", ["DAY"], records_feed=booking_records("o", _FEED))
ORACLE["stream_registrations"] = on_facts(f"SELECT {FACT} FROM facts", "records_new", records_new="SELECT * FROM new_passengers UNION ALL SELECT * FROM new_drivers")
ORACLE["stream_locations"] = compose("SELECT * FROM timeseries")
ORACLE["mart_roundtrip"] = on_facts(f"SELECT {FACT} FROM facts", grans=["MONTH"])
ORACLE["vw_metric_daily_stored"] = ORACLE["vw_metric_daily"]
ORACLE["stream_driver_records"] = on_facts(f"SELECT {FACT} FROM facts WHERE metric_name NOT IN ('churn_driver', 'new_driver')", "records_d", ["DAY"])
ORACLE["stream_passenger_records"] = on_facts(f"SELECT {FACT} FROM facts WHERE metric_name NOT IN ('churn_passenger', 'new_passenger')", "records_p", ["DAY"])
ORACLE["stream_driver_churn"] = on_facts(f"SELECT {FACT} FROM facts WHERE metric_name = 'churn_driver'", "records_d", ["DAY"])
ORACLE["stream_passenger_churn"] = on_facts(f"SELECT {FACT} FROM facts WHERE metric_name = 'churn_passenger'", "records_p", ["DAY"])
ORACLE["stream_documents"] = ORACLE["latest_documents"]
ORACLE["stream_daily_documents"] = ORACLE["daily_documents"]
ORACLE["stream_snapshot"] = ORACLE["latest_metric_snapshot"]
ORACLE["stream_replay"] = ORACLE["stream_booking_facts"]
ORACLE["stream_late_booking"] = on_facts(
    f"SELECT {FACT.replace(', last_updated', '')} FROM facts WHERE metric_name = 'request_order'", "records_b", ["MINUTE", "HOUR", "DAY"]
)
# trips in the order of their times; everybody churns in the end
ORACLE["stream_chained"] = compose(
    f"SELECT metric_name, {day('ev')} AS day, count(*) AS records FROM found GROUP BY ALL",
    trips2=f"""SELECT passenger_id AS id, completed_at AS ts, completed_at AS ingest, k AS seq, {day('completed_at')} AS d,
        lag(completed_at) OVER w AS pts, lag({day('completed_at')}) OVER w AS pday, lead(k) OVER w AS nseq, TIMESTAMP '9999-01-01' AS stream_end
        FROM o WHERE outcome = 'F' WINDOW w AS (PARTITION BY passenger_id ORDER BY completed_at, k%250)""",
    found=passenger_activity("trips2"),
)
ORACLE["mart_refresh"] = on_facts(f"SELECT {FACT} FROM facts", grans=["DAY", "WEEK", "MONTH"])
# the same tables over every second position
_CHAIN = ["located", "loc", "busy", "churn_scope", "driving"]
_HALF = {f"{name}_half": re.sub(rf"\b({'|'.join(_CHAIN)})\b(?=\s|\.|$|,|\))", r"\1_half", CTES[name]) for name in _CHAIN}
_HALF["located_half"] += " AND seq%2 = 0"
_KEY = FACT.split(", ")[:9]
ORACLE["fact_upsert"] = compose(
    "SELECT " + ", ".join(f"coalesce(a.{c}, h.{c}) AS {c}" for c in _KEY)
    + "".join(f", CASE WHEN a.metric_name IS NULL THEN h.{c} ELSE a.{c} END AS {c}" for c in [*MEASURES, "processing_lag_ms"])
    + ", least(a.first_event_at, h.first_event_at) AS first_event_at"
    + "".join(f", greatest(a.{c}, h.{c}) AS {c}" for c in ("last_event_at", "last_ingested_at", "last_updated"))
    + " FROM facts a FULL JOIN facts_half h ON " + " AND ".join(f"a.{c} = h.{c}" for c in _KEY),
    facts=facts_cte("records_d", ["DAY"]), facts_half=facts_cte("driving_half", ["DAY"]), **_HALF,
)
