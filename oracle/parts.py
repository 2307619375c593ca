"""Named common table expressions that the oracle queries are put together from."""

from __future__ import annotations

import re

from waymeter.sources.catalog import ROWS

DIMS = "service_type, service_tier, area_code"
MEASURES = ["metric_value", "numerator_value", "denominator_value", "sample_size"]


def bucket(gran: str, ts: str) -> str:
    """Bucket start in the reporting zone, which is eight hours ahead of UTC."""
    return f"(date_trunc('{gran.lower()}', {ts} + INTERVAL 8 HOUR) - INTERVAL 8 HOUR)"


def day(ts: str) -> str:
    return f"CAST(({ts} + INTERVAL 8 HOUR) AS DATE)"


GRANS = ["MINUTE", "HOUR", "DAY", "WEEK", "MONTH"]
BUCKET_CASE = "CASE gran " + " ".join(f"WHEN '{g}' THEN {bucket(g, 'ev')}" for g in GRANS) + " END"


def _catalog() -> str:
    def lit(v):
        return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'"

    rows = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in ROWS)
    return f"""SELECT c0 AS metric_name, c1 AS display_name, c2 AS subject_area, c3 AS metric_group, c4 AS value_type,
        c5 AS default_unit, c6 AS lower_is_better, c7 AS is_realtime, c8 IS NULL AS is_additive,
        CASE WHEN c8 IS NULL THEN 'SUM' ELSE 'WEIGHTED_AVG' END AS aggregation_method
        FROM (VALUES {rows}) t(c0, c1, c2, c3, c4, c5, c6, c7, c8, c9)"""


# name, unit, event time, value, numerator, denominator, sample, seq step, condition
_ACC, _DONE, _END = "outcome IN ('F','P')", "outcome = 'F'", "outcome = 'P'"
_ACC_S, _BOARD_S, _LEAD_S = "(k%5+1)*60", "(k%26+5)*60", "(k%5+1 + k%7+1 + k%26+5)*60"
BOOKING_METRICS = [
    ("request_order", "COUNT", "created_at", "1", "1", "0", "0", 0, "true"),
    ("acceptance_rate", "PERCENT", "created_at", "0", "0", "1", "0", 0, "true"),
    ("completed_rate", "PERCENT", "created_at", "0", "0", "1", "0", 0, "true"),
    ("cancel_rate", "PERCENT", "created_at", "0", "0", "1", "0", 0, "true"),
    ("accept_order", "COUNT", "accepted_at", "1", "1", "0", "0", 1, _ACC),
    ("acceptance_rate", "PERCENT", "accepted_at", "1", "1", "0", "0", 1, _ACC),
    *[(n, "SECOND", "accepted_at", _ACC_S, _ACC_S, "1", "1", 1, _ACC) for n in ("accept_time_total", "accept_time", "order_time_total", "order_time")],
    ("completed_order", "COUNT", "completed_at", "1", "1", "0", "0", 3, _DONE),
    ("completed_rate", "PERCENT", "completed_at", "1", "1", "0", "0", 3, _DONE),
    ("productivity", "TRIP_PER_DRIVER", "completed_at", "1", "1", "0", "0", 3, _DONE),
    ("gsv", "CURRENCY", "completed_at", "fee + discount", "fee + discount", "0", "0", 3, _DONE),
    ("revenue_vat", "CURRENCY", "completed_at", "fee", "fee", "0", "0", 3, _DONE),
    ("revenue_net", "CURRENCY", "completed_at", "net", "net", "0", "0", 3, _DONE),
    ("net_driver_income", "CURRENCY", "completed_at", "discount", "discount", "0", "0", 3, _DONE),
    ("discount_order", "CURRENCY", "completed_at", "discount", "discount", "0", "0", 3, _DONE + " AND discount > 0"),
    *[(n, "SECOND", "completed_at", _BOARD_S, _BOARD_S, "1", "1", 3, _DONE) for n in ("board_time_total", "board_time")],
    *[(n, "SECOND", "completed_at", _LEAD_S, _LEAD_S, "1", "1", 3, _DONE) for n in ("lead_time_total", "lead_time")],
    ("cancel_order", "COUNT", "canceled_at", "1", "1", "0", "0", 3, _END),
    ("cancel_rate", "PERCENT", "canceled_at", "1", "1", "0", "0", 3, _END),
]


def booking_records(source: str = "o", metrics=BOOKING_METRICS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric_name, '{u}' AS metric_unit, {DIMS}, {ev} AS ev, {ev} + to_seconds(k%4+1) AS proc, "
        f"CAST({v} AS DECIMAL(24,9)) AS metric_value, CAST({num} AS DECIMAL(24,9)) AS numerator_value, "
        f"CAST({d} AS DECIMAL(24,9)) AS denominator_value, CAST({s} AS DECIMAL(24,9)) AS sample_size, k*4+{step} AS seq FROM {source} WHERE {c}"
        for n, u, ev, v, num, d, s, step, c in metrics
    )


def _event_record(name: str, unit: str, source: str, ev: str, proc: str, seq: str, dims: tuple[str, str, str], where: str, num: int = 1, den: int = 0) -> str:
    a, b, c = dims
    return (
        f"SELECT '{name}' AS metric_name, '{unit}' AS metric_unit, {a} AS service_type, {b} AS service_tier, {c} AS area_code, "
        f"{ev} AS ev, {proc} AS proc, CAST({num} AS DECIMAL(24,9)) AS metric_value, CAST({num} AS DECIMAL(24,9)) AS numerator_value, "
        f"CAST({den} AS DECIMAL(24,9)) AS denominator_value, CAST(0 AS DECIMAL(24,9)) AS sample_size, {seq} AS seq FROM {source} WHERE {where}"
    )


NONE = ("''", "''", "''")
OWN = ("service_type", "service_tier", "area_code")
DUE = "INTERVAL 3 DAY + INTERVAL 5 MINUTE"


def churn_at(ts: str) -> str:
    return f"date_trunc('millisecond', {ts} + INTERVAL 3 DAY)"


def passenger_activity(source: str = "trips") -> str:
    gap = "date_diff('day', pday, d)"
    new = f"(pts IS NULL OR {gap} <> 0)"
    at = churn_at
    return " UNION ALL ".join(
        [
            _event_record("active_passenger", "COUNT", source, "ts", "ingest", "seq", NONE, new),
            _event_record("retention_passenger", "COUNT", source, "ts", "ingest", "seq", NONE, f"{new} AND {gap} = 1"),
            _event_record("return_passenger", "COUNT", source, "ts", "ingest", "seq", NONE, f"{new} AND {gap} >= 3 AND ts > pts + {DUE}"),
            _event_record("churn_passenger", "COUNT", source, at("pts"), at("pts") + " + INTERVAL 5 MINUTE", "seq", NONE, f"ts > pts + {DUE}"),
            _event_record("churn_passenger", "COUNT", source, at("ts"), at("ts") + " + INTERVAL 5 MINUTE", "seq", NONE, f"nseq IS NULL AND ts + {DUE} <= stream_end"),
        ]
    )


def _driver_records() -> str:
    changed = "(pminute IS NULL OR pminute <> minute OR pavail <> avail)"
    gap = "date_diff('day', pday, d)"
    new = f"(pts IS NULL OR {gap} <> 0)"
    churn = ("cs.service_type", "cs.service_tier", "cs.area_code")
    at = churn_at
    return " UNION ALL ".join(
        [
            _event_record("online_driver", "COUNT", "loc", "ts", "ingest", "seq", OWN, f"{changed} AND avail IN ('AVAILABLE','BUSY','ONLINE')"),
            _event_record("busy_driver", "COUNT", "loc", "ts", "ingest", "seq", OWN, f"{changed} AND avail = 'BUSY'"),
            _event_record("productivity", "TRIP_PER_DRIVER", "busy", "ts", "ingest", "seq", OWN, new, 0, 1),
            _event_record("active_driver", "COUNT", "busy", "ts", "ingest", "seq", OWN, new),
            _event_record("retention_driver", "COUNT", "busy", "ts", "ingest", "seq", OWN, f"{new} AND {gap} = 1"),
            _event_record("return_driver", "COUNT", "busy", "ts", "ingest", "seq", OWN, f"{new} AND {gap} >= 3 AND ts > pts + {DUE}"),
            _event_record("churn_driver", "COUNT", "churn_scope cs", at("cs.ts"), at("cs.ts") + " + INTERVAL 5 MINUTE", "cs.seen_seq", churn, "true"),
        ]
    )


CTES: dict[str, str] = {
    "catalog": _catalog(),
    "lines": """SELECT l_orderkey, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(6,4))), 0) AS BIGINT) AS discount,
        CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,4))) * 0.2, 0) AS BIGINT) AS fee FROM lineitem GROUP BY l_orderkey""",
    "base": """SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS booking_id, CAST(o_custkey AS VARCHAR) AS passenger_id, o_orderstatus AS outcome,
        o_orderpriority AS service_type, coalesce(c_mktsegment, '') AS service_tier, coalesce(n_name, '') AS area_code, o_orderdate AS created_at,
        o_orderdate + to_minutes(o_orderkey%5+1) AS accepted_at,
        o_orderdate + to_minutes(o_orderkey%5+1 + o_orderkey%7+1) AS start_trip_at,
        o_orderdate + to_minutes(o_orderkey%5+1 + o_orderkey%7+1 + o_orderkey%26+5) AS completed_at,
        o_orderdate + to_minutes(o_orderkey%5+1 + o_orderkey%3+1) AS canceled_at,
        CAST(coalesce(fee, 0) AS DOUBLE) AS fee, CAST(coalesce(discount, 0) AS DOUBLE) AS discount,
        (o_orderkey%300 + 10700) / CAST(1000 AS DOUBLE) AS pickup_lat, (o_orderkey%301 + 106600) / CAST(1000 AS DOUBLE) AS pickup_lon,
        CASE WHEN o_orderkey%11 <> 0 THEN (o_orderkey%299 + 10700) / CAST(1000 AS DOUBLE) END AS dropoff_lat,
        CASE WHEN o_orderkey%11 <> 0 THEN (o_orderkey%298 + 106600) / CAST(1000 AS DOUBLE) END AS dropoff_lon
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN lines ON l_orderkey = o_orderkey""",
    "o": "SELECT *, CAST(fee * (CAST(1 AS DOUBLE) / CAST(1.1 AS DOUBLE)) AS DECIMAL(24,9)) AS net FROM base",
    "changes": """SELECT o.*, s.step, k*4+s.step AS seq, CASE s.step WHEN 0 THEN 'c' ELSE 'u' END AS op,
        CASE s.step WHEN 0 THEN 'REQUESTED' WHEN 1 THEN 'DRIVER_ACCEPTED' WHEN 2 THEN 'STARTED' ELSE CASE outcome WHEN 'F' THEN 'COMPLETED' ELSE 'CANCELED' END END AS status,
        CASE s.step WHEN 0 THEN created_at WHEN 1 THEN accepted_at WHEN 2 THEN start_trip_at ELSE CASE outcome WHEN 'F' THEN completed_at ELSE canceled_at END END AS updated_at
        FROM o JOIN (VALUES (0),(1),(2),(3)) s(step) ON s.step = 0 OR (s.step IN (1,3) AND outcome IN ('F','P')) OR (s.step = 2 AND outcome = 'F')""",
    "records_b": booking_records(),
    "ev": """SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS kk, ts,
        ts + to_seconds(event_id%4+1) AS ingest, CAST((ts + INTERVAL 8 HOUR) AS DATE) AS d FROM events""",
    "ends": "SELECT max(ts) AS stream_end FROM events WHERE event_type <> 'signup'",
    "profiled": """SELECT *, CASE WHEN event_type = 'signup' THEN CASE WHEN kk%2 = 0 THEN 'BIKE' ELSE 'CAR' END END AS pst,
        CASE WHEN event_type = 'signup' AND kk%3 <> 0 THEN 'Z' || CAST(kk%4 AS VARCHAR) END AS parea FROM ev""",
    "carried": """SELECT *, coalesce(last_value(pst IGNORE NULLS) OVER w, '') AS service_type, '' AS service_tier,
        coalesce(last_value(parea IGNORE NULLS) OVER w, '') AS area_code FROM profiled
        WINDOW w AS (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
    "located": """SELECT *, CASE event_type WHEN 'purchase' THEN 'BUSY' WHEN 'view' THEN 'AVAILABLE' WHEN 'click' THEN 'ONLINE' ELSE 'UNAVAILABLE' END AS avail,
        date_trunc('minute', ts) AS minute, (kk%300 + 10700) / CAST(1000 AS DOUBLE) AS lat, (kk%301 + 106600) / CAST(1000 AS DOUBLE) AS lon
        FROM carried WHERE event_type <> 'signup'""",
    "loc": "SELECT *, lag(minute) OVER w AS pminute, lag(avail) OVER w AS pavail FROM located WINDOW w AS (PARTITION BY id ORDER BY seq)",
    "busy": """SELECT *, lag(ts) OVER w AS pts, lag(d) OVER w AS pday, lead(ts) OVER w AS nts, lead(seq) OVER w AS nseq
        FROM located WHERE avail = 'BUSY' WINDOW w AS (PARTITION BY id ORDER BY seq)""",
    # a churn takes the scope of the last position before its timer fires
    "churn_scope": f"""SELECT b.ts, max(coalesce(b.nseq, f.final)) AS seen_seq, arg_max(l.service_type, l.seq) AS service_type,
        arg_max(l.service_tier, l.seq) AS service_tier, arg_max(l.area_code, l.seq) AS area_code
        FROM busy b JOIN located l ON l.id = b.id AND l.seq >= b.seq AND (b.nseq IS NULL OR l.seq < b.nseq) AND l.ts <= b.ts + {DUE}
        JOIN (SELECT id, max(seq) AS final FROM ev GROUP BY id) f ON f.id = b.id
        WHERE b.nts > b.ts + {DUE} OR (b.nts IS NULL AND b.ts + {DUE} <= (SELECT stream_end FROM ends)) GROUP BY b.id, b.seq, b.ts""",
    "trips": """SELECT *, lag(ts) OVER w AS pts, lag(d) OVER w AS pday, lead(seq) OVER w AS nseq, (SELECT stream_end FROM ends) AS stream_end
        FROM ev WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY id ORDER BY seq)""",
    "first_signup": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM profiled WHERE event_type = 'signup') WHERE rn = 1",
    "new_passengers": _event_record("new_passenger", "COUNT", "first_signup", "ts", "ingest", "seq", NONE, "true"),
    "new_drivers": _event_record("new_driver", "COUNT", "first_signup", "ts", "ingest", "seq", ("coalesce(pst, '')", "''", "coalesce(parea, '')"), "true"),
    "activity": passenger_activity(),
    "driving": _driver_records(),
    "records_d": "SELECT * FROM driving UNION ALL SELECT * FROM new_drivers",
    "records_p": "SELECT * FROM activity UNION ALL SELECT * FROM new_passengers",
    "records_dp": "SELECT * FROM records_d UNION ALL SELECT * FROM records_p",
    "records_all": "SELECT * FROM records_b UNION ALL SELECT * FROM records_d UNION ALL SELECT * FROM records_p",
    "enriched_ts": "SELECT id AS driver_id, ts AS event_time, service_type, service_tier, area_code, CAST(lat AS DECIMAL(10,6)) AS latitude, CAST(lon AS DECIMAL(10,6)) AS longitude, avail AS driver_status, ingest AS received_at, seq FROM located",
    "timeseries": "SELECT * EXCLUDE (seq, rn) FROM (SELECT *, row_number() OVER (PARTITION BY driver_id, event_time ORDER BY seq DESC) AS rn FROM enriched_ts) WHERE rn = 1",
    "segments": """SELECT booking_id, 'PATH' AS segment_type, 1 AS sequence_no, CAST(pickup_lat AS DECIMAL(10,6)) AS latitude, CAST(pickup_lon AS DECIMAL(10,6)) AS longitude, created_at AS event_time, created_at + to_seconds(k%4+1) AS received_at FROM o
        UNION ALL SELECT booking_id, 'PATH', 2, CAST(dropoff_lat AS DECIMAL(10,6)), CAST(dropoff_lon AS DECIMAL(10,6)), created_at, created_at + to_seconds(k%4+1) FROM o WHERE dropoff_lat IS NOT NULL""",
}


def facts_cte(records: str, grans=GRANS) -> str:
    """Facts of a records relation."""
    sums = ", ".join(f"CAST(sum({m}) AS DECIMAL(20,6)) AS {m}" for m in MEASURES)
    values = ", ".join(f"('{g}')" for g in grans)
    return f"""SELECT metric_name, bucket_start, gran AS bucket_granularity, {DIMS}, 'ALL' AS cohort_key, 'AGGREGATE' AS entity_type, 'ALL' AS entity_id,
        {sums}, min(ev) AS first_event_at, max(ev) AS last_event_at, max(proc) AS last_ingested_at,
        CAST(max(greatest(0, (epoch_us(proc) - epoch_us(ev)) // 1000)) AS INTEGER) AS processing_lag_ms, max(proc) AS last_updated, max(metric_unit) AS metric_unit, max(seq) AS seq
        FROM (SELECT r.*, gran, {BUCKET_CASE} AS bucket_start FROM {records} r JOIN (VALUES {values}) g(gran) ON true)
        GROUP BY metric_name, bucket_start, gran, {DIMS}"""


SNAPSHOT = f"""SELECT * EXCLUDE (rn, latest) REPLACE (latest AS event_time) FROM (
    SELECT metric_name, {DIMS}, cohort_key, entity_type, entity_id, {', '.join(MEASURES)}, metric_unit, 'MONTH' AS data_granularity, last_event_at AS event_time,
    max(last_event_at) OVER (PARTITION BY metric_name, {DIMS}) AS latest, last_ingested_at, last_updated,
    row_number() OVER (PARTITION BY metric_name, {DIMS} ORDER BY seq DESC, bucket_start DESC) AS rn FROM facts WHERE bucket_granularity = 'MONTH') WHERE rn = 1"""


def compose(body: str, **local: str) -> str:
    """``body`` with the common table expressions it needs, directly or not."""
    known = {**CTES, **local}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ", ".join(f"{name} AS ({known[name]})" for name in order) + " " + body
