"""Booking life cycle: from booking changes to the events that carry KPIs.

A booking's rows fall into lives. A life ends with a COMPLETED or CANCELED row and the
next row starts a new one. Within a life each of request, accept, complete and cancel
fires at most once. A fired event is a *trigger*: a wide row with all that the metric,
activity and route outputs need. Batch and streaming share everything after triggers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waymeter.functions import metrics as m, timing
from waymeter.functions.money import NET_FACTOR
from waymeter.operators.keyed import ROWS_PER_TASK, carry, per_key
from waymeter.schema import COORDINATE, DIMENSIONS, WIDE

POINTS = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"]
DURATIONS = ["accept_seconds", "board_seconds", "lead_seconds"]
TRIGGER_VALUES = ["platform_fee", "discount_amount", *DURATIONS, *POINTS]
TRIGGER = (
    "booking_id string, kind string, event_time timestamp_ntz, passenger_id string, "
    + ", ".join(f"{name} string" for name in DIMENSIONS)
    + ", "
    + ", ".join(f"{name} double" for name in TRIGGER_VALUES)
    + ", seq bigint, ingest_ts timestamp_ntz"
)


def _lives(rows: DataFrame, chunk: list[str], dedupe_terminal: bool) -> DataFrame:
    """One row per booking life with the rows that decide its triggers."""
    scanned = carry(rows, "booking_id", "seq", chunk, total_before={"life": F.expr("CAST(ends AS BIGINT)")})
    if dedupe_terminal:
        scanned = scanned.filter("life = 0")
    common = ", ".join(["seq", "passenger_id", *DIMENSIONS, "updated_at", "ingest_ts", "created_at"])

    def pick(choose: str, name: str, columns: str, condition: str):
        return F.expr(f"{choose}({columns}, CASE WHEN {condition} THEN seq END)").alias(name)

    ending = "completed_at, platform_fee, discount_amount, completes, cancels"
    return scanned.groupBy("booking_id", "life").agg(
        pick("min_by", "request", f"struct({common}, {', '.join(POINTS)})", "lower(op) = 'c'"),
        pick("min_by", "accept", f"struct({common}, accepted_at)", "accepts"),
        pick("max_by", "ending", f"struct({common}, {ending})", "ends"),
        pick("max_by", "started_at", "started", "starts AND started IS NOT NULL"),
        pick("min_by", "created", "struct(seq, created_at)", "created_at IS NOT NULL"),
    )


def _trigger(row: str, kind: str, event_time: str, condition: str, **values: str) -> str:
    parts = [f"'kind', '{kind}'", f"'event_time', {event_time}", f"'passenger_id', {row}.passenger_id"]
    parts += [f"'{name}', coalesce({row}.{name}, '')" for name in DIMENSIONS]
    parts += [f"'{name}', CAST({values.get(name, 'NULL')} AS DOUBLE)" for name in TRIGGER_VALUES]
    parts += [f"'seq', {row}.seq", f"'ingest_ts', {row}.ingest_ts"]
    return m.when(condition, f"named_struct({', '.join(parts)})")


def _seconds(start: str, end: str) -> str:
    """Seconds between two columns, null when negative or unknown."""
    span = f"timestampdiff(MILLISECOND, {start}, {end}) / 1000.0D"
    return f"CASE WHEN {end} >= {start} THEN {span} WHEN {span} >= 0 THEN {span} END"


def _life_triggers(lives: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    timed = lives.selectExpr(
        "*",
        "coalesce(request.created_at, request.updated_at, request.ingest_ts) AS requested_at",
        "coalesce(accept.accepted_at, accept.updated_at, accept.ingest_ts) AS accepted_at",
        "coalesce(ending.completed_at, ending.updated_at, ending.ingest_ts) AS completed_at",
        "coalesce(ending.updated_at, ending.created_at, ending.ingest_ts) AS canceled_at",
    ).selectExpr(
        "*",
        # the creation time as known when the accept row arrived, and at the end
        "CASE WHEN request.seq <= accept.seq THEN requested_at "
        "WHEN created.seq <= accept.seq THEN created.created_at END AS created_then",
        "coalesce(requested_at, created.created_at) AS created_last",
    ).selectExpr(
        "*",
        f"{_seconds('created_then', 'accepted_at')} AS accept_seconds",
        f"{_seconds('created_last', 'accepted_at')} AS late_accept_seconds",
        f"{_seconds('started_at', 'completed_at')} AS board_seconds",
        f"{_seconds('created_last', 'completed_at')} AS lead_seconds",
    )
    made = [
        _trigger("request", "REQUESTED", "requested_at", "request IS NOT NULL", **{p: f"request.{p}" for p in POINTS}),
        _trigger("accept", "ACCEPTED", "accepted_at", "accept IS NOT NULL", accept_seconds="accept_seconds"),
        _trigger(
            "ending",
            "COMPLETED",
            "completed_at",
            "ending.completes",
            platform_fee="coalesce(ending.platform_fee, 0)",
            discount_amount="coalesce(ending.discount_amount, 0)",
            # only when the accept row could not report it
            accept_seconds="CASE WHEN accept_seconds IS NULL THEN late_accept_seconds END",
            board_seconds="board_seconds",
            lead_seconds="lead_seconds",
        ),
        _trigger("ending", "CANCELED", "canceled_at", "ending.cancels"),
    ]
    triggers = [t for t in made if kinds is None or any(f"'kind', '{kind}'" in t for kind in kinds)]
    return timed.selectExpr("booking_id", f"inline(array({', '.join(triggers)}))").filter("kind IS NOT NULL")


def booking_lives(bookings: DataFrame, dedupe_terminal: bool = False, rows_per_task: int = ROWS_PER_TASK, keys: DataFrame | None = None) -> DataFrame:
    """One row per booking life, one shuffle on booking_id for ordinary keys; see :func:`booking_triggers`."""
    status = "contains(upper(coalesce(status, '')), '{}')"
    rows = bookings.selectExpr(
        "*",
        *[
            f"{status.format(part)} AS {name}"
            for name, part in {"accepts": "ACCEPT", "starts": "START", "completes": "COMPLET", "cancels": "CANCEL"}.items()
        ],
        "coalesce(start_trip_at, updated_at) AS started",
    ).selectExpr("*", "completes OR cancels AS ends")
    return per_key(rows, "booking_id", "seq", lambda part, chunk: _lives(part, chunk, dedupe_terminal), rows_per_task, keys)


def booking_triggers(
    bookings: DataFrame,
    dedupe_terminal: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    keys: DataFrame | None = None,
    kinds: tuple[str, ...] | None = None,
) -> DataFrame:
    """Triggers of every booking life, one shuffle on booking_id for ordinary keys.

    With ``kinds`` only triggers of these kinds, so that columns no one asks for are never read.

    ``dedupe_terminal`` ignores all rows of a booking after its first end, where the
    default counts a repeated end again. ``keys`` may give (booking_id, seq) from a
    cheaper scan than ``bookings`` for finding heavy keys.
    """
    return _life_triggers(booking_lives(bookings, dedupe_terminal, rows_per_task, keys), kinds)


# ---- lives across batches ----------------------------------------------------------

#: Rows that stand for an open life come before every other row of their booking.
KNOWN_FROM = -(2**63)
MOST_KNOWN = 4
KNOWN = "op string, status string, created_at timestamp_ntz, accepted_at timestamp_ntz, start_trip_at timestamp_ntz, updated_at timestamp_ntz, ingest_ts timestamp_ntz"
OPEN_LIFE = f"booking_id string, known array<struct<{KNOWN.replace(' string', ':string').replace(' timestamp_ntz', ':timestamp_ntz')}>>, touched bigint"


def open_lives(lives: DataFrame) -> DataFrame:
    """(booking_id, known) of every booking: the rows that decide on the rest of its last life, null if that has ended.

    These are at most four, however many changes a life has: its request, its first known creation, its acceptance and its start.
    """

    def row(condition: str, seq: str, place: int, **values: str) -> str:
        columns = ", ".join(f"'{c.split()[0]}', CAST({values.get(c.split()[0], 'NULL')} AS {c.split()[1]})" for c in KNOWN.split(", "))
        return m.when(condition, f"named_struct('seq', {seq}, 'place', {place}, 'row', named_struct({columns}))")

    def of(name: str, *columns: str) -> dict[str, str]:
        return {c: f"{name}.{c}" for c in ("updated_at", "ingest_ts", *columns)}

    rows = [
        row("request IS NOT NULL", "request.seq", 0, op="'c'", **of("request", "created_at")),
        row("created IS NOT NULL", "created.seq", 1, op="'u'", created_at="created.created_at"),
        row("accept IS NOT NULL", "accept.seq", 2, op="'u'", status="'ACCEPT'", **of("accept", "accepted_at")),
        # whatever starts later counts in place of it
        row("started_at IS NOT NULL", f"{KNOWN_FROM + 1}", 3, op="'u'", status="'START'", start_trip_at="started_at"),
    ]
    known = f"transform(array_sort(filter(array({', '.join(rows)}), r -> r IS NOT NULL)), r -> r.row)"
    last = lives.groupBy("booking_id").agg(F.expr(f"max_by(CASE WHEN ending IS NULL THEN {known} END, life)").alias("known"))
    return last.select("booking_id", F.when(F.size("known") > 0, F.col("known")).alias("known"))


def known_changes(lives: DataFrame) -> DataFrame:
    """Open lives as booking changes again, in the order in which they came."""
    rows = lives.select("booking_id", F.posexplode("known").alias("place", "row"))
    return rows.select("booking_id", "row.*", (F.col("place") + F.lit(KNOWN_FROM)).alias("seq"))


def new_triggers(lives: DataFrame) -> DataFrame:
    """Triggers of lives, without those that rows of :func:`known_changes` have fired before."""
    return _life_triggers(lives).filter(F.col("seq") >= KNOWN_FROM + MOST_KNOWN)


def _contributions(rows: DataFrame, kept: list[str]) -> DataFrame:
    """KPI contributions of rows that each stand for ``n`` triggers of one kind.

    Money and seconds are already sums over those triggers. Every measure is linear in
    them, so the same rules serve single triggers and pre-aggregated ones.
    """

    def timed(seconds: str, *names: str) -> list[str]:
        return [m.when(f"{seconds} IS NOT NULL", m.duration(name, seconds, "n")) for name in names]

    by_kind = {
        "REQUESTED": [
            m.metric("request_order", "n"),
            m.ratio("acceptance_rate", 0, "n"),
            m.ratio("completed_rate", 0, "n"),
            m.ratio("cancel_rate", 0, "n"),
        ],
        "ACCEPTED": [
            m.metric("accept_order", "n"),
            m.ratio("acceptance_rate", "n", 0),
            *timed("accept_seconds", "accept_time_total", "accept_time", "order_time_total", "order_time"),
        ],
        "COMPLETED": [
            m.metric("completed_order", "n"),
            m.ratio("completed_rate", "n", 0),
            m.ratio("productivity", "n", 0),
            m.metric("gsv", "fee + discount"),
            m.metric("revenue_vat", "fee"),
            m.metric("revenue_net", "net"),
            m.metric("net_driver_income", "income"),
            m.when("has_discount", m.metric("discount_order", "discount")),
            *timed("accept_seconds", "order_time_total", "order_time", "accept_time"),
            *timed("board_seconds", "board_time_total", "board_time"),
            *timed("lead_seconds", "lead_time_total", "lead_time"),
        ],
        "CANCELED": [m.metric("cancel_order", "n"), m.ratio("cancel_rate", "n", 0)],
    }
    cases = " ".join(
        f"WHEN '{kind}' THEN array({', '.join(emitted)})" for kind, emitted in by_kind.items()
    )
    return rows.selectExpr(f"inline(CASE kind {cases} END)", *kept).filter("metric_name IS NOT NULL")


def _priced(triggers: DataFrame, *kept: str) -> DataFrame:
    fee, discount = "coalesce(platform_fee, 0)", "coalesce(discount_amount, 0)"
    return triggers.selectExpr(
        "kind",
        "event_time",
        "ingest_ts AS processed_at",
        "seq",
        *DIMENSIONS,
        *kept,
        "1 AS n",
        f"{discount} > 0 AS has_discount",
        f"CAST({fee} AS {WIDE}) AS fee",
        f"CAST({discount} AS {WIDE}) AS discount",
        f"CAST({fee} * {NET_FACTOR!r}D AS {WIDE}) AS net",
        f"CAST(greatest(0D, {fee} + {discount} - {fee}) AS {WIDE}) AS income",
        *[f"CAST({name} AS {WIDE}) AS {name}" for name in DURATIONS],
    )


def trigger_records(triggers: DataFrame) -> DataFrame:
    """Metric records of booking triggers."""
    return _contributions(_priced(triggers), ["event_time", "processed_at", *DIMENSIONS, "seq"])


def trigger_minutes(triggers: DataFrame, level: str = "MINUTE", placed: bool = False) -> DataFrame:
    """Booking KPIs per minute, or per bucket of a coarser ``level``: same totals as summing records, with less shuffled.

    Triggers are summed first, one wide row per kind, scope and minute in place of up to
    fifteen narrow ones, and only then unfolded into metrics. Grouping by which optional
    values are present keeps each metric's own first and last event. Rows of one minute
    that differ in those flags are merged by the roll-up. With ``placed`` the triggers themselves are shuffled, by scope
    and minute: whatever is then grouped by these and more, like :func:`marts.merge_minutes`, needs no other shuffle.
    """
    present = [F.expr(f"{name} IS NOT NULL").alias(f"has_{name}") for name in DURATIONS]
    timed = triggers.withColumn("bucket_start", timing.truncate_to(F.col("event_time"), level))
    if placed:
        used = ["kind", "event_time", "ingest_ts", "seq", *DIMENSIONS, "platform_fee", "discount_amount", *DURATIONS]
        timed = timed.select("bucket_start", *used).repartition(*DIMENSIONS, "bucket_start")
    wide = (
        _priced(timed, "bucket_start")
        .groupBy("kind", *DIMENSIONS, "bucket_start", "has_discount", *present)
        .agg(
            *[F.sum(name).alias(name) for name in ("n", "fee", "discount", "net", "income", *DURATIONS)],
            F.min("event_time").alias("first_event_at"),
            F.max("event_time").alias("last_event_at"),
            F.max("processed_at").alias("last_ingested_at"),
            F.max(timing.processing_lag_ms(F.col("event_time"), F.col("processed_at"))).alias("processing_lag_ms"),
            F.max("seq").alias("seq"),
        )
    )
    kept = [*DIMENSIONS, "bucket_start", "first_event_at", "last_event_at", "last_ingested_at", "processing_lag_ms", "seq"]
    return _contributions(wide, kept)


def booking_records(bookings: DataFrame, dedupe_terminal: bool = False) -> DataFrame:
    """Booking KPIs as metric records."""
    return trigger_records(booking_triggers(bookings, dedupe_terminal))


def trigger_activity(triggers: DataFrame) -> DataFrame:
    """Passenger activity: who requested, accepted, completed or canceled, and when."""
    return triggers.filter("passenger_id <> ''").selectExpr(
        "passenger_id", "kind AS type", "event_time", "seq", "ingest_ts"
    )


def trigger_routes(triggers: DataFrame) -> DataFrame:
    """Pickup (1) and dropoff (2) points of requested bookings that have coordinates."""

    def stop(number: int, lat: str, lon: str) -> str:
        point = f"'latitude', CAST({lat} AS {COORDINATE}), 'longitude', CAST({lon} AS {COORDINATE})"
        return m.when(f"{lat} IS NOT NULL AND {lon} IS NOT NULL", f"named_struct('sequence_no', {number}, {point})")

    stops = ", ".join([stop(1, "pickup_lat", "pickup_lon"), stop(2, "dropoff_lat", "dropoff_lon")])
    return triggers.filter("kind = 'REQUESTED' AND booking_id <> ''").selectExpr(
        "booking_id",
        "'PATH' AS segment_type",
        f"inline(array({stops}))",
        "event_time",
        "ingest_ts AS received_at",
        "seq",
    ).filter("sequence_no IS NOT NULL")
