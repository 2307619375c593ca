"""Registrations, and daily activity with retention, churn and return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import metrics as m, timing
from waymeter.operators.keyed import ROWS_PER_TASK, carry, per_key
from waymeter.schema import DIMENSIONS

CHURN_DAYS = 3
LATENESS_MINUTES = 5


def churn_due(last_active: str) -> str:
    """The stream time from which a silent user counts as churned."""
    return f"({last_active} + INTERVAL {CHURN_DAYS} DAYS + INTERVAL {LATENESS_MINUTES} MINUTES)"


def churned_at(last_active: str) -> str:
    """Churn time, cut to milliseconds as a timer is."""
    due = f"({last_active} + INTERVAL {CHURN_DAYS} DAYS)"
    return f"({due} - make_dt_interval(0, 0, 0, extract(SECOND FROM {due}) % 0.001BD))"


def stream_end(df: DataFrame, column: str = "event_time") -> Column:
    """The highest event time as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def registrations(changes: DataFrame, key: str, name: str, dimensions: list[str]) -> DataFrame:
    """First ``c`` change per key as one record; an aggregate, so heavy keys are safe."""
    first = (
        changes.filter("lower(op) = 'c'")
        .groupBy(key)
        .agg(F.min_by(F.struct("created_at", "updated_at", "ingest_ts", "seq", *dimensions), "seq").alias("r"))
        .select("r.*")
    )
    scope = {d: f"coalesce({d}, '')" if d in dimensions else "''" for d in DIMENSIONS}
    at = "coalesce(created_at, updated_at, ingest_ts)"
    return m.explode_placed(first, [m.placed(m.metric(name), "true", at, "ingest_ts", scope)])


def passenger_registrations(passengers: DataFrame) -> DataFrame:
    return registrations(passengers, "passenger_id", "new_passenger", [])


def driver_registrations(drivers: DataFrame) -> DataFrame:
    return registrations(drivers, "driver_id", "new_driver", DIMENSIONS)


def day_emissions(who: str, previous: str, condition: str, scope: dict[str, str] | None = None) -> list[str]:
    """Active on a new day, retained from the day before, returned after a churn.

    Rows have ``day`` and ``event_time``; ``previous`` is a struct of the same two.
    """
    gap = f"datediff(day, {previous}.day)"
    new_day = f"{condition} AND ({previous} IS NULL OR {gap} <> 0)"
    churned = f"event_time > {churn_due(f'{previous}.event_time')}"

    def at_row(name: str, holds: str) -> str:
        return m.placed(m.metric(name), holds, "event_time", "ingest_ts", scope)

    return [
        at_row(f"active_{who}", new_day),
        at_row(f"retention_{who}", f"{new_day} AND {gap} = 1"),
        at_row(f"return_{who}", f"{new_day} AND {gap} >= 3 AND {churned}"),
    ]


def churn_emission(who: str, last_active: str, condition: str, scope: dict[str, str] | None = None) -> str:
    """A churn, seen as soon as the stream has passed its time by the lateness."""
    at = churned_at(last_active)
    return m.placed(m.metric(f"churn_{who}"), condition, at, f"{at} + INTERVAL {LATENESS_MINUTES} MINUTES", scope)


#: A trip known from before comes before every other trip of its passenger.
KNOWN_FROM = -(2**63)


def passenger_activity_records(
    activity: DataFrame, end: Column | None = None, rows_per_task: int = ROWS_PER_TASK, known: DataFrame | None = None
) -> DataFrame:
    """Active, retained, churned and returned passengers from completed trips.

    Trips are taken in arrival order. A passenger has churned when the next trip comes,
    or the stream goes on (``end``), more than three days and the allowed lateness
    after the last one. With ``known``, the last trips before these (passenger_id, event_time and
    whether its churn was ``counted``), records go on from there.
    """
    trips = activity.filter(F.upper("type") == "COMPLETED").select(
        "passenger_id", "seq", "ingest_ts", F.coalesce("event_time", "ingest_ts").alias("event_time")
    )
    state, new, before_open, last_open = [], "true", "true", "true"
    if known is not None:
        # null for the trips of now
        state, new = ["counted"], "counted IS NULL"
        before_open, last_open = (f"coalesce(NOT {trip}counted, true)" for trip in ("previous.", ""))
        last = known.select("passenger_id", F.lit(KNOWN_FROM).alias("seq"), "event_time", *state)
        trips = trips.unionByName(last, allowMissingColumns=True)
    trips = trips.withColumn("day", timing.local_day(F.col("event_time")))
    until = stream_end(activity) if end is None else end

    def body(rows: DataFrame, chunk: list[str]) -> DataFrame:
        seen = carry(
            rows, "passenger_id", "seq", chunk, before={"previous": F.struct("day", "event_time", *state)}, final="is_last"
        )
        seen = seen.withColumn("stream_end", until)
        emissions = [
            *day_emissions("passenger", "previous", new),
            churn_emission("passenger", "previous.event_time", f"{before_open} AND event_time > {churn_due('previous.event_time')}"),
            churn_emission("passenger", "event_time", f"is_last AND {last_open} AND {churn_due('event_time')} <= stream_end"),
        ]
        return m.explode_placed(seen, emissions)

    return per_key(trips, "passenger_id", "seq", body, rows_per_task)
