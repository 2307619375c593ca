"""Driver positions: profile enrichment, and availability and activity KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import fields, metrics as m, timing
from waymeter.operators.activity import churn_due, churn_emission, day_emissions, stream_end
from waymeter.operators.keyed import ROWS_PER_TASK, carry, per_key
from waymeter.schema import DIMENSIONS


def _with_profiles(locations: DataFrame, profiles: DataFrame | None) -> DataFrame:
    """Locations and profile changes in one sequence per driver."""
    rows = locations.withColumn("is_location", F.lit(True))
    for name in DIMENSIONS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    if profiles is None:
        return rows
    changes = profiles.select("driver_id", "seq", "ingest_ts", *DIMENSIONS).withColumn("is_location", F.lit(False))
    return rows.unionByName(changes, allowMissingColumns=True)


def _last_dimensions() -> dict[str, Column]:
    return {name: F.nullif(F.col(name), F.lit("")) for name in DIMENSIONS}


def enrich_locations(locations: DataFrame, profiles: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each location with its driver's profile as it stood when the location arrived.

    A profile keeps the last non-empty value of each field. Locations of drivers
    without a profile stay, with blank fields.
    """
    columns = [*locations.columns, *[d for d in DIMENSIONS if d not in locations.columns]]

    def body(rows: DataFrame, chunk: list[str]) -> DataFrame:
        seen = carry(rows, "driver_id", "seq", chunk, upto=_last_dimensions())
        return seen.filter("is_location").withColumns({d: fields.blank(F.col(d)) for d in DIMENSIONS}).select(*columns)

    return per_key(_with_profiles(locations, profiles), "driver_id", "seq", body, rows_per_task)


def driver_records(
    locations: DataFrame,
    profiles: DataFrame | None = None,
    end: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Driver KPIs: online and busy per minute or status change, active days, churn.

    With ``profiles`` the enrichment happens in the same pass, so locations are shuffled
    once. Without it a location's own fields count, falling back to the driver's last
    known ones.
    """
    timed = locations.select(
        "driver_id",
        "seq",
        "ingest_ts",
        F.upper(fields.blank(F.col("availability"))).alias("availability"),
        F.coalesce("updated_at", "ingest_ts").alias("event_time"),
        *[d for d in DIMENSIONS if d in locations.columns],
    )
    until = stream_end(timed) if end is None else end

    def body(rows: DataFrame, chunk: list[str]) -> DataFrame:
        now, busy = F.col("event_time"), F.coalesce(F.col("availability") == "BUSY", F.lit(False))
        rows = rows.withColumns(
            {"minute": timing.truncate_to(now, "MINUTE"), "day": timing.local_day(now), "busy": busy}
        )
        seen = carry(
            rows,
            "driver_id",
            "seq",
            chunk,
            upto={**_last_dimensions(), "busy_at": F.when(busy, now)},
            before={
                "previous": F.when(F.col("is_location"), F.struct("minute", "availability")),
                "busy_before": F.when(busy, F.struct("day", "event_time")),
            },
            final="is_last",
        ).withColumns({d: fields.blank(F.col(d)) for d in DIMENSIONS})
        # the scope of a churn is the one known when its timer fires
        scope_then = F.expr(f"CASE WHEN is_location AND event_time <= {churn_due('busy_at')} THEN struct({', '.join(DIMENSIONS)}) END")
        seen = carry(
            seen, "driver_id", "seq", chunk, upto={"open_scope": scope_then}, before={"closed_scope": scope_then}
        )

        seen = seen.withColumn("stream_end", until)
        present = (
            "is_location AND (previous IS NULL OR previous.minute <> minute "
            "OR previous.availability <> availability)"
        )
        scope = {d: d for d in DIMENSIONS}
        closed = {d: f"closed_scope.{d}" for d in DIMENSIONS}
        still_open = {d: f"open_scope.{d}" for d in DIMENSIONS}

        def at_row(contribution: str, holds: str) -> str:
            return m.placed(contribution, holds, "event_time", "ingest_ts", scope)

        passed = f"busy AND event_time > {churn_due('busy_before.event_time')}"
        ended = f"is_last AND {churn_due('busy_at')} <= stream_end"
        emissions = [
            at_row(m.metric("online_driver"), f"{present} AND availability IN ('AVAILABLE', 'BUSY', 'ONLINE')"),
            at_row(m.metric("busy_driver"), f"{present} AND busy"),
            at_row(m.ratio("productivity", 0, 1), "busy AND (busy_before IS NULL OR busy_before.day <> day)"),
            *day_emissions("driver", "busy_before", "busy", scope),
            churn_emission("driver", "busy_before.event_time", passed, closed),
            churn_emission("driver", "busy_at", ended, still_open),
        ]
        return m.explode_placed(seen, emissions)

    return per_key(_with_profiles(timed, profiles), "driver_id", "seq", body, rows_per_task)
