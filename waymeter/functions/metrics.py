"""Building blocks of metric records, as SQL expression text.

A contribution is one addition to a KPI. Its four measures are value, numerator,
denominator and sample size; how they combine depends on the metric's catalog row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.schema import DIMENSIONS, WIDE
from waymeter.sources.catalog import UNITS


def sampled(name: str, value, numerator, denominator, sample) -> str:
    """One contribution with all four measures given."""
    measures = {
        "metric_value": value, "numerator_value": numerator,
        "denominator_value": denominator, "sample_size": sample,
    }
    wide = ", ".join(f"'{key}', CAST({text} AS {WIDE})" for key, text in measures.items())
    return f"named_struct('metric_name', '{name}', 'metric_unit', '{UNITS[name]}', {wide})"


def metric(name: str, value="1") -> str:
    return sampled(name, value, value, 0, 0)


def ratio(name: str, numerator, denominator) -> str:
    return sampled(name, numerator, numerator, denominator, 0)


def duration(name: str, seconds, count="1") -> str:
    return sampled(name, seconds, seconds, count, count)


def when(condition: str, contribution: str) -> str:
    return f"CASE WHEN {condition} THEN {contribution} END"


def placed(contribution: str, condition: str, event_time: str, processed_at: str, scope: dict[str, str] | None = None) -> str:
    """A contribution placed in time and scope, where the condition holds."""
    scope = scope or {name: "''" for name in DIMENSIONS}
    dims = ", ".join(f"'{name}', {scope[name]}" for name in DIMENSIONS)
    place = f"named_struct('m', {contribution}, 'event_time', {event_time}, 'processed_at', {processed_at}, {dims})"
    return when(condition, place)


def explode_placed(df: DataFrame, emissions: list[str]) -> DataFrame:
    """One record row per contribution whose condition holds."""
    # a condition that does not hold leaves a null row; dropping it afterwards stays compiled
    rows = df.selectExpr("seq", f"inline(array({', '.join(emissions)}))").filter("m IS NOT NULL")
    return rows.select("m.*", "event_time", "processed_at", *DIMENSIONS, "seq")


def metric_key() -> Column:
    """The nine key parts of a fact row as one string; null parts count as empty."""
    parts = [
        "metric_name", "bucket_granularity", "date_format(bucket_start, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        *DIMENSIONS, "cohort_key", "entity_type", "entity_id",
    ]
    return F.expr("concat_ws('|', " + ", ".join(f"coalesce({part}, '')" for part in parts) + ")")
