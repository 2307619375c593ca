"""Daily cohorts, retention and churn rates, and the supply and demand map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymeter.functions import timing
from waymeter.schema import DIMENSIONS


#: Days that activity moves forward: the base of retention and of churn.
SHIFTS = {"prev": 1, "tminus3": 3}
BASES = {"retention": "prev", "churn": "tminus3"}


def daily_counts(facts: DataFrame, metrics: list[str]) -> DataFrame:
    """Metrics per reporting day and scope."""
    return (
        facts.filter(F.col("metric_name").isin(metrics) & (F.col("bucket_granularity") == "DAY"))
        .groupBy("metric_name", timing.local_day(F.col("bucket_start")).alias("day"), *DIMENSIONS)
        .agg(F.sum("metric_value").alias("value"))
    )


def shifted_active(facts: DataFrame, users: list[str]) -> DataFrame:
    """Active counts of the day and of three days before, as metrics of each day.

    Days without activity after an active day show up too: the count moves forward.
    """
    moved = [F.struct(F.concat("metric_name", F.lit(f"_{tag}")).alias("metric_name"), F.date_add("day", n).alias("day")) for tag, n in SHIFTS.items()]
    counts = daily_counts(facts, [f"active_{who}" for who in users])
    return counts.select(F.inline(F.array(*moved)), *DIMENSIONS, F.col("value").alias("metric_value"))


def rates(facts: DataFrame, users: list[str]) -> DataFrame:
    """Retention against t-1 and churn against t-3, per day and scope; null without a base.

    One pass: each daily count goes to the rates and days it is numerator or base of, and they are
    summed where they meet.
    """
    roles = {}
    for who in users:
        for kind, tag in BASES.items():
            name = f"{kind}_rate_{who}"
            roles.setdefault(f"{kind}_{who}", []).append((name, 0, "value", "NULL"))
            roles.setdefault(f"active_{who}", []).append((name, SHIFTS[tag], "NULL", "value"))
    part = "named_struct('rate', '{}', 'on', date_add(day, {}), 'numerator', CAST({} AS DECIMAL(38,6)), 'denominator', CAST({} AS DECIMAL(38,6)))"
    cases = " ".join(f"WHEN '{metric}' THEN array({', '.join(part.format(*role) for role in given)})" for metric, given in roles.items())
    parts = daily_counts(facts, list(roles)).selectExpr(f"inline(CASE metric_name {cases} END)", *DIMENSIONS)
    joined = parts.groupBy("rate", "on", *DIMENSIONS).agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))
    n, d = F.col("numerator").cast("double"), F.col("denominator").cast("double")
    return joined.filter("numerator IS NOT NULL").select(
        F.col("rate").alias("metric_name"), F.col("on").alias("day"), *DIMENSIONS,
        F.col("numerator").cast("bigint").alias("numerator_value"),
        F.coalesce(F.col("denominator").cast("bigint"), F.lit(0)).alias("denominator_value"),
        F.round(F.when(d > 0, n / d), 6).alias("metric_value"),
    )


def cohort_retention(activity: DataFrame, key: str, time: str = "event_time") -> DataFrame:
    """Users of each first-day cohort active on each later day, with trips.

    Rows shrink to one per user and day before any window, so a heavy user has at most
    one row per day.
    """
    days = activity.groupBy(key, timing.local_day(F.col(time)).alias("day")).agg(F.count(F.lit(1)).alias("trips"))
    first = F.min("day").over(W.partitionBy(key))
    return (
        days.withColumn("cohort_day", first)
        .groupBy("cohort_day", "day")
        .agg(F.count(F.lit(1)).alias("users"), F.sum("trips").alias("trips"))
        .select(
            "cohort_day", "day", F.datediff("day", "cohort_day").alias("age_days"), "users", "trips",
            F.round(F.col("trips") / F.col("users"), 6).alias("trips_per_user"),
        )
    )


def heat_map(demand: DataFrame, supply: DataFrame, cells_per_degree: int = 100, granularity: str = "HOUR") -> DataFrame:
    """Requests and available drivers per map cell and time bucket.

    Demand has (lat, lon, event_time), supply also availability. A driver counts once per
    cell and bucket.
    """

    def placed(df: DataFrame) -> DataFrame:
        cell = lambda name: F.floor(F.col(name) * cells_per_degree).cast("int")
        return df.withColumns(
            {
                "cell_lat": cell("lat"),
                "cell_lon": cell("lon"),
                "bucket_start": timing.truncate_to(F.col("event_time"), granularity),
            }
        )

    place = ["bucket_start", "cell_lat", "cell_lon"]
    wanted = placed(demand).select(*place, F.lit(1).alias("requests"), F.lit(0).alias("drivers"))
    free = placed(supply.filter("availability IN ('AVAILABLE', 'ONLINE')"))
    present = free.select(*place, "driver_id").distinct().select(*place, F.lit(0).alias("requests"), F.lit(1).alias("drivers"))
    totals = wanted.unionByName(present).groupBy(*place).agg(
        F.sum("requests").alias("requests"), F.sum("drivers").alias("drivers")
    )
    gap: Column = F.col("requests") - F.col("drivers")
    return totals.select("*", gap.alias("gap"))
