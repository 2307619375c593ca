"""Time buckets: fan-out to granularities, aggregation, ratios, constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import timing
from waymeter.schema import FACT_KEY, MART, MEASURES, SCOPE
from waymeter.sources.catalog import GRANULARITIES

# Scope of a record that names none.
SCOPE_DEFAULTS = {"cohort_key": "ALL", "entity_type": "AGGREGATE", "entity_id": "ALL"}


# Granularities whose buckets lie within one local day, and the column that rows of a day are placed by.
WITHIN_DAY = ("MINUTE", "HOUR", "DAY")
DAY_PLACE = "_place"


def with_scope(df: DataFrame) -> DataFrame:
    """Scope columns filled in: blank dimensions and the default cohort and entity."""
    missing = {name: F.lit(SCOPE_DEFAULTS.get(name, "")) for name in SCOPE if name not in df.columns}
    return df.withColumns(missing)


def expand_granularities(
    df: DataFrame,
    time: str = "event_time",
    zone: str = timing.REPORTING_ZONE,
    granularities: tuple[str, ...] = timing.GRANULARITIES,
) -> DataFrame:
    """Each row once per granularity, with its bucket."""
    # the local time is a column of its own, so that it is computed once per row
    local = df.withColumn("_local", timing.to_local(F.col(time), zone))
    buckets = F.array(
        *[
            F.struct(
                F.lit(name).alias("bucket_granularity"),
                timing.from_local(timing.floor_local(F.col("_local"), name), zone).alias("bucket_start"),
            )
            for name in granularities
        ]
    )
    kept = [c for c in df.columns if c not in ("bucket_start", "bucket_granularity")]
    return local.select(*kept, F.inline(buckets))


def _totals(first: str, last: str, processed: str, lag: Column | str) -> list[Column]:
    return [
        *[F.sum(name).alias(name) for name in MEASURES],
        F.min(first).alias("first_event_at"),
        F.max(last).alias("last_event_at"),
        F.max(processed).alias("last_ingested_at"),
        F.max(lag).alias("processing_lag_ms"),
        F.max("seq").alias("seq"),
    ]


def minute_totals(records: DataFrame, level: str = "MINUTE") -> DataFrame:
    """Records summed per minute bucket, or per bucket of a coarser ``level``. Tasks pre-aggregate before the shuffle.

    Measures are decimals, so a sum does not depend on the order of the rows.
    """
    keys = ["metric_name", "metric_unit", *[c for c in SCOPE if c in records.columns]]
    minute = timing.truncate_to(F.col("event_time"), level).alias("bucket_start")
    lag = timing.processing_lag_ms(F.col("event_time"), F.col("processed_at"))
    return records.groupBy(*keys, minute).agg(*_totals("event_time", "event_time", "processed_at", lag))


def roll_up(minutes: DataFrame, granularities: tuple[str, ...] = timing.GRANULARITIES, folders: DataFrame | None = None) -> DataFrame:
    """Facts of the given granularities, all five by default, from minute totals.

    Every measure is a sum, minimum or maximum, so coarse buckets are exact from
    minutes, and the fan-out touches minute rows in place of records. Minutes are shuffled once, by key and local
    day, before they are fanned out; weeks and months come from days. With ``folders``
    (see :func:`touched_folders`) only buckets of these are made, and only minutes of their days are shuffled.
    """
    if folders is not None:
        # one row per day of the calendar at most
        minutes = minutes.join(F.broadcast(_days_of(folders)), timing.local_day(F.col("bucket_start")) == F.col("_day"), "left_semi")
    keys = ["metric_name", "metric_unit", *[c for c in SCOPE if c in minutes.columns]]

    def totals(rows: DataFrame, names: tuple[str, ...], *placed: str) -> DataFrame:
        wide = expand_granularities(rows, "bucket_start", granularities=names)
        if folders is not None:
            wide = wide.withColumn("bucket_date", F.col("bucket_start").cast("date")).join(folders, ["bucket_granularity", "bucket_date"], "left_semi")
        return wide.groupBy(*keys, *placed, "bucket_granularity", "bucket_start").agg(
            *_totals("first_event_at", "last_event_at", "last_ingested_at", "processing_lag_ms")
        ).drop(*placed)

    fine = tuple(name for name in granularities if name in WITHIN_DAY)
    coarse = tuple(name for name in granularities if name not in WITHIN_DAY)
    if not fine or len(granularities) == 1:
        return facts_of(totals(minutes, granularities))
    # rows of a key and day meet once, unfanned; buckets within the day need no other shuffle
    placed = minutes.withColumn(DAY_PLACE, timing.local_day(F.col("bucket_start"))).repartition(*keys, DAY_PLACE)
    # a plan each over the same shuffle, so that a task holds the sums of one granularity
    found = reduce(DataFrame.unionByName, [totals(placed, (name,), DAY_PLACE) for name in fine])
    if coarse:
        # only sums of days are fanned out and shuffled again
        days = placed.withColumn("bucket_start", timing.truncate_to(F.col("bucket_start"), "DAY")).groupBy(*keys, DAY_PLACE, "bucket_start").agg(
            *_totals("first_event_at", "last_event_at", "last_ingested_at", "processing_lag_ms")
        )
        found = found.unionByName(totals(days.drop(DAY_PLACE), coarse))
    return facts_of(found)


def touched_folders(minutes: DataFrame, granularities: tuple[str, ...] = timing.GRANULARITIES) -> DataFrame:
    """Granularity and date of every bucket that these minutes add to."""
    wide = expand_granularities(minutes.select("bucket_start"), "bucket_start", granularities=granularities)
    return wide.select("bucket_granularity", F.col("bucket_start").cast("date").alias("bucket_date")).distinct()


#: Days from the start of the longest bucket to its last.
LAST_DAY = {"WEEK": 6, "MONTH": 30}


def _days_of(folders: DataFrame) -> DataFrame:
    """All local days whose minutes may fall into these folders, in whatever zone; some around them too."""
    last = F.col("bucket_date") + 1
    for name, days in LAST_DAY.items():
        last = F.when(F.col("bucket_granularity") == name, F.col("bucket_date") + 1 + days).otherwise(last)
    return folders.select(F.explode(F.sequence(F.col("bucket_date") - 1, last)).alias("_day")).distinct()


def facts_of(totals: DataFrame) -> DataFrame:
    """Totals in the shape of the fact table, plus ``metric_unit`` and the last ``seq``."""
    return with_scope(totals).select(
        *FACT_KEY,
        *[F.col(name).cast(MART).alias(name) for name in MEASURES],
        "first_event_at",
        "last_event_at",
        "last_ingested_at",
        "processing_lag_ms",
        F.col("last_ingested_at").alias("last_updated"),
        "metric_unit",
        "seq",
    )


def bucket_facts(records: DataFrame, granularities: tuple[str, ...] = timing.GRANULARITIES) -> DataFrame:
    """The fact table of a set of metric records."""
    # a single granularity needs no minutes in between
    return roll_up(minute_totals(records, granularities[0] if len(granularities) == 1 else "MINUTE"), granularities)


def ratio_of(
    additive: Column, value: Column, numerator: Column, denominator: Column, sample: Column, digits: int | None = None
) -> Column:
    """Shown value of a metric: its sum, or numerator over denominator or sample."""
    as_double = [c.cast("double") for c in (value, numerator, denominator, sample)]
    v, n, d, s = as_double
    shown = F.when(additive, v).when(d > 0, n / d).when(s > 0, n / s)
    return shown if digits is None else F.round(shown, digits)


def split_valid(facts: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows that meet the fact table's constraints, and the rest.

    Known metric, allowed granularity, no negative measure or lag.
    """
    known = F.broadcast(catalog.select("metric_name", F.lit(True).alias("_known")))
    joined = facts.join(known, "metric_name", "left")
    numbers = [*MEASURES, "processing_lag_ms"]
    sound = F.col("_known").isNotNull() & F.col("bucket_granularity").isin(list(GRANULARITIES))
    for name in numbers:
        sound = sound & (F.col(name) >= 0)
    flagged = joined.withColumn("_sound", F.coalesce(sound, F.lit(False))).drop("_known")
    return flagged.filter("_sound").drop("_sound"), flagged.filter("NOT _sound").drop("_sound")
