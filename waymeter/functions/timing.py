"""Time functions.

Every timestamp in the engine is a TIMESTAMP_NTZ holding UTC, and sessions run in UTC
(session.SETTINGS). Buckets are cut on the local clock of the reporting zone and given
back as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

REPORTING_ZONE = "Asia/Singapore"
GRANULARITIES = ("MINUTE", "HOUR", "DAY", "WEEK", "MONTH")
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?Z$"
NTZ = "timestamp_ntz"


def parse_instant(text: Column) -> Column:
    """An ISO-8601 UTC instant as TIMESTAMP_NTZ; null for empty or malformed text."""
    body = F.rtrim(text, F.lit("Z"))
    return F.when(text.rlike(ISO_INSTANT), body.try_cast(NTZ))


def to_utc(ts: Column) -> Column:
    """A TIMESTAMP (an instant) as TIMESTAMP_NTZ in UTC, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast(NTZ))


def to_local(ts: Column, zone: str = REPORTING_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def from_local(ts: Column, zone: str = REPORTING_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def local_day(ts: Column, zone: str = REPORTING_ZONE) -> Column:
    """The calendar day in the reporting zone."""
    return to_local(ts, zone).cast("date")


def floor_local(local: Column, granularity: str) -> Column:
    """Start of the calendar unit that holds a local time."""
    # date_trunc would pass through TIMESTAMP and the session zone; dates do not.
    day = local.cast("date")
    if granularity == "MONTH":
        return F.trunc(day, "MM").cast(NTZ)
    if granularity == "WEEK":
        return F.date_sub(day, F.weekday(day)).cast(NTZ)
    if granularity == "DAY":
        return day.cast(NTZ)
    minutes = F.minute(local) if granularity == "MINUTE" else F.lit(0)
    return day.cast(NTZ) + F.make_dt_interval(F.lit(0), F.hour(local), minutes)


def truncate_to(ts: Column, granularity: str, zone: str = REPORTING_ZONE) -> Column:
    """Start of the bucket that holds ``ts``; unknown granularities mean MINUTE."""
    name = granularity.upper()
    return from_local(floor_local(to_local(ts, zone), name if name in GRANULARITIES else "MINUTE"), zone)


def bucket_end(start: Column, granularity: str, zone: str = REPORTING_ZONE) -> Column:
    """Calendar arithmetic in the reporting zone: the start of the following bucket."""
    step = {
        "HOUR": F.make_interval(hours=F.lit(1)),
        "DAY": F.make_interval(days=F.lit(1)),
        "WEEK": F.make_interval(weeks=F.lit(1)),
        "MONTH": F.make_interval(months=F.lit(1)),
    }.get(granularity.upper(), F.make_interval(mins=F.lit(1)))
    return from_local(to_local(start, zone) + step, zone)


def days(count: int) -> Column:
    return F.make_dt_interval(F.lit(count))


def minutes(count: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(count))


def millis_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds as a double cut to milliseconds; null if either end is null."""
    return millis_between(start, end) / F.lit(1000.0)


def day_gap(start: Column, end: Column, zone: str = REPORTING_ZONE) -> Column:
    """Whole calendar days between two instants, on the reporting zone's calendar."""
    return F.datediff(local_day(end, zone), local_day(start, zone))


def floor_millis(ts: Column) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), ts) % F.expr("0.001BD"))


def processing_lag_ms(event_time: Column, processed_at: Column) -> Column:
    return F.greatest(F.lit(0), millis_between(event_time, processed_at).cast("int"))


def rounded_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end``, rounded half away from zero, as INT."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.round(micros.cast("decimal(24,6)") / F.lit(1000000), 0).cast("int")


def utc_day_name(prefix: str, ts: Column) -> Column:
    """Name of the daily document partition: ``prefix-yyyy.MM.dd`` by UTC day."""
    return F.concat(F.lit(prefix + "-"), F.regexp_replace(ts.cast("date").cast("string"), "-", "."))
