"""Reconciliation and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.functions import timing


def _sum_of(name: str, column: str = "metric_value") -> Column:
    return F.sum(F.when(F.col("metric_name") == name, F.col(column)).otherwise(0))


def request_count_check(bookings: DataFrame, facts: DataFrame, since: Column) -> DataFrame:
    """Bookings created against request_order in the mart, within one percent."""
    source = bookings.filter((F.col("created_at") >= since) & (F.col("status") != "DRAFT")).agg(
        F.countDistinct("booking_id").alias("expected_count"), F.lit(None).cast("bigint").alias("actual_count")
    )
    mart = facts.filter(
        (F.col("metric_name") == "request_order")
        & (F.col("bucket_start") >= since)
        & (F.col("bucket_granularity") == "MINUTE")
    ).agg(
        F.lit(None).cast("bigint").alias("expected_count"),
        F.coalesce(F.round(F.sum("metric_value")).cast("bigint"), F.lit(0)).alias("actual_count"),
    )
    # two one-row frames: united and folded, no join
    both = source.unionByName(mart).agg(
        F.max("expected_count").alias("expected_count"), F.max("actual_count").alias("actual_count")
    )
    diff = F.abs(F.col("expected_count") - F.col("actual_count"))
    percent = F.when(F.col("expected_count") > 0, diff / F.col("expected_count") * 100.0).otherwise(0.0)
    return both.select(
        "*", diff.alias("diff"), F.round(percent, 6).alias("diff_pct"), (percent <= 1.0).alias("passed")
    )


def acceptance_check(facts: DataFrame, granularity: str = "HOUR", since: Column | None = None, limit: int | None = 10) -> DataFrame:
    """acceptance_rate against accept_order / request_order per bucket, largest gap first.

    Numerators and denominators are summed over scope before dividing, on both sides.
    """
    rows = facts.filter(F.col("bucket_granularity") == granularity)
    if since is not None:
        rows = rows.filter(F.col("bucket_start") >= since)
    rate = lambda n, d: F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(0.0)
    of = lambda name, column: F.sum(F.when(F.col("metric_name") == name, F.col(column)))
    # one pass; a bucket needs rows of both kinds
    sums = (
        rows.filter(F.col("metric_name").isin("request_order", "accept_order", "acceptance_rate"))
        .groupBy("bucket_start")
        .agg(
            _sum_of("request_order").alias("requests"),
            _sum_of("accept_order").alias("accepts"),
            of("acceptance_rate", "numerator_value").alias("n"),
            of("acceptance_rate", "denominator_value").alias("d"),
            F.count(F.when(F.col("metric_name") == "acceptance_rate", 1)).alias("rates"),
            F.count(F.when(F.col("metric_name") != "acceptance_rate", 1)).alias("counts"),
        )
        .filter("rates > 0 AND counts > 0")
        .select("bucket_start", rate(F.col("accepts"), F.col("requests")).alias("calculated"), rate(F.col("n"), F.col("d")).alias("reported"))
    )
    gaps = sums.select(
        "bucket_start",
        F.round("calculated", 6).alias("calculated_rate"),
        F.round("reported", 6).alias("reported_rate"),
        F.round(F.abs(F.col("calculated") - F.col("reported")), 6).alias("diff"),
    )
    gaps = gaps.withColumn("passed", F.col("diff") <= 0.01)
    return gaps if limit is None else gaps.orderBy(F.col("diff").desc(), "bucket_start").limit(limit)


def money_check(facts: DataFrame, granularity: str = "HOUR", since: Column | None = None, limit: int | None = 10) -> DataFrame:
    """gsv = revenue_vat + discount and revenue_net = revenue_vat / 1.1, per bucket."""
    rows = facts.filter(F.col("bucket_granularity") == granularity)
    if since is not None:
        rows = rows.filter(F.col("bucket_start") >= since)
    names = ["gsv", "revenue_vat", "revenue_net", "discount_order"]
    sums = (
        rows.filter(F.col("metric_name").isin(names))
        .groupBy("bucket_start")
        .agg(*[_sum_of(name).cast("decimal(30,6)").alias(name) for name in names])
        .filter("gsv > 0")
    )
    checked = sums.select(
        "*",
        F.abs(F.col("gsv") - (F.col("revenue_vat") + F.col("discount_order"))).cast("decimal(30,6)").alias("gsv_check"),
        F.round(F.abs(F.col("revenue_net").cast("double") - F.col("revenue_vat").cast("double") / 1.1), 3).alias("net_check"),
    ).withColumn("passed", F.expr("gsv_check <= 1 AND net_check <= 1"))
    return checked if limit is None else checked.orderBy(F.col("gsv_check").desc(), "bucket_start").limit(limit)


def late_events(bookings: DataFrame, facts: DataFrame) -> DataFrame:
    """For each booking, whether its creation minute shows requests in the mart.

    Both sides are reduced to one row per minute, then joined.
    """
    asked = bookings.filter("lower(op) = 'c'").groupBy(
        timing.truncate_to(F.coalesce("created_at", "updated_at", "ingest_ts"), "MINUTE").alias("bucket_start")
    ).agg(F.countDistinct("booking_id").alias("bookings"))
    shown = (
        facts.filter("bucket_granularity = 'MINUTE' AND metric_name = 'request_order' AND metric_value > 0")
        .groupBy("bucket_start")
        .agg(F.count(F.lit(1)).alias("rows_found"))
    )
    return asked.join(shown, "bucket_start", "left").select(
        "bucket_start", "bookings", F.coalesce("rows_found", F.lit(0)).alias("rows_found"),
        (F.coalesce("rows_found", F.lit(0)) > 0).alias("found"),
    )


def sla_status(freshness: DataFrame, seconds: int = 5) -> DataFrame:
    """OK or LAGGING per mart table, by ingestion lag."""
    lagging = F.coalesce(F.col("ingestion_lag_seconds") > seconds, F.lit(False))
    return freshness.select(
        "source_name", "ingestion_lag_seconds", "processing_lag_seconds",
        F.when(lagging, "LAGGING").otherwise("OK").alias("status"),
    )


def fare_check(fares: DataFrame) -> DataFrame:
    """Fares whose amounts do not add up, by booking.

    after = before - discount, total = after + additional, income = after - fee + additional.
    """
    return fares.select(
        "booking_id",
        (F.col("after_discount") == F.col("before_discount") - F.col("discount")).alias("discount_ok"),
        (F.col("total") == F.col("after_discount") + F.col("additional")).alias("total_ok"),
        (F.col("driver_income") == F.col("after_discount") - F.col("fee") + F.col("additional")).alias("income_ok"),
    )


def driver_earnings(earnings: DataFrame) -> DataFrame:
    """Earnings per driver."""
    return earnings.groupBy("driver_id").agg(F.sum("amount").alias("amount"))


def driver_balances(drivers: DataFrame, earnings: DataFrame) -> DataFrame:
    """Every driver with the balance of the earnings account, zero if none."""
    joined = drivers.select("driver_id").join(driver_earnings(earnings), "driver_id", "left")
    return joined.select("driver_id", F.coalesce("amount", F.lit(0)).cast("bigint").alias("balance"))


def payouts(balances: DataFrame) -> DataFrame:
    """Transaction and history lines of positive balances, as one ledger."""
    paid = balances.filter("balance > 0")
    return paid.selectExpr(
        "driver_id",
        "inline(array("
        "named_struct('entry', 'TRANSACTION', 'detail', 'PAYOUT', 'amount', balance, 'previous_balance', CAST(NULL AS BIGINT), 'new_balance', CAST(NULL AS BIGINT)), "
        "named_struct('entry', 'HISTORY', 'detail', 'EARNINGS', 'amount', balance, 'previous_balance', 0L, 'new_balance', balance)))",
    )


def missing_entities(entities: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Entities without any row: drivers without a position, bookings without a fare."""
    return entities.join(rows.select(key), key, "left_anti")


def recent_writes(facts: DataFrame, as_of: Column, minutes: int = 2) -> DataFrame:
    """Facts written in the last minutes, to see that writing resumed after an outage."""
    return facts.filter(F.col("last_updated") >= as_of - timing.minutes(minutes)).agg(
        F.count(F.lit(1)).alias("recent_rows")
    ).withColumn("passed", F.col("recent_rows") > 0)


def completeness(bookings: DataFrame, facts: DataFrame) -> DataFrame:
    """Per reporting day: change rows, distinct changes, duplication rate and mart coverage."""
    created = F.coalesce("created_at", "updated_at", "ingest_ts")
    # distinct (booking, change) first, so no count-distinct state grows with a day
    changes = bookings.withColumn("day", timing.local_day(created)).groupBy("day", "booking_id", "seq").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.expr("lower(op) = 'c'").cast("int")).alias("is_request")
    )
    source = changes.groupBy("day").agg(
        F.sum("copies").alias("change_rows"),
        F.count(F.lit(1)).alias("distinct_changes"),
        F.sum("is_request").alias("requests"),
    )
    mart = (
        facts.filter("metric_name = 'request_order' AND bucket_granularity = 'DAY'")
        .groupBy(timing.local_day(F.col("bucket_start")).alias("day"))
        .agg(F.sum("metric_value").cast("bigint").alias("reported"))
    )
    duplicated = 1.0 - F.col("distinct_changes") / F.col("change_rows")
    covered = F.when(F.col("requests") > 0, F.coalesce("reported", F.lit(0)) / F.col("requests")).otherwise(1.0)
    return source.join(mart, "day", "left").select(
        "day", "change_rows", "distinct_changes", "requests", F.coalesce("reported", F.lit(0)).alias("reported"),
        F.round(duplicated, 6).alias("duplication_rate"), F.round(covered, 6).alias("completeness"),
    )
