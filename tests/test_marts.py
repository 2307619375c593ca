import pytest
from fixtures import NOON, after, bookings, t, trip
from pyspark.sql import functions as F

from waymeter.functions import timing
from waymeter.operators import bookings as b, buckets, marts
from waymeter.plans import quality, views
from waymeter.schema import FACT, FACT_KEY, SNAPSHOT
from waymeter.session import work_folder
from waymeter.sources import marts as tables
from waymeter.sources.catalog import metric_catalog


@pytest.fixture(scope="module")
def facts(spark):
    rows = trip("b1") + trip("b2", fee=900.0, discount=0.0, seq=10, start=90)
    return buckets.roll_up(b.trigger_minutes(b.booking_triggers(bookings(spark, rows)))).cache()


def test_catalog(spark):
    cat = metric_catalog(spark)
    assert cat.count() == cat.select("metric_name").distinct().count() == 41
    assert cat.filter("subject_area = 'Derived'").count() == 8
    assert cat.filter("NOT is_additive").count() == 12


def test_fact_shape(facts):
    assert marts.fact_table(facts).columns == FACT
    assert facts.count() == facts.select(*FACT_KEY).distinct().count()
    assert dict(facts.dtypes)["metric_value"] == "decimal(20,6)"
    assert {r[0] for r in facts.select("cohort_key", "entity_type", "entity_id").distinct().collect()} == {"ALL"}


def test_daily_view(spark, facts):
    rows = {r.metric_name: r for r in views.metric_view(facts, metric_catalog(spark), "DAY").collect()}
    assert rows["acceptance_rate"].metric_value == 1.0 and rows["order_time"].metric_value == 120.0
    assert rows["gsv"].metric_value == 55_900.0
    assert rows["cancel_rate"].metric_value == 0.0
    assert rows["productivity"].metric_value is None
    assert "order_time_total" not in rows
    assert rows["gsv"].bucket_day == t("2024-12-31T16:00")


def test_view_reads_one_granularity_from_the_mart(spark, facts):
    path = work_folder(spark, "mart")
    tables.write_table(marts.fact_table(facts), path, "fact_metric_bucket")
    back = tables.read_table(spark, path, "fact_metric_bucket")
    assert sorted(back.select(*FACT).collect()) == sorted(marts.fact_table(facts).collect())
    plan = views.metric_view(back, metric_catalog(spark), "DAY")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_granularity" in plan and "BroadcastHashJoin" in plan
    with pytest.raises(ValueError):
        tables.read_table(spark, path, "other")


def test_scope_snapshot_counts_granularities(spark, facts):
    cat = metric_catalog(spark)
    value = lambda g: views.scope_snapshot(facts, cat, g).filter("metric_name = 'gsv'").first().metric_value
    assert value("MINUTE") == 55_900.0 and value(None) == 5 * 55_900.0


def test_snapshot_is_the_month_of_the_newest_event(spark):
    rows = trip("b1") + trip("b2", fee=900.0, discount=0.0, seq=10, start=60 * 24 * 40)
    found = buckets.roll_up(b.trigger_minutes(b.booking_triggers(bookings(spark, rows))))
    got = marts.latest_snapshot(found)
    assert got.columns == SNAPSHOT
    row = got.filter("metric_name = 'gsv'").first()
    assert (float(row.metric_value), row.data_granularity, row.event_time) == (900.0, "MONTH", after(60 * 24 * 40 + 15))


def test_fact_upsert_overwrites_and_widens(spark, facts):
    one = marts.fact_table(facts).filter("metric_name = 'gsv' AND bucket_granularity = 'DAY'")
    newer = one.withColumns({"metric_value": F.lit(7).cast("decimal(20,6)"), "first_event_at": F.lit(NOON) - F.expr("INTERVAL 1 DAY"), "last_event_at": F.lit(NOON)})
    row = marts.upsert_facts(one, newer.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_event_at", "last_event_at")})).first()
    assert float(row.metric_value) == 7.0
    assert row.first_event_at < one.first().first_event_at and row.last_event_at == one.first().last_event_at


def test_upsert_needs_its_key(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError):
        marts.upsert(df, df.drop("id"), "id")
    newer = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1)], "id int, v string, seq int")
    assert sorted(map(tuple, marts.upsert(df, newer, "id", do_update=True).collect())) == [(1, "c"), (2, "d")]
    assert sorted(map(tuple, marts.upsert(df, newer, "id").collect())) == [(1, "a"), (2, "d")]


def test_constraints(spark, facts):
    bad = marts.fact_table(facts).limit(4).withColumn("metric_value", F.lit(-1).cast("decimal(20,6)"))
    kept, rejected = buckets.split_valid(marts.fact_table(facts).unionByName(bad), metric_catalog(spark))
    assert (kept.count(), rejected.count()) == (facts.count(), 4)


def test_freshness_and_sla(spark, facts):
    snapshot = marts.latest_snapshot(facts)
    nothing = spark.createDataFrame([], "event_time timestamp_ntz, received_at timestamp_ntz")
    fresh = views.data_freshness(facts, snapshot, nothing, nothing, F.lit(after(105)).cast("timestamp_ntz") + F.expr("INTERVAL '5.5' SECOND"))
    rows = {r.source_name: r for r in quality.sla_status(fresh).collect()}
    assert rows["fact_metric_bucket"].ingestion_lag_seconds == 6 and rows["fact_metric_bucket"].status == "LAGGING"
    assert rows["booking_route_segments"].ingestion_lag_seconds is None and rows["booking_route_segments"].status == "OK"


def test_refresh_rewrites_only_touched_folders(spark):
    import glob
    import os

    path, log = work_folder(spark, "mart"), marts.FactLog(spark, work_folder(spark, "log"))
    totals = lambda rows: b.trigger_minutes(b.booking_triggers(bookings(spark, rows)))
    days = [trip(f"b{d}", seq=10 * d, start=d * 24 * 60) for d in range(6)]
    log.write(totals(sum(days, [])), "s", 0)
    tables.write_table(buckets.roll_up(log.minutes("s")), path, "fact_metric_bucket")
    files = lambda: {os.path.dirname(f): os.path.basename(f) for f in glob.glob(f"{path}/fact_metric_bucket/*/*/*.parquet")}
    before = files()
    log.write(totals(trip("late", seq=90, start=2 * 24 * 60 + 3)), "s", 1)
    marts.refresh_facts(log, "s", 1, path)
    after_ = files()
    changed = {os.path.relpath(k, f"{path}/fact_metric_bucket") for k in after_ if before.get(k) != after_[k]}
    assert before.keys() == after_.keys()
    assert sorted(c.split("/")[0].split("=")[1] for c in changed) == ["DAY", "HOUR", "MINUTE", "MONTH", "WEEK"]
    whole = buckets.roll_up(log.minutes("s")).select(*FACT)
    stored = tables.read_table(spark, path, "fact_metric_bucket").select(*FACT)
    assert sorted(whole.collect()) == sorted(stored.collect())
    fresh = tables.write_table(marts.latest_snapshot(buckets.roll_up(log.minutes("s"), ("MONTH",))), path, "latest_metric_snapshot")
    assert fresh is None
    seen = spark.read.schema(tables.FRESHNESS_ROW).parquet(f"{path}/freshness/fact_metric_bucket").agg(F.max("last_event_time")).first()[0]
    assert seen == whole.agg(F.max("last_event_at")).first()[0]


def test_build_and_refresh_in_steps_equal_the_whole(spark):
    """Steps of few minute rows give the same table, each with shuffles of its own days only; what has no bucket stays."""
    path, log = work_folder(spark, "mart"), marts.FactLog(spark, work_folder(spark, "log"))
    totals = lambda rows: b.trigger_minutes(b.booking_triggers(bookings(spark, rows)))
    days = [trip(f"b{d}", seq=10 * d, start=d * 11 * 24 * 60) for d in range(8)]
    undated = totals(trip("none", seq=900)).withColumn("bucket_start", F.lit(None).cast("timestamp_ntz"))
    log.write(totals(sum(days, [])).unionByName(undated), "s", 0)
    stored = lambda: sorted(map(str, tables.read_table(spark, path, "fact_metric_bucket").select(*FACT).collect()))
    whole = lambda: sorted(map(str, buckets.roll_up(log.minutes("s")).select(*FACT).collect()))
    folders = buckets.touched_folders(log.minutes("s")).filter("bucket_date IS NOT NULL").collect()
    steps = marts._steps(log.minutes("s"), folders, 40)
    assert len(steps) > 3 and sorted(sum(steps, [])) == sorted(folders)
    marts.build_facts(log, "s", path, rows_per_step=40)
    assert stored() == whole()
    log.write(totals(trip("late", seq=990, start=3 * 11 * 24 * 60) + trip("later", seq=1_000, start=5 * 11 * 24 * 60)), "s", 1)
    marts.refresh_facts(log, "s", 1, path, rows_per_step=40)
    assert stored() == whole()
    # minutes far from the folders asked for are left out below the shuffle
    one = spark.createDataFrame([r for r in folders if r.bucket_granularity == "DAY"][:1], "bucket_granularity string, bucket_date date")
    plan = buckets.roll_up(log.minutes("s"), timing.GRANULARITIES, one)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_day" in part.split("Relation")[0] for part in plan.split("RepartitionByExpression")[1:])


def test_route_paths_are_in_order(spark):
    rows = [("b", "PATH", n, 1.0 + n, 2.0, after(n), after(n)) for n in (3, 1, 2)]
    df = spark.createDataFrame(rows, "booking_id string, segment_type string, sequence_no int, latitude double, longitude double, event_time timestamp_ntz, received_at timestamp_ntz")
    row = views.booking_route_paths(df).first()
    assert [p.sequence_no for p in row.path_points] == [1, 2, 3]
    assert (row.started_at, row.ended_at) == (after(1), after(3))


def test_registered_views_answer_sql(spark, facts):
    snapshot = marts.latest_snapshot(facts)
    places = spark.createDataFrame([], "driver_id string, event_time timestamp_ntz, service_type string, service_tier string, area_code string, latitude double, longitude double, heading_degree double, speed_kmh double, driver_status string, received_at timestamp_ntz")
    segments = spark.createDataFrame([], "booking_id string, segment_type string, sequence_no int, latitude double, longitude double, event_time timestamp_ntz, received_at timestamp_ntz")
    views.register_views(facts, snapshot, places, segments, metric_catalog(spark), F.lit(after(110)).cast("timestamp_ntz"))
    assert spark.sql("SELECT * FROM vw_metric_hourly WHERE metric_name = 'request_order'").count() == 2
    assert spark.sql("SELECT count(*) FROM dashboard_operations_realtime").first()[0] > 0
    for name in ("vw_metric_minute", "vw_metric_daily", "vw_metric_weekly", "vw_metric_monthly", "realtime_kpi_metrics", "dashboard_driver_analytics"):
        spark.sql(f"SELECT * FROM {name}").collect()


def test_audits(spark, facts):
    rows = bookings(spark, trip("b1") + trip("b2", seq=10, start=90))
    assert quality.request_count_check(rows, facts, F.lit(NOON).cast("timestamp_ntz")).first().passed
    assert quality.acceptance_check(facts).filter("NOT passed").count() == 0
    assert quality.money_check(facts).filter("NOT passed").count() == 0
    assert quality.late_events(rows, facts).filter("NOT found").count() == 0
    assert quality.recent_writes(facts, F.lit(after(105)).cast("timestamp_ntz")).first().passed


def test_roll_up_shuffles_minutes_once_and_unfanned(spark):
    """All granularities at once are the same facts as one by one, and no fanned-out row of a day is shuffled."""
    rows = [r for n in range(40) for r in trip(f"b{n}", fee=100.0 + n, seq=10 * n, start=n * 1_777)]
    minutes = b.trigger_minutes(b.booking_triggers(bookings(spark, rows))).persist()
    whole = buckets.roll_up(minutes)
    parts = [buckets.roll_up(minutes, (name,)) for name in timing.GRANULARITIES]
    for name, part in zip(timing.GRANULARITIES, parts):
        assert sorted(map(str, whole.filter(F.col("bucket_granularity") == name).collect())) == sorted(map(str, part.collect()))
    by_day = [line for line in buckets.roll_up(minutes, ("MINUTE", "DAY"))._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert by_day and all("bucket_granularity" not in line for line in by_day)
    minutes.unpersist()


def test_operations_dashboard_makes_its_snapshot_once(spark):
    """The snapshot and its newest update both read the table that was made, not the bookings again."""
    from waymeter import registry

    plan = registry.dashboard_operations_realtime(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "l_extendedprice" not in plan
