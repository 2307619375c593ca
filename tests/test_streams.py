"""Live jobs against batch results. Streams read files in several micro-batches."""

import datetime as dt

import pytest
from fixtures import after, bookings, locations, profiles, t, trip
from pyspark.sql import functions as F

from waymeter import schema
from waymeter.functions import timing
from waymeter.operators import activity as a, bookings as b, buckets, drivers as d, marts
from waymeter.schema import FACT
from waymeter.session import work_folder
from waymeter.streaming import jobs

NOW = {"availableNow": True}


def feed(spark, df, slices: list[str]):
    """A file stream with one micro-batch per condition, in that order."""
    folder = work_folder(spark, "feed")
    for condition in slices:
        df.filter(condition).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def finish(running):
    try:
        assert running.awaitTermination(240)
    finally:
        running.stop()


def same(one, other):
    return one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


@pytest.fixture(scope="module")
def many_trips(spark):
    rows = []
    for i in range(30):
        rows += trip(f"b{i}", fee=1000.0 + i, discount=float(i % 3), seq=10 * i, start=i * 37)
    rows.append({**rows[3], "seq": 9})  # an end that comes again
    return bookings(spark, rows)


@pytest.fixture(scope="module")
def booking_job(spark, many_trips):
    job = jobs.BookingJob(spark, work_folder(spark, "job"))
    # slices cut through lives: state has to carry over
    finish(job.start(feed(spark, many_trips, ["seq % 10 < 1", "seq % 10 BETWEEN 1 AND 2", "seq % 10 > 2"]), NOW))
    return job


def test_booking_stream_equals_batch(spark, many_trips, booking_job):
    batch = buckets.roll_up(b.trigger_minutes(b.booking_triggers(many_trips))).select(*FACT)
    assert same(batch, jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT))


def test_replayed_batch_changes_nothing(spark, booking_job):
    before = jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT).collect()
    stored = spark.read.schema(b.TRIGGER).parquet(f"{booking_job.path}/triggers/batch_id=1")
    again = spark.createDataFrame(stored.collect(), stored.schema)
    booking_job.write_batch(again, 1)
    assert sorted(before) == sorted(jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT).collect())


def test_compaction_changes_nothing(spark, booking_job):
    before = jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT)
    rows = sorted(before.collect())
    booking_job.log.compact("bookings")
    booking_job.log.compact("bookings")
    assert sorted(jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT).collect()) == rows


def test_activity_follows_the_booking_job(spark, many_trips, booking_job):
    """A second query reads the activity table the first one wrote."""
    record_job = jobs.RecordJob(spark, work_folder(spark, "people"), "passengers")
    finish(record_job.start(jobs.live_passenger_records(booking_job.activity()), NOW))
    got = jobs.facts_of(record_job.log, ["passengers"]).filter("metric_name = 'active_passenger' AND bucket_granularity = 'MONTH'")
    batch = a.passenger_activity_records(b.trigger_activity(b.booking_triggers(many_trips)))
    assert float(got.first().metric_value) == batch.filter("metric_name = 'active_passenger'").count()


def test_routes_of_the_job(spark):
    rows = trip("r1")
    rows[0].update(pickup_lat=10.7, pickup_lon=106.6, dropoff_lat=10.9, dropoff_lon=106.9)
    job = jobs.BookingJob(spark, work_folder(spark, "job"))
    finish(job.start(feed(spark, bookings(spark, rows), ["true"]), NOW))
    assert [(r.sequence_no, float(r.latitude)) for r in job.routes().orderBy("sequence_no").collect()] == [(1, 10.7), (2, 10.9)]


def test_late_booking_adds_to_its_bucket(spark):
    """A booking ten minutes late joins the minute that was counted before."""
    rows = [{**trip("b1")[0], "seq": 0}, {**trip("b2", start=10)[0], "seq": 1}, {**trip("b3")[0], "seq": 2, "ingest_ts": after(10)}]
    job = jobs.BookingJob(spark, work_folder(spark, "late"))
    finish(job.start(feed(spark, bookings(spark, rows), ["seq = 0", "seq = 1", "seq = 2"]), NOW))
    facts = jobs.facts_of(job.log, ["bookings"]).filter("metric_name = 'request_order' AND bucket_granularity = 'MINUTE'")
    assert {r.bucket_start: float(r.metric_value) for r in facts.collect()} == {after(0): 2.0, after(10): 1.0}


DAY0 = t("2025-01-01T02:00:00")


def _dense(spark):
    """Busy and idle drivers; a steady one keeps the watermark moving."""
    rows, known, seq = [], [], 0
    for hour in range(0, 24 * 12, 6):
        at = DAY0 + dt.timedelta(hours=hour)
        plan = [("steady", "BUSY" if hour % 12 else "ONLINE")]
        if hour < 30 or hour > 150:
            plan.append(("breaks", "BUSY" if hour % 12 == 0 else "AVAILABLE"))
        if hour < 50:
            plan.append(("leaves", "BUSY"))
        for who, state in plan:
            seq += 1
            rows.append((who, state, at + dt.timedelta(seconds=seq % 7), seq))
        if hour % 48 == 0:
            seq += 1
            known.append(("breaks", f"S{hour % 5}", "", "Z", at, seq))
    return locations(spark, rows), profiles(spark, known)


def test_driver_stream_equals_batch(spark):
    places, known = _dense(spark)
    rows = jobs._driver_rows(places, known)
    cuts = [f"seq BETWEEN {n} AND {n + 9}" for n in range(0, 130, 10)]
    stream = feed(spark, rows, cuts)
    parts = stream.filter("is_location").withColumnRenamed("event_time", "updated_at"), stream.filter("NOT is_location").selectExpr(
        "*", "event_time AS created_at", "event_time AS updated_at"
    )
    path = work_folder(spark, "drivers")
    job, churn = jobs.RecordJob(spark, path, "drivers"), jobs.RecordJob(spark, path, "churn")
    finish(job.start(jobs.live_driver_records(*parts), NOW))
    finish(churn.start(jobs.live_driver_churn(*parts), NOW, event_time=True))
    pick = ["metric_name", "service_type", "area_code", "bucket_start", "metric_value", "denominator_value"]
    got = jobs.facts_of(job.log, ["drivers", "churn"]).filter("bucket_granularity = 'MINUTE'").select(*pick)
    batch = buckets.bucket_facts(d.driver_records(places, known), ("MINUTE",)).select(*pick)
    assert batch.filter("metric_name = 'churn_driver'").count() >= 2
    assert batch.filter("metric_name = 'return_driver'").count() == 1
    assert sorted(batch.collect()) == sorted(got.collect())


def test_passenger_stream_equals_batch(spark):
    places, _ = _dense(spark)
    trips = places.selectExpr("driver_id AS passenger_id", "CASE availability WHEN 'BUSY' THEN 'COMPLETED' ELSE 'REQUESTED' END AS type", "updated_at AS event_time", "seq", "ingest_ts")
    cuts = [f"seq BETWEEN {n} AND {n + 9}" for n in range(0, 130, 10)]
    path, stream = work_folder(spark, "people"), feed(spark, trips, cuts)
    job, churn = jobs.RecordJob(spark, path, "passengers"), jobs.RecordJob(spark, path, "churn")
    finish(job.start(jobs.live_passenger_records(stream), NOW))
    finish(churn.start(jobs.live_passenger_churn(stream), NOW, event_time=True))
    pick = ["metric_name", "bucket_start", "metric_value"]
    got = jobs.facts_of(job.log, ["passengers", "churn"]).filter("bucket_granularity = 'MINUTE'").select(*pick)
    end = trips.filter("type = 'COMPLETED'").agg({"event_time": "max"}).first()[0]
    batch = buckets.bucket_facts(a.passenger_activity_records(trips, end=F.lit(end)), ("MINUTE",)).select(*pick)
    assert batch.filter("metric_name = 'churn_passenger'").count() >= 2
    assert sorted(batch.collect()) == sorted(got.collect())


def test_trigger_shape_matches_batch(spark, many_trips):
    assert schema.BOOKING and set(b.booking_triggers(many_trips).columns) == {part.split()[0] for part in b.TRIGGER.split(", ")}


def test_location_job_tables(spark):
    places, known = _dense(spark)
    stream = feed(spark, jobs._driver_rows(places, known), ["seq < 40", "seq >= 40"])
    job = jobs.LocationJob(spark, work_folder(spark, "places"))
    finish(job.start(stream.filter("is_location").withColumnRenamed("event_time", "updated_at"), stream.filter("NOT is_location").selectExpr("*", "event_time AS created_at", "event_time AS updated_at"), NOW))
    batch = d.enrich_locations(places, known)
    assert same(marts.location_timeseries(batch), job.timeseries())
    assert same(marts.latest_documents(batch), job.latest_documents())
    assert job.daily_documents().count() == places.count()
    # the second batch again: the same rows in every table
    before = [sorted(t.collect()) for t in (job.timeseries(), job.latest_documents(), job.daily_documents())]
    job.write_batch(jobs._driver_rows(places, known).filter("seq >= 40"), 1)
    assert before == [sorted(t.collect()) for t in (job.timeseries(), job.latest_documents(), job.daily_documents())]


def test_profiles_come_from_earlier_batches(spark):
    places = locations(spark, [("d1", "ONLINE", after(n), n) for n in (1, 3, 5)] + [("d2", "ONLINE", after(9), 9)])
    known = profiles(spark, [("d1", "S", "", "Z1", after(0), 0), ("d1", "", "T", "", after(4), 4)])
    rows, job = jobs._driver_rows(places, known), jobs.LocationJob(spark, work_folder(spark, "places"))
    for n in range(10):
        job.write_batch(rows.filter(F.col("seq") == n), n)
    got = {(r.driver_id, r.seq): (r.service_type, r.service_tier, r.area_code) for r in job.positions().collect()}
    assert got == {("d1", 1): ("S", "", "Z1"), ("d1", 3): ("S", "", "Z1"), ("d1", 5): ("S", "T", "Z1"), ("d2", 9): ("", "", "")}


def test_registrations_count_once_over_batches(spark):
    rows = profiles(spark, [("d1", "S", "", "Z", after(n), n) for n in range(4)] + [("d2", "S", "", "Z", after(9), 9)])
    job = jobs.RegistrationJob(spark, work_folder(spark, "new"), "drivers", "driver_id", "new_driver", schema.DIMENSIONS)
    for n, condition in enumerate(["seq < 2", "seq = 2", "seq IN (3, 9)", "seq IN (3, 9)"]):
        # the last batch comes twice
        job.write_batch(rows.filter(condition), min(n, 2))
    got = jobs.facts_of(job.log, ["drivers"], ("MINUTE",)).select("bucket_start", F.col("metric_value").cast("int"))
    assert sorted(map(tuple, got.collect())) == [(after(0), 1), (after(9), 1)]


def test_log_keeps_few_folders_and_one_version(spark):
    """Forty small batches: the folders stay few, totals are whole at every step and while a base is swapped in."""
    log = marts.FactLog(spark, work_folder(spark, "log"), compact_every=5)
    minutes = buckets.minute_totals(b.trigger_records(b.booking_triggers(bookings(spark, trip("b1"))))).filter("metric_name = 'request_order'").persist()
    open_read, kept = None, []
    for n in range(40):
        log.write(minutes, "s", n)
        log.write(minutes, "s", n)  # a replay
        if n == 13:
            open_read = log.minutes("s")
        if n == 16:  # bases were swapped since; what was being read is still there
            assert int(open_read.agg(F.sum("metric_value")).first()[0]) == 14
        kept.append(sum(len(marts.Folder(spark, f"{log.path}/s").names(f)) for f in ("delta", "base", "manifest")))
    assert int(log.minutes("s").agg(F.sum("metric_value")).first()[0]) == 40
    assert max(kept) <= 2 * 5 + 2 + 2 + 1


def test_keyed_table_versions(spark):
    from waymeter.sources.versions import KeyedTable

    table = KeyedTable(spark, work_folder(spark, "keyed"), "k string, seq bigint", ["k"], buckets=4, keep=2)
    rows = [spark.createDataFrame([(f"k{i}", 10 * n + i) for i in range(6) if (i + n) % 3], "k string, seq bigint") for n in range(5)]
    for n, batch in enumerate(rows):
        table.merge(batch, n, marts.newer(["k", "seq"], ["k"]))
        table.merge(batch, n, lambda now, new: now.unionByName(new).groupBy("k").agg(F.max("seq").alias("seq")))
    want = {f"k{i}": max(10 * n + i for n in range(5) if (i + n) % 3) for i in range(6)}
    assert {r.k: r.seq for r in table.read().collect()} == want
    assert table.manifests.versions() == [3, 4]
    assert len(table.folder.names("data")) <= 2 * 4
    before = KeyedTable(spark, table.folder.path, "k string, seq bigint", ["k"], buckets=4).read(4)
    assert {r.k: r.seq for r in before.collect()} == {f"k{i}": max(10 * n + i for n in range(4) if (i + n) % 3) for i in range(6)}


def test_backfill_from_a_new_checkpoint(spark, many_trips, booking_job):
    """The whole history through a new job in one batch equals what the live job has."""
    job = jobs.BookingJob(spark, work_folder(spark, "backfill"))
    finish(job.start(feed(spark, many_trips, ["true"]), NOW))
    assert same(jobs.facts_of(job.log, ["bookings"]).select(*FACT), jobs.facts_of(booking_job.log, ["bookings"]).select(*FACT))


def test_a_position_behind_the_watermark_counts(spark):
    """Four positions in four micro-batches, one of them 70 minutes late."""
    rows = [("d1", "ONLINE", after(0), 1), ("d1", "ONLINE", after(100), 2), ("d1", "ONLINE", after(30), 3), ("d1", "ONLINE", after(101), 4)]
    places, known = locations(spark, rows), profiles(spark, [("d1", "S", "", "Z", after(0), 0)])
    stream = feed(spark, jobs._driver_rows(places, known), [f"seq = {n}" for n in range(5)])
    parts = stream.filter("is_location").withColumnRenamed("event_time", "updated_at"), stream.filter("NOT is_location").selectExpr(
        "*", "event_time AS created_at", "event_time AS updated_at"
    )
    job = jobs.RecordJob(spark, work_folder(spark, "drivers"), "drivers")
    finish(job.start(jobs.live_driver_records(*parts), NOW))
    total = jobs.facts_of(job.log, ["drivers"]).filter("metric_name = 'online_driver' AND bucket_granularity = 'DAY'").agg({"metric_value": "sum"}).first()[0]
    assert float(total) == d.driver_records(places, known).filter("metric_name = 'online_driver'").count() == 4


PLAIN = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for name in ("stream_booking_facts", "stream_locations", "stream_passenger_churn", "stream_registrations"):
    print("ROWS", name, e.queries()[name](spark, {data!r}).count())
"""


def test_streams_run_in_a_plain_session_elsewhere(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = PLAIN.format(root=root, data="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    rows = {line.split()[1]: int(line.split()[2]) for line in run.stdout.splitlines() if line.startswith("ROWS")}
    assert run.returncode == 0 and len(rows) == 4 and all(rows.values()), run.stderr[-2000:]


def test_a_stream_may_take_as_long_as_it_needs():
    """Ten minutes were an error before."""
    from waymeter import registry

    class Slow:
        stopped = False

        def awaitTermination(self, timeout=None):
            return None if timeout is None else False

        def stop(self):
            self.stopped = True

    slow = Slow()
    registry._finish(slow)
    assert slow.stopped


def test_open_lives_go_on_in_the_next_batch(spark):
    """Changes one by one against all at once: acceptance before creation is known, repeats, two lives, an idle one."""
    rows = trip("b1") + [
        {"booking_id": "b1", "status": "DRIVER_ACCEPTED", "updated_at": after(20), "seq": 4},
        {"booking_id": "b1", "op": "c", "status": "REQUESTED", "created_at": after(19), "updated_at": after(21), "seq": 5},
        {"booking_id": "b1", "op": "c", "status": "REQUESTED", "created_at": after(22), "updated_at": after(22), "seq": 6},
        {"booking_id": "b1", "status": "CANCELED", "updated_at": after(30), "seq": 7},
        {"booking_id": "b2", "op": "c", "status": "ACCEPTED", "created_at": after(1), "updated_at": after(1), "seq": 8},
    ]
    rows += [{"booking_id": "b2", "status": "STARTED", "updated_at": after(n), "seq": 9 + n} for n in range(3)]
    rows += [{"booking_id": "b2", "status": "COMPLETED", "platform_fee": 7.0, "updated_at": after(40), "seq": 12}]
    changes = bookings(spark, rows)
    job = jobs.BookingJob(spark, work_folder(spark, "one-by-one"))
    fired = []
    for n in [*range(8), 8, 9, 10, 10, 11, 12]:  # one of them twice
        fired = [*fired[:n], job.fire(changes.filter(F.col("seq") == n), n).collect()]
        if n == 11:
            assert [(r.booking_id, len(r.known)) for r in job.lives.read().collect()] == [("b2", 4)]
    names = b.booking_triggers(changes).columns
    shown = lambda r: tuple(str(r[c]) for c in names)
    assert sorted(shown(r) for batch in fired for r in batch) == sorted(map(shown, b.booking_triggers(changes).collect()))
    assert job.lives.read().count() == 0
    # a life that idles is forgotten
    job.fire(changes.filter("seq = 8"), 13, now=0)
    job.fire(changes.filter("seq = 12"), 14, now=31 * 86_400)
    assert [r.lead_seconds for r in spark.read.parquet(f"{job.path}/triggers/batch_id=14").collect()] == [None]


def test_passenger_days_in_batches_equal_all_at_once(spark):
    """Retained, churned and returned passengers over batches; one trip comes a day behind the others, the last batch twice."""
    plan = [("p1", 0), ("p3", 0), ("p1", 1440), ("p2", 1500), ("p2", 100), ("p1", 6 * 1440)]
    rows = []
    for i, (who, start) in enumerate(plan):
        rows += [{**row, "passenger_id": who} for row in trip(f"b{i}", seq=10 * i, start=start)]
    changes, job = bookings(spark, rows), jobs.PassengerDayJob(spark, work_folder(spark, "days"))
    # cuts within lives
    cuts = ["seq < 12", "seq BETWEEN 12 AND 32", "seq BETWEEN 33 AND 43", "seq > 43"]
    finish(job.start(feed(spark, changes, cuts), NOW))
    job.write_batch(changes.filter(cuts[-1]), 3)
    trips = b.trigger_activity(b.booking_triggers(changes))
    batch = a.passenger_activity_records(trips).groupBy("metric_name", timing.local_day(F.col("event_time")).alias("day")).agg(F.count(F.lit(1)).alias("records"))
    want = sorted(map(tuple, batch.collect()))
    assert {name for name, _, _ in want} == {f"{kind}_passenger" for kind in ("active", "retention", "churn", "return")}
    assert sorted(map(tuple, job.days().collect())) == want


def test_days_by_one_query_of_chained_operators(spark):
    rows = [{**row, "passenger_id": "p1"} for i, start in enumerate((0, 1440)) for row in trip(f"b{i}", seq=10 * i, start=start)]
    rows += [{"booking_id": "closing", "status": "", "created_at": after(n * 1440), "updated_at": after(n * 1440), "seq": n} for n in (40, 80)]
    found = []
    stream = feed(spark, bookings(spark, rows), ["seq < 40", "seq = 40", "seq = 80"])
    write = lambda batch, n: found.extend(r.metric_name for r in batch.collect())
    finish(jobs.start(jobs.live_passenger_days(stream, idle_days=36_500), write, work_folder(spark, "chain"), NOW, event_time=True))
    assert sorted(found) == ["active_passenger", "active_passenger", "churn_passenger", "retention_passenger"]


def test_feeds_keep_rows_once_and_come_slice_by_slice(spark, tmp_path):
    """Slices are made in one pass and moved into the feed; an empty one still gives a batch."""
    import glob
    import os

    from waymeter import registry

    shape = "seq bigint, name string"
    rows = spark.createDataFrame([(n, f"r{n}") for n in (0, 1, 2, 8, 9, None)], shape)
    last = spark.createDataFrame([(50, "more")], shape)
    seen = []
    for feed in registry._slices(spark, rows, "own-feed", 3, last):
        name = sorted(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/own-feed-*"), key=os.path.getmtime)[-1]
        seen.append(sorted(r.seq for r in spark.read.schema(shape).parquet(f"{name}/feed").collect()))
        assert feed.isStreaming and not os.path.exists(f"{name}/all")
        assert not glob.glob(f"{name}/slices/*={len(seen) - 1}/*.parquet")
    assert seen == [[0, 1, 2], [0, 1, 2], [0, 1, 2, 8, 9], [0, 1, 2, 8, 9, 50]]
    empty = list(registry._slices(spark, rows.limit(0), "empty-feed"))
    assert len(empty) == 3
    name = glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/empty-feed-*")[0]
    assert len(glob.glob(f"{name}/feed/*.parquet")) >= 3


def test_tables_of_a_job_are_packed_and_shuffles_go(spark, tmp_path):
    """What a booking job keeps is written with zstd, and a feed holds its rows once."""
    import glob

    from waymeter import registry

    rows = bookings(spark, [r for n in range(9) for r in trip(str(n), seq=10 * n, start=n)])
    job = jobs.BookingJob(spark, str(tmp_path / "job"))
    for feed in registry._slices(spark, rows, "packed-feed"):
        registry._finish(job.start(feed, NOW))
    files = glob.glob(f"{tmp_path}/job/**/*.parquet", recursive=True) + glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/packed-feed-*/**/*.parquet", recursive=True)
    assert files and all(file.endswith(".zstd.parquet") for file in files)
    whole = buckets.roll_up(b.trigger_minutes(b.booking_triggers(rows)), ("DAY",)).select(*FACT)
    assert sorted(map(str, jobs.facts_of(job.log, ["bookings"], ("DAY",)).select(*FACT).collect())) == sorted(map(str, whole.collect()))


def test_minutes_of_a_batch_take_one_shuffle(spark):
    """Placed by scope and minute, triggers are summed, unfolded and merged where they are; the totals stay the same."""
    rows = [r for n in range(30) for r in trip(f"b{n}", fee=10.0 + n, discount=float(n % 2), seq=10 * n, start=n % 7)]
    triggers = b.booking_triggers(bookings(spark, rows)).localCheckpoint()
    one = marts.merge_minutes(b.trigger_minutes(triggers, placed=True))
    two = marts.merge_minutes(b.trigger_minutes(triggers))
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(one) == 1 < shuffles(two)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
