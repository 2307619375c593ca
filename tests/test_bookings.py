import datetime as dt

import pytest
from fixtures import NOON, after, bookings, tally, trip
from pyspark.sql import functions as F

from waymeter.operators import bookings as b, buckets


def records(spark, rows, **kw):
    return tally(b.booking_records(bookings(spark, rows), **kw))


def test_full_trip(spark):
    got = records(spark, trip())
    assert got["request_order"] == (1, 1, 0)
    assert got["acceptance_rate"] == (2, 1, 1)
    assert got["completed_rate"] == (2, 1, 1)
    assert got["cancel_rate"] == (1, 0, 1)
    assert got["gsv"] == (1, 55_000, 0)
    assert got["revenue_vat"] == (1, 50_000, 0)
    assert got["revenue_net"][1] == pytest.approx(45_454.545455, abs=1e-6)
    assert got["net_driver_income"] == (1, 5_000, 0)
    assert got["discount_order"] == (1, 5_000, 0)
    assert got["productivity"] == (1, 1, 0)
    assert got["accept_time_total"] == (1, 120, 1)
    assert got["accept_time"] == got["order_time"] == got["order_time_total"] == (1, 120, 1)
    assert got["board_time"] == (1, 600, 1)
    assert got["lead_time"] == (1, 900, 1)


def test_cancel_and_no_discount(spark):
    rows = trip("b1", discount=0.0) + [
        {"booking_id": "b2", "op": "c", "status": "REQUESTED", "created_at": NOON, "updated_at": NOON, "seq": 10},
        {"booking_id": "b2", "status": "CANCELED", "updated_at": after(1), "seq": 11},
    ]
    got = records(spark, rows)
    assert "discount_order" not in got
    assert got["cancel_order"] == (1, 1, 0)
    assert got["cancel_rate"] == (3, 1, 2)


def test_end_that_comes_again_counts_again_unless_deduplicated(spark):
    rows = trip()
    rows.append({**rows[-1], "seq": 9})
    assert records(spark, rows)["completed_order"] == (2, 2, 0)
    assert records(spark, rows)["lead_time"] == (2, 1800, 2)
    assert "board_time" in records(spark, rows) and records(spark, rows)["board_time"][0] == 1
    assert records(spark, rows, dedupe_terminal=True)["completed_order"] == (1, 1, 0)


def test_second_create_in_one_life_is_ignored(spark):
    rows = trip()
    rows.insert(1, {**rows[0]})
    for seq, row in enumerate(rows):
        row["seq"] = seq
    assert records(spark, rows)["request_order"] == (1, 1, 0)


def test_accept_before_create_gives_no_duration(spark):
    rows = trip()[:2]
    rows[1]["accepted_at"] = after(-3)
    got = records(spark, rows)
    assert got["accept_order"] == (1, 1, 0)
    assert "accept_time" not in got and "order_time_total" not in got


def test_late_creation_time_moves_order_time_to_completion(spark):
    """Without a creation time at accept, completion reports it, less accept_time_total."""
    rows = [
        {"status": "ACCEPTED", "accepted_at": after(2), "updated_at": after(2), "seq": 0},
        {"status": "COMPLETED", "created_at": NOON, "completed_at": after(9), "updated_at": after(9), "seq": 1},
    ]
    got = records(spark, rows)
    assert got["order_time"] == got["accept_time"] == got["order_time_total"] == (1, 120, 1)
    assert "accept_time_total" not in got
    assert got["lead_time"] == (1, 540, 1)


def test_one_row_may_fire_several_events(spark):
    row = {"op": "c", "status": "ACCEPTED_STARTED_COMPLETED_CANCELED", "created_at": NOON, "accepted_at": after(1), "start_trip_at": after(2), "completed_at": after(4), "updated_at": after(5)}
    got = records(spark, [row])
    for name in ("request_order", "accept_order", "completed_order", "cancel_order"):
        assert got[name] == (1, 1, 0)
    assert got["board_time"] == (1, 120, 1)


def test_missing_times_fall_back_to_update_then_arrival(spark):
    rows = [{"op": "c", "status": "REQUESTED", "ingest_ts": after(7)}, {"status": "CANCELED", "updated_at": after(9)}]
    got = {(r.kind, r.event_time) for r in b.booking_triggers(bookings(spark, rows)).collect()}
    assert got == {("REQUESTED", after(7)), ("CANCELED", after(9))}


def test_activity_and_routes(spark):
    rows = trip()
    rows[0].update(pickup_lat=10.7, pickup_lon=106.6, dropoff_lat=10.8)
    rows += [{**trip("b2", seq=20)[0], "passenger_id": None}]
    triggers = b.booking_triggers(bookings(spark, rows))
    kinds = [(r.passenger_id, r.type) for r in b.trigger_activity(triggers).orderBy("seq").collect()]
    assert kinds == [("p1", "REQUESTED"), ("p1", "ACCEPTED"), ("p1", "COMPLETED")]
    stops = b.trigger_routes(triggers).collect()
    assert [(s.booking_id, s.sequence_no, float(s.latitude), float(s.longitude)) for s in stops] == [("b1", 1, 10.7, 106.6)]


def _spread(spark, n=40):
    rows = []
    for i in range(n):
        rows += trip(f"b{i}", fee=1000.0 + i, discount=float(i % 3), seq=10 * i, start=i * 7)
    return rows


def test_row_order_does_not_matter(spark):
    rows = _spread(spark)
    one = b.booking_records(bookings(spark, rows))
    other = b.booking_records(bookings(spark, rows[::-1]).repartition(5))
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_heavy_booking_in_chunks_gives_the_same(spark):
    """One booking with most of the rows, cut in chunks, against the plain plan."""
    rows = _spread(spark, 10)
    for i in range(120):
        rows += trip("hot", fee=500.0 + i, discount=float(i % 4), seq=1000 + 10 * i, start=i)
    df = bookings(spark, rows)
    plain, chunked = b.booking_triggers(df), b.booking_triggers(df, rows_per_task=20)
    assert "_chunk" in chunked._jdf.queryExecution().toString()
    assert plain.exceptAll(chunked).count() == chunked.exceptAll(plain).count() == 0
    assert plain.filter("booking_id = 'hot'").count() == 360


def test_minute_totals_agree_with_records(spark):
    triggers = b.booking_triggers(bookings(spark, _spread(spark)))
    records_way = buckets.bucket_facts(b.trigger_records(triggers))
    wide_way = buckets.roll_up(b.trigger_minutes(triggers))
    assert records_way.exceptAll(wide_way).count() == wide_way.exceptAll(records_way).count() == 0


@pytest.mark.parametrize("granularity", ["MINUTE", "HOUR", "DAY", "WEEK", "MONTH"])
def test_rolling_up_minutes_equals_direct_buckets(spark, granularity):
    from pyspark.sql import functions as F

    found = b.booking_records(bookings(spark, _spread(spark)))
    facts = buckets.bucket_facts(found, (granularity,))
    direct = buckets.expand_granularities(found, granularities=(granularity,)).groupBy("metric_name", "bucket_start").agg(
        F.sum("metric_value").cast("decimal(20,6)").alias("v")
    )
    rolled = facts.groupBy("metric_name", "bucket_start").agg(F.sum("metric_value").cast("decimal(20,6)").alias("v"))
    assert direct.exceptAll(rolled).count() == rolled.exceptAll(direct).count() == 0


def test_lag_is_never_negative(spark):
    row = {**trip()[0], "ingest_ts": NOON - dt.timedelta(hours=1)}
    facts = buckets.bucket_facts(b.booking_records(bookings(spark, [row])), ("MINUTE",))
    assert {r.processing_lag_ms for r in facts.collect()} == {0}


def test_bookings_of_a_task_stay_bounded(spark, monkeypatch):
    """More orders make more tasks, beyond the number of shuffle partitions (8 here)."""
    from waymeter.sources import testbed as bed

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(bed, "ORDERS_PER_TASK", 50, raising=False)
    rows = bed.bookings(spark, sf)
    held = rows.select(F.spark_partition_id().alias("task"), "booking_id").distinct().groupBy("task").count()
    most, tasks = held.agg(F.max("count"), F.count(F.lit(1))).first()
    assert tasks > 16 and most < 150
    assert rows.select("booking_id").distinct().count() == bed.table(spark, sf, "orders").count()
