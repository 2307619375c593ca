import datetime as dt

import pytest
from fixtures import activity, locations, profiles, t, tally
from pyspark.sql import functions as F

from waymeter.operators import activity as a, drivers as d

DAY0 = t("2025-01-01T02:00:00")


def day(n: float) -> dt.datetime:
    return DAY0 + dt.timedelta(days=n)


def test_retention_churn_and_return(spark):
    trips = activity(spark, [("p", "COMPLETED", day(n)) for n in (0, 1, 2, 6)])
    got = tally(a.passenger_activity_records(trips))
    assert got["active_passenger"][0] == 4
    assert got["retention_passenger"][0] == 2
    assert got["churn_passenger"][0] == 1
    assert got["return_passenger"][0] == 1


def test_churn_time_and_tail(spark):
    rows = [("p", "COMPLETED", day(0)), ("q", "COMPLETED", day(3.1))]
    churned = a.passenger_activity_records(activity(spark, rows)).filter("metric_name = 'churn_passenger'").collect()
    assert [r.event_time for r in churned] == [day(3)]
    rows[1] = ("q", "COMPLETED", day(3) + dt.timedelta(minutes=4))
    assert a.passenger_activity_records(activity(spark, rows)).filter("metric_name = 'churn_passenger'").count() == 0


def test_same_day_in_reporting_zone(spark):
    """16:00 UTC is midnight there: 15:59 and 16:00 are two days."""
    rows = [("p", "COMPLETED", t("2025-01-01T15:59:00")), ("p", "COMPLETED", t("2025-01-01T16:00:00")), ("p", "COMPLETED", t("2025-01-02T15:00:00"))]
    got = tally(a.passenger_activity_records(activity(spark, rows)))
    assert got["active_passenger"][0] == 2 and got["retention_passenger"][0] == 1


def test_earlier_day_arriving_late_counts_again(spark):
    rows = [("p", "COMPLETED", day(n)) for n in (1, 0, 1)]
    got = tally(a.passenger_activity_records(activity(spark, rows)))
    assert got["active_passenger"][0] == 3 and got["retention_passenger"][0] == 1


def test_only_completed_trips_count(spark):
    got = tally(a.passenger_activity_records(activity(spark, [("p", k, day(0)) for k in ("REQUESTED", "ACCEPTED", "CANCELED", "completed")])))
    assert got == {"active_passenger": (1, 1, 0)}


def test_registrations_first_create_only(spark):
    rows = profiles(spark, [("d", "BIKE", "", "Q1", day(0), 5), ("d", "CAR", "", "Q3", day(1), 6), ("e", "CAR", None, None, day(2), 7)])
    rows = rows.withColumn("op", F.when(F.col("seq") == 5, "u").otherwise("C"))
    got = {(r.service_type, r.area_code, r.event_time) for r in a.driver_registrations(rows).collect()}
    assert got == {("CAR", "Q3", day(1)), ("CAR", "", day(2))}


def test_status_flips_within_a_minute(spark):
    rows = [("d", s, DAY0 + dt.timedelta(seconds=i), i) for i, s in enumerate(["AVAILABLE", "BUSY", "AVAILABLE"])]
    got = tally(d.driver_records(locations(spark, rows)))
    assert got["online_driver"][0] == 3 and got["busy_driver"][0] == 1
    assert got["active_driver"][0] == 1 and got["productivity"] == (1, 0, 1)


def test_unchanged_status_in_one_minute_counts_once(spark):
    rows = [("d", "ONLINE", DAY0 + dt.timedelta(seconds=i), i) for i in range(3)]
    assert tally(d.driver_records(locations(spark, rows)))["online_driver"][0] == 1


def test_location_before_its_profile_is_blank(spark):
    places = locations(spark, [("d", "ONLINE", day(0), 1), ("d", "ONLINE", day(1), 3), ("x", "ONLINE", day(0), 4)])
    known = profiles(spark, [("d", "BIKE", "", "Q1", day(0.5), 2), ("d", "", "PREMIUM", None, day(0.6), 5)])
    got = {(r.driver_id, r.seq): (r.service_type, r.service_tier, r.area_code) for r in d.enrich_locations(places, known).collect()}
    assert got == {("d", 1): ("", "", ""), ("d", 3): ("BIKE", "", "Q1"), ("x", 4): ("", "", "")}


def test_profile_fields_keep_their_last_non_empty_value(spark):
    places = locations(spark, [("d", "ONLINE", day(1), 9)])
    known = profiles(spark, [("d", "BIKE", "PREMIUM", "Q1", day(0), 1), ("d", "CAR", "", None, day(0), 2)])
    row = d.enrich_locations(places, known).first()
    assert (row.service_type, row.service_tier, row.area_code) == ("CAR", "PREMIUM", "Q1")


def test_churn_has_the_scope_of_its_time(spark):
    """The profile changes a day after the last trip, then again after the timer."""
    places = locations(spark, [("d", "BUSY", day(0), 1), ("d", "ONLINE", day(1.5), 3), ("d", "ONLINE", day(4), 5), ("d", "BUSY", day(5), 6)])
    known = profiles(spark, [("d", "A", "", "", day(0), 0), ("d", "B", "", "", day(1), 2), ("d", "C", "", "", day(3.5), 4)])
    churned = d.driver_records(places, known).filter("metric_name = 'churn_driver'").collect()
    assert [(r.service_type, r.event_time) for r in churned] == [("B", day(3))]


def _crowd(spark):
    """One driver with most rows among many others, with profile changes."""
    states = ["AVAILABLE", "BUSY", "ONLINE", "UNAVAILABLE", "BUSY"]
    rows, known, seq = [], [], 0
    for i in range(600):
        who = "hot" if i % 3 else f"d{i % 40}"
        at = DAY0 + dt.timedelta(hours=i * 1.3 + (90 if i > 400 else 0))
        rows.append((who, states[i * 7 % 5] if i % 90 > 20 else "ONLINE", at, seq))
        seq += 1
        if i % 17 == 0:
            known.append((who, f"S{i % 4}", "", f"A{i % 3}", at, seq))
            seq += 1
    return locations(spark, rows), profiles(spark, known)


def test_heavy_driver_in_chunks_gives_the_same(spark):
    places, known = _crowd(spark)
    for build in (lambda **k: d.driver_records(places, known, **k), lambda **k: d.enrich_locations(places, known, **k)):
        plain, chunked = build(), build(rows_per_task=15)
        assert "_chunk" in chunked._jdf.queryExecution().toString()
        assert plain.exceptAll(chunked).count() == chunked.exceptAll(plain).count() == 0


def test_heavy_passenger_in_chunks_gives_the_same(spark):
    rows = [("hot" if i % 3 else f"p{i % 30}", "COMPLETED", DAY0 + dt.timedelta(hours=i * 2 + (200 if i > 300 else 0))) for i in range(500)]
    trips = activity(spark, rows)
    plain, chunked = a.passenger_activity_records(trips), a.passenger_activity_records(trips, rows_per_task=15)
    assert plain.exceptAll(chunked).count() == chunked.exceptAll(plain).count() == 0


def test_enriching_first_gives_the_same_kpis(spark):
    places, known = _crowd(spark)
    at_once = d.driver_records(places, known).drop("seq")
    in_steps = d.driver_records(d.enrich_locations(places, known)).drop("seq")
    assert at_once.exceptAll(in_steps).count() == in_steps.exceptAll(at_once).count() == 0


def test_order_must_be_an_integer_at_any_size(spark):
    from waymeter.operators.keyed import per_key

    rows = spark.createDataFrame([("p", 1.5)], "k string, at double")
    with pytest.raises(ValueError):
        per_key(rows, "k", "at", lambda df, chunk: df)


def test_chunks_are_even_in_bursts(spark):
    """Half of a heavy key's rows in a burst far from the others."""
    from waymeter.operators.keyed import CHUNK, carry, per_key

    rows = spark.range(4000).selectExpr("CASE WHEN id < 3000 THEN 'hot' ELSE concat('k', id) END AS k", "CASE WHEN id < 1500 THEN id ELSE id + 10000000 END AS at")
    sizes = {}

    def body(df, chunk):
        if chunk:
            sizes.update({r[0]: r[1] for r in df.groupBy(CHUNK).count().collect()})
        return carry(df, "k", "at", chunk, total_before={"earlier": F.lit(1)})

    done = per_key(rows, "k", "at", body, rows_per_task=500)
    assert len(sizes) >= 5 and max(sizes.values()) <= 900
    assert sorted(r.earlier for r in done.filter("k = 'hot'").collect()) == list(range(3000))
