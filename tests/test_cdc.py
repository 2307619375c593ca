import pytest
from fixtures import NOON, b64, raw, t, wkb
from pyspark.sql import functions as F

from waymeter.functions import fields, points, timing
from waymeter.sources import cdc

BOOKING = {
    "id": "b1", "passengerId": "p1", "status": "REQUESTED", "serviceTypeCode": "CAR", "serviceTierCode": "ECONOMY",
    "wardCode": "Q1", "platformFee": 50000, "discountAmount": "5000.50",
    "pickupLocation": {"wkb": b64(wkb(106.61, 10.71, 4326)), "srid": 4326},
    "createdAt": "2025-01-01T00:00:00Z", "updatedAt": "2025-01-01T00:00:00.5Z",
}


def test_booking_projection(spark):
    row = cdc.bookings(raw(spark, [{"op": "c", "after": BOOKING}])).first()
    assert (row.booking_id, row.passenger_id, row.op, row.area_code) == ("b1", "p1", "c", "Q1")
    assert (row.platform_fee, row.discount_amount) == (50000.0, 5000.5)
    assert (row.pickup_lat, row.pickup_lon, row.dropoff_lat) == (10.71, 106.61, None)
    assert row.created_at == t("2025-01-01T00:00:00") and row.updated_at == t("2025-01-01T00:00:00.500")
    assert row.accepted_at is None


def test_accepted_is_the_first_given_time(spark):
    times = [("atPickUpAt", "2025-01-01T00:03:00Z"), ("driverAcceptedAt", "2025-01-01T00:02:00Z"), ("acceptedAt", "2025-01-01T00:01:00Z")]
    rows = [{"op": "u", "after": {**BOOKING, **dict(times[: n + 1])}} for n in range(3)]
    got = [r.accepted_at.minute for r in cdc.bookings(raw(spark, rows)).orderBy("seq").collect()]
    assert got == [3, 2, 1]
    empty = {"op": "u", "after": {**BOOKING, "acceptedAt": "", "driverAcceptedAt": "2025-01-01T00:02:00Z"}}
    assert cdc.bookings(raw(spark, [empty])).first().accepted_at.minute == 2


def test_deletes_snapshots_and_broken_records_drop_out(spark):
    rows = [
        {"op": "d", "after": None},
        {"op": "r", "after": BOOKING},
        {"op": "c", "after": {**BOOKING, "id": ""}},
        {"op": "c", "after": {**BOOKING, "id": None}},
        "not json",
        {"after": {**BOOKING, "id": "b9"}},
    ]
    got = cdc.bookings(raw(spark, rows)).collect()
    assert [(r.booking_id, r.op) for r in got] == [("b9", "u")]
    assert cdc.malformed(raw(spark, rows)).count() == 1


def test_spellings_and_explicit_null(spark):
    rows = [
        {"op": "c", "after": {"ID": "b1", "ward_code": "Q3"}},
        {"op": "c", "after": {"id": "b2", "WARD_CODE": "Q7"}},
        {"op": "c", "after": {"id": "b3", "wardcode": "BT", "ward_code": "XX"}},
        {"op": "c", "after": {"id": "b4", "wardCode": None, "ward_code": "XX"}},
    ]
    got = [(r.booking_id, r.area_code) for r in cdc.bookings(raw(spark, rows)).orderBy("seq").collect()]
    assert got == [("b1", "Q3"), ("b2", "Q7"), ("b3", "BT"), ("b4", None)]


@pytest.mark.parametrize("value, number", [(1500, 1500.0), ("12.5", 12.5), ("1e3", 1000.0), ("bad", 0.0), ("", 0.0), (None, 0.0), (" 7", 0.0), ("NaN", 0.0), ({"a": 1}, 0.0), (True, 0.0)])
def test_numbers(spark, value, number):
    row = cdc.bookings(raw(spark, [{"op": "c", "after": {**BOOKING, "platformFee": value}}])).first()
    assert row.platform_fee == number


POINT = (106.612345, 10.712345)


@pytest.mark.parametrize(
    "text, point",
    [
        (b64(wkb(*POINT)), POINT),
        (b64(wkb(*POINT, 4326)), POINT),
        (wkb(*POINT, 4326, little=False).hex(), POINT),
        (wkb(*POINT).hex().upper(), POINT),
        ('{"wkb": "%s", "srid": 4326}' % b64(wkb(-0.0, 1e-310, 4326)), (-0.0, 1e-310)),
        ('{"latitude": 1.5, "longitude": "2.5"}', (2.5, 1.5)),
        ('{"latitude": 1.5}', None),
        ("garbage!", None),
        ("SRID=4326;POINT(106.6 10.7)", None),
        (b64(wkb(float("nan"), float("nan"))), None),
        (b64(wkb(*POINT)[:-1]), None),
        (b64(b"\x01\x02\x00\x00\x00" + wkb(*POINT)[5:]), None),
        ("", None),
        (None, None),
    ],
)
def test_points(spark, text, point):
    row = points.decode_points(spark.createDataFrame([(text,)], "x string"), {"p": F.col("x")}).first()
    assert (row.p_lon, row.p_lat) == (point or (None, None))


def test_driver_locations(spark):
    packed = b64(wkb(106.7, 10.8))
    rows = [
        {"op": "r", "after": {"driverId": "d1", "availability": "BUSY", "latitude": "10.5", "longitude": 106.5, "updatedAt": "2025-01-01T00:00:00Z"}},
        {"op": "u", "after": {"driver_id": "d2", "availability": "BUSY", "coordinates": {"wkb": packed}}},
        {"op": "u", "after": {"driver_id": "d3", "coordinates": "zz"}},
        {"op": "u", "after": {"driver_id": "d4"}},
        {"op": "u", "after": {"driver_id": "", "latitude": 1, "longitude": 2}},
    ]
    got = {r.driver_id: (r.lat, r.lon, r.updated_at) for r in cdc.driver_locations(raw(spark, rows)).collect()}
    assert got == {"d1": (10.5, 106.5, t("2025-01-01T00:00:00")), "d2": (10.8, 106.7, NOON)}


def test_passengers_and_drivers(spark):
    p = cdc.passengers(raw(spark, [{"op": "c", "after": {"id": "p1", "createdAt": "2025-01-01T00:00:00Z"}}])).first()
    assert (p.passenger_id, p.op, p.created_at, p.updated_at) == ("p1", "c", t("2025-01-01T00:00:00"), None)
    d = cdc.drivers(raw(spark, [{"op": "c", "after": {"id": "d1", "serviceCode": "BIKE", "areaCode": "Q1"}}])).first()
    assert (d.driver_id, d.service_type, d.service_tier, d.area_code) == ("d1", "BIKE", None, "Q1")


def test_event_time_falls_back(spark):
    rows = [
        {"op": "c", "after": {"updatedAt": "2025-01-02T00:00:00Z", "createdAt": "2025-01-01T00:00:00Z"}},
        {"op": "c", "after": {"updatedAt": "x", "created_at": "2025-01-01T00:00:00Z"}},
        {"op": "c", "after": {}},
    ]
    got = [r.event_ts for r in cdc.event_time(raw(spark, rows)).orderBy("seq").collect()]
    assert got == [t("2025-01-02T00:00:00"), t("2025-01-01T00:00:00"), NOON]


@pytest.mark.parametrize(
    "mode, default, options",
    [
        ("earliest", "LATEST", {"startingOffsets": "earliest"}),
        (" LATEST ", "EARLIEST", {"startingOffsets": "latest"}),
        ("timestamp:1700000000000", "LATEST", {"startingTimestamp": "1700000000000"}),
        ("TIMESTAMP:x", "LATEST", {"startingOffsets": "latest"}),
        ("whenever", "EARLIEST", {"startingOffsets": "earliest"}),
        (None, "EARLIEST", {"startingOffsets": "earliest"}),
        ("", "LATEST", {"startingOffsets": "latest"}),
    ],
)
def test_start_offsets(mode, default, options):
    assert cdc.start_offset(mode, default) == options


@pytest.mark.parametrize("name, snake, camel", [("wardCode", "ward_code", "wardcode"), ("service-Type", "service_type", "service-type"), ("at_pick_UP", "at_pick_up", "atPickUp")])
def test_names(spark, name, snake, camel):
    assert (fields.to_snake(name), fields.to_camel(name)) == (snake, camel)
    row = spark.createDataFrame([(name,)], "x string").select(fields.snake(F.col("x")), fields.camel(F.col("x"))).first()
    assert tuple(row) == (snake, camel)


def test_buckets_at_zone_edges(spark):
    """Midnight in the reporting zone, a Monday edge and a month edge."""
    times = ["2024-12-31T15:59:59", "2024-12-31T16:00:00", "2025-01-05T15:59:00", "2025-01-05T16:00:00"]
    df = spark.createDataFrame([(t(x),) for x in times], "ts timestamp_ntz")
    got = [tuple(r) for r in df.orderBy("ts").select(*[timing.truncate_to(F.col("ts"), g) for g in ("DAY", "WEEK", "MONTH")]).collect()]
    assert got == [
        (t("2024-12-30T16:00"), t("2024-12-29T16:00"), t("2024-11-30T16:00")),
        (t("2024-12-31T16:00"), t("2024-12-29T16:00"), t("2024-12-31T16:00")),
        (t("2025-01-04T16:00"), t("2024-12-29T16:00"), t("2024-12-31T16:00")),
        (t("2025-01-05T16:00"), t("2025-01-05T16:00"), t("2024-12-31T16:00")),
    ]


def test_bucket_ends(spark):
    df = spark.createDataFrame([(t("2025-01-31T16:00"),)], "ts timestamp_ntz")
    got = df.select(*[timing.bucket_end(F.col("ts"), g) for g in timing.GRANULARITIES]).first()
    assert tuple(got) == (t("2025-01-31T16:01"), t("2025-01-31T17:00"), t("2025-02-01T16:00"), t("2025-02-07T16:00"), t("2025-02-28T16:00"))


@pytest.mark.parametrize("text", ["", "2025-01-01", "2025-01-01T00:00:00", "2025-13-01T00:00:00Z", "x", None])
def test_bad_instants(spark, text):
    assert spark.createDataFrame([(text,)], "x string").select(timing.parse_instant(F.col("x"))).first()[0] is None


def test_arrival_order_over_topics(spark):
    """Offsets of two topics clash; the time of arrival decides, then offset and topic."""
    rows = [("driver", "2025-01-01 00:00:00.001", 900), ("driver_location", "2025-01-01 00:00:00.002", 3), ("driver", "2025-01-01 00:00:00.003", 901), ("driver_location", "2025-01-01 00:00:00.003", 901)]
    df = spark.createDataFrame(rows, "entity string, at string, offset bigint").withColumn("at", F.to_timestamp("at"))
    by = {e: cdc.arrival_order(F.col("at"), F.col("offset"), e) for e in ("driver", "driver_location")}
    seqs = [r.seq for r in df.withColumn("seq", F.when(F.col("entity") == "driver", by["driver"]).otherwise(by["driver_location"])).collect()]
    assert seqs == sorted(seqs) and len(set(seqs)) == 4 and seqs[-1] < 2**63


def test_stored_changes_are_packed_in_files_of_bounded_size(spark, monkeypatch):
    from waymeter import registry

    monkeypatch.setattr(registry, "CHANGES_PER_FILE", 1_000)
    registry.forget_plans()
    stored = registry.stored_changes(spark, "/root/testdata/sf0.001", "booking")
    registry.forget_plans()
    files = stored.inputFiles()
    assert all(name.endswith(".json.gz") for name in files) and len(files) >= stored.count() / 1_000
