"""Domain frames bound to the given star-schema and event tables.

Orders become booking changes, events become passenger and driver changes. Columns that
the tables lack come from key arithmetic, so every engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waymeter.functions import timing
from waymeter.functions.fields import to_snake

MONEY = "decimal(18,4)"
#: Bookings of one task, whose changes are sorted there. Sizes tell too little: a packed booking becomes up to four wide changes.
ORDERS_PER_TASK = 125_000


# Given schemas, so that making a plan reads no file footers.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _after(ts: Column, *, minutes: Column | None = None, seconds: Column | None = None) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes if minutes is not None else F.lit(0), seconds)


def order_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount and fee per order, in whole money units."""
    price, discount = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast("decimal(6,4)")
    whole = lambda c: F.round(c, 0).cast("bigint")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("booking_id"))
        .agg(
            whole(F.sum(price * discount)).alias("discount"),
            whole(F.sum(price) * F.expr("0.2BD")).alias("fee"),
        )
    )


def booking_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that bookings are dealt to: as many as there are orders for, so that none grows with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "orders").count() // ORDERS_PER_TASK))


def orders(spark: SparkSession, sf_dir: str, money: bool = True) -> DataFrame:
    """One row per booking with its dimensions, money (0 if not asked for) and life-cycle times."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    minute = lambda n, base: (k % n + base).cast("int")
    scoped = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            k.cast("string").alias("booking_id"),
            k.alias("k"),
            F.col("o_custkey").cast("string").alias("passenger_id"),
            F.col("o_orderstatus").alias("outcome"),
            F.col("o_orderpriority").alias("service_type"),
            F.col("c_mktsegment").alias("service_tier"),
            F.col("n_name").alias("area_code"),
            F.col("o_orderdate").alias("created_at"),
        )
    )
    # both sides are dealt by booking_id, so this join leaves rows placed for the booking scan
    tasks = booking_tasks(spark, sf_dir)
    scoped = scoped.repartition(tasks, "booking_id")
    free = scoped.withColumns({"fee": F.lit(0), "discount": F.lit(0)})
    priced = scoped.join(order_money(spark, sf_dir).repartition(tasks, "booking_id"), "booking_id", "left") if money else free
    k = F.col("k")
    return (
        priced.withColumn("accepted_at", _after(F.col("created_at"), minutes=minute(5, 1)))
        .withColumn("start_trip_at", _after(F.col("accepted_at"), minutes=minute(7, 1)))
        .withColumn("completed_at", _after(F.col("start_trip_at"), minutes=minute(26, 5)))
        .withColumn("canceled_at", _after(F.col("accepted_at"), minutes=minute(3, 1)))
        .withColumn("platform_fee", F.coalesce("fee", F.lit(0)).cast("double"))
        .withColumn("discount_amount", F.coalesce("discount", F.lit(0)).cast("double"))
        .withColumn("pickup_lat", (k % 300 + 10700) / F.lit(1000.0))
        .withColumn("pickup_lon", (k % 301 + 106600) / F.lit(1000.0))
        .withColumn("dropoff_lat", F.when(k % 11 != 0, (k % 299 + 10700) / F.lit(1000.0)))
        .withColumn("dropoff_lon", F.when(k % 11 != 0, (k % 298 + 106600) / F.lit(1000.0)))
        .drop("fee", "discount")
    )


def booking_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(booking_id, seq) of :func:`bookings`, from the orders table alone."""
    steps = F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "P", 3).otherwise(1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("booking_id"),
        F.explode(F.transform(F.sequence(F.lit(0), steps - 1), lambda i: F.col("o_orderkey") * 4 + i)).alias("seq"),
    )


def bookings(spark: SparkSession, sf_dir: str, money: bool = True) -> DataFrame:
    """Booking changes: one per life-cycle step of each order."""
    none = F.lit(None).cast("timestamp_ntz")

    def step(number: int, op: str, status: str, at: str, *known: str) -> Column:
        times = ["accepted_at", "start_trip_at", "completed_at"]
        return F.struct(
            (F.col("k") * 4 + number).alias("seq"),
            F.lit(op).alias("op"),
            F.lit(status).alias("status"),
            *[(F.col(t) if t in known else none).alias(t) for t in times],
            F.col(at).alias("updated_at"),
        )

    requested = step(0, "c", "REQUESTED", "created_at")
    accepted = step(1, "u", "DRIVER_ACCEPTED", "accepted_at", "accepted_at")
    started = step(2, "u", "STARTED", "start_trip_at", "accepted_at", "start_trip_at")
    completed = step(3, "u", "COMPLETED", "completed_at", "accepted_at", "start_trip_at", "completed_at")
    canceled = step(3, "u", "CANCELED", "canceled_at", "accepted_at")
    steps = (
        F.when(F.col("outcome") == "F", F.array(requested, accepted, started, completed))
        .when(F.col("outcome") == "P", F.array(requested, accepted, canceled))
        .otherwise(F.array(requested))
    )
    kept = [
        "booking_id", "passenger_id", "service_type", "service_tier", "area_code", "platform_fee",
        "discount_amount", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "created_at",
    ]
    late = (F.col("k") % 4 + 1).cast("int")
    return (
        orders(spark, sf_dir, money)
        .select("k", *kept, F.inline(steps))
        .withColumn("ingest_ts", _after(F.col("updated_at"), seconds=late))
        .drop("k")
    )


def _events(spark: SparkSession, sf_dir: str, kinds: list[str]) -> DataFrame:
    late = (F.col("event_id") % 4 + 1).cast("int")
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(kinds))
        .select(
            F.col("user_id").cast("string").alias("id"),
            "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.col("ts").alias("event_time"),
            F.col("event_id").alias("seq"),
            _after(F.col("ts"), seconds=late).alias("ingest_ts"),
        )
    )


def _named(column: str, names: dict[str, str]) -> Column:
    out = None
    for key, name in names.items():
        hit = F.col(column) == key
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ["signup", "view"]).select(
        F.col("id").alias("passenger_id"),
        _named("event_type", {"signup": "c", "view": "u"}).alias("op"),
        F.col("event_time").alias("created_at"),
        F.col("event_time").alias("updated_at"),
        "seq",
        "ingest_ts",
    )


def driver_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups as driver changes; every third value of k has no area."""
    return _events(spark, sf_dir, ["signup"]).select(
        F.col("id").alias("driver_id"),
        F.lit("c").alias("op"),
        F.when(F.col("k") % 2 == 0, "BIKE").otherwise("CAR").alias("service_type"),
        F.lit("").alias("service_tier"),
        F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("Z"), F.col("k") % 4)).alias("area_code"),
        F.col("event_time").alias("created_at"),
        F.col("event_time").alias("updated_at"),
        "seq",
        "ingest_ts",
    )


def driver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = {"purchase": "BUSY", "view": "AVAILABLE", "click": "ONLINE", "error": "UNAVAILABLE"}
    return _events(spark, sf_dir, list(states)).select(
        F.col("id").alias("driver_id"),
        F.lit("u").alias("op"),
        _named("event_type", states).alias("availability"),
        ((F.col("k") % 300 + 10700) / F.lit(1000.0)).alias("lat"),
        ((F.col("k") % 301 + 106600) / F.lit(1000.0)).alias("lon"),
        F.col("event_time").alias("updated_at"),
        "seq",
        "ingest_ts",
    )


def passenger_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"purchase": "COMPLETED", "view": "REQUESTED", "click": "ACCEPTED", "error": "CANCELED"}
    return _events(spark, sf_dir, list(kinds)).select(
        F.col("id").alias("passenger_id"),
        _named("event_type", kinds).alias("type"),
        "event_time",
        "seq",
        "ingest_ts",
    )


def _hex_of_double(value: Column, exponent: int) -> Column:
    """Big-endian hex digits of a double between 2**exponent and 2**(exponent + 1)."""
    mantissa = ((value / F.lit(2.0**exponent) - 1.0) * F.lit(2.0**52)).cast("bigint")
    return F.concat(F.lit(f"{1023 + exponent:03X}"), F.lpad(F.hex(mantissa), 13, "0"))


def wkb_of(lat: Column, lon: Column) -> Column:
    """A big-endian WKB point, for latitudes in [8, 16) and longitudes in [64, 128)."""
    return F.unhex(F.concat(F.lit("0000000001"), _hex_of_double(lon, 6), _hex_of_double(lat, 3)))


def _iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _envelope(df: DataFrame, op: Column, values: dict[str, Column], spelling: Column) -> DataFrame:
    """JSON envelopes whose field names are camel, snake or upper case, by row."""
    styles = [lambda n: n, to_snake, str.upper]
    after = [F.to_json(F.struct(*[v.alias(style(n)) for n, v in values.items()])) for style in styles]
    body = F.when(spelling == 0, after[0]).when(spelling == 1, after[1]).otherwise(after[2])
    head = F.concat(F.lit('{"op":"'), op, F.lit('","after":'))
    return df.select(F.concat(head, body, F.lit("}")).alias("value"), "seq", "ingest_ts")


def booking_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bookings as JSON change records, with points as WKB or as objects."""
    key = F.col("booking_id").cast("bigint")
    wkb = F.base64(wkb_of(F.col("pickup_lat"), F.col("pickup_lon")))
    plain = F.to_json(F.struct(F.col("dropoff_lat").alias("latitude"), F.col("dropoff_lon").alias("longitude")))
    values = {
        "id": F.col("booking_id"),
        "passengerId": F.col("passenger_id"),
        "status": F.col("status"),
        "serviceTypeCode": F.col("service_type"),
        "serviceTierCode": F.col("service_tier"),
        "wardCode": F.col("area_code"),
        "platformFee": F.col("platform_fee").cast("bigint").cast("string"),
        "discountAmount": F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("discount_amount").cast("bigint").cast("string")),
        "pickupLocation": F.struct(wkb.alias("wkb"), F.lit(4326).alias("srid")),
        "dropoffLocation": F.when(F.col("dropoff_lat").isNotNull(), plain),
        "createdAt": _iso("created_at"),
        "atPickUpAt": F.when(key % 2 == 0, _iso("accepted_at")),
        "acceptedAt": F.when(key % 2 == 1, _iso("accepted_at")),
        "startTripAt": _iso("start_trip_at"),
        "completedAt": _iso("completed_at"),
        "updatedAt": _iso("updated_at"),
    }
    return _envelope(bookings(spark, sf_dir), F.col("op"), values, key % 3)


def driver_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "id": F.col("driver_id"),
        "serviceCode": F.col("service_type"),
        "areaCode": F.col("area_code"),
        "createdAt": _iso("created_at"),
        "updatedAt": _iso("updated_at"),
    }
    return _envelope(driver_profiles(spark, sf_dir), F.when(F.col("seq") % 5 == 0, "r").otherwise("c"), values, F.col("seq") % 3)


def passenger_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"id": F.col("passenger_id"), "createdAt": _iso("created_at"), "updatedAt": _iso("updated_at")}
    return _envelope(passengers(spark, sf_dir), F.when(F.col("seq") % 5 == 0, "r").otherwise(F.col("op")), values, F.col("seq") % 3)


def location_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as JSON: plain numbers, base64 WKB, hex WKB, or nothing, by row."""
    wkb, turn = wkb_of(F.col("lat"), F.col("lon")), F.col("seq") % 4
    values = {
        "driverId": F.col("driver_id"),
        "availability": F.col("availability"),
        "latitude": F.when(turn == 0, F.col("lat")),
        "longitude": F.when(turn == 0, F.col("lon")),
        "coordinates": F.when(turn == 1, F.base64(wkb)).when(turn == 2, F.hex(wkb)),
        "updatedAt": _iso("updated_at"),
    }
    return _envelope(driver_locations(spark, sf_dir), F.lit("r"), values, F.lit(0))
