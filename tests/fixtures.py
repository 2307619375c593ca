"""Hand-made inputs, and exact record tallies of outputs."""

from __future__ import annotations

import base64
import datetime as dt
import json
import struct

from waymeter import schema


def t(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


NOON = t("2025-01-01T12:00:00")


def after(minutes: float) -> dt.datetime:
    return NOON + dt.timedelta(minutes=minutes)


def bookings(spark, rows: list[dict]):
    """Booking changes; each row names only what matters."""
    names = [part.strip().split()[0] for part in schema.BOOKING.split(",")]
    base = {"booking_id": "b1", "passenger_id": "p1", "op": "u", "service_type": "CAR", "service_tier": "ECONOMY", "area_code": "Q1", "platform_fee": 0.0, "discount_amount": 0.0}
    full = []
    for seq, row in enumerate(rows):
        merged = {**base, "seq": seq, **row}
        merged.setdefault("ingest_ts", merged.get("updated_at") or NOON)
        full.append(tuple(merged.get(n) for n in names))
    return spark.createDataFrame(full, schema.BOOKING)


def trip(booking_id: str = "b1", fee: float = 50_000.0, discount: float = 5_000.0, seq: int = 0, start: float = 0) -> list[dict]:
    """request, accept after 2 minutes, start after 5, complete after 15."""
    at = lambda m: after(start + m)
    common = {"booking_id": booking_id, "platform_fee": fee, "discount_amount": discount, "created_at": at(0)}
    return [
        {**common, "op": "c", "status": "REQUESTED", "updated_at": at(0), "seq": seq},
        {**common, "status": "DRIVER_ACCEPTED", "accepted_at": at(2), "updated_at": at(2), "seq": seq + 1},
        {**common, "status": "STARTED", "start_trip_at": at(5), "updated_at": at(5), "seq": seq + 2},
        {**common, "status": "COMPLETED", "completed_at": at(15), "updated_at": at(15), "seq": seq + 3},
    ]


def tally(records) -> dict[str, tuple[int, float, float]]:
    """metric -> (records, sum of value, sum of denominator)."""
    out: dict[str, tuple[int, float, float]] = {}
    for r in records.select("metric_name", "metric_value", "denominator_value").collect():
        n, v, d = out.get(r[0], (0, 0.0, 0.0))
        out[r[0]] = (n + 1, v + float(r[1]), d + float(r[2]))
    return out


def activity(spark, rows: list[tuple]):
    """(passenger, type, event_time) in arrival order."""
    return spark.createDataFrame(
        [(p, kind, at, i, at) for i, (p, kind, at) in enumerate(rows)],
        "passenger_id string, type string, event_time timestamp_ntz, seq bigint, ingest_ts timestamp_ntz",
    )


def locations(spark, rows: list[tuple]):
    """(driver, availability, updated_at, seq)."""
    return spark.createDataFrame(
        [(d, "u", a, 10.8, 106.7, at, seq, at) for d, a, at, seq in rows], schema.DRIVER_LOCATION
    )


def profiles(spark, rows: list[tuple]):
    """(driver, service, tier, area, at, seq)."""
    return spark.createDataFrame(
        [(d, "c", s, tier, area, at, at, seq, at) for d, s, tier, area, at, seq in rows], schema.DRIVER
    )


def wkb(lon: float, lat: float, srid: int | None = None, little: bool = True) -> bytes:
    order = "<" if little else ">"
    kind = struct.pack(order + "II", 0x20000001, srid) if srid else struct.pack(order + "I", 1)
    return struct.pack(order + "B", 1 if little else 0) + kind + struct.pack(order + "dd", lon, lat)


def b64(data: bytes) -> str:
    return base64.b64encode(data).decode()


def raw(spark, envelopes: list):
    """Change records from dicts or literal text."""
    rows = [(e if isinstance(e, str) else json.dumps(e), i, NOON) for i, e in enumerate(envelopes)]
    return spark.createDataFrame(rows, "value string, seq bigint, ingest_ts timestamp_ntz")
