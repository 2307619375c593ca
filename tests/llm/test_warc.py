"""Archives: round trips, magic lines inside payloads, revisits."""

import base64
import hashlib

import pytest

from waymeter.llm import warc

FALSE_RECORD = "x WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n tail é\r\n\r\n"
ROWS = [
    (1, "http://a", FALSE_RECORD), (2, "http://b\r\nX: y", None), (3, None, ""), (4, "u", "same"), (5, "u", "same"), (6, "u", "WARC/1.0\r\n"),
    (None, "n", "other"), (7, "u", "WARC/1.0\r\nContent-Length: 10\r\n\r\n" + "y" * 50_000), (8, "u", FALSE_RECORD), (8, "u", FALSE_RECORD),
]


@pytest.mark.parametrize("with_payload", [True, False])
def test_round_trip(spark, with_payload):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(1)
    rows = warc.round_trip(pages, with_payload=with_payload).collect()
    assert sorted((r.page_id or 0) for r in rows) == sorted((r[0] or 0) for r in ROWS)
    html = {i: (h or "").encode() for i, _, h in ROWS}
    for r in rows:
        assert r.payload_bytes == len(html[r.page_id])
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html[r.page_id]).digest()).decode()
        if with_payload and r.record_type == "response":
            assert bytes(r.payload) == html[r.page_id]
    assert {(r.page_id, r.refers_to) for r in rows if r.record_type == "revisit"} == {(3, 2), (5, 4), (8, 1)}


def test_small_splits_give_the_same_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", FALSE_RECORD * (i % 7) + str(i)) for i in range(200)], "page_id bigint, url string, html string").coalesce(2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = warc.round_trip(pages).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.page_id, bytes(r.payload).decode()) for r in rows} == {(i, FALSE_RECORD * (i % 7) + str(i)) for i in range(200)}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
