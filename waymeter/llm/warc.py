"""WARC archives: written in parallel, read back in splits with verified record boundaries.

Archives are plain WARC 1.0 files made by Spark's text writer, so any store that Spark
reaches will do. Reading splits the files at the magic line wherever it stands, also
inside a payload. Each piece with a readable header is a candidate record and says where
its successor would begin. Following those offsets from the start of a file, by pointer
jumping, keeps exactly the true records; false ones are payload of the record around them.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from waymeter.llm.common import stored
from waymeter.session import work_folder

MAGIC = "WARC/1.0\r\n"
CREATED = "2024-01-01T00:00:00Z"

DIGEST = T.StructType([T.StructField("sha1", T.StringType()), T.StructField("key", T.BinaryType())])


@F.arrow_udf(DIGEST)
def payload_digests(column: pa.Array) -> pa.Array:
    """Base32 SHA-1 of a payload as archives name it, and SHA-256, by which payloads are compared."""
    payloads = [x.as_buffer() or b"" for x in column]
    sha1 = [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in payloads]
    keys = [hashlib.sha256(x).digest() for x in payloads]
    return pa.StructArray.from_arrays([pa.array(sha1), pa.array(keys, pa.binary())], ["sha1", "key"])


def plan_records(pages: DataFrame, payload: Column, page_id: str, url: str, least_bytes: int = 0) -> DataFrame:
    """One row per page: id, url, payload (binary), digest, record type and what a revisit refers to.

    The first page (smallest id) with a payload of at least ``least_bytes`` is a response and
    equal ones revisit it; smaller payloads are all responses. A null payload is empty, a null id
    the smallest; pages that share the id of the first one are responses too.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload")
    ).withColumn("d", payload_digests("payload"))
    rows = rows.select("page_id", "url", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "d.sha1", "d.key")
    # summed in each task, so a payload that very many pages share costs one row per task
    first = rows.groupBy("key").agg(F.min(F.struct("page_id")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = stored(first.select(F.col("key").alias("of"), F.col("first.page_id").alias("first_id")), "first")
    joined = rows.join(first, F.col("key") == F.col("of"), "left")
    revisit = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("payload_bytes") >= least_bytes)
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record_bytes(records: DataFrame) -> Column:
    """A record up to the carriage return before its last line feed, which the text writer adds."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(CREATED)),
        # a URL cannot bring line ends into the header
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("refers_to")))).otherwise(""),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(header.cast("binary"), body, F.lit(b"\r\n\r"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write records as WARC files; ``path`` is any folder Spark can write to.

    The text writer writes the bytes of a value and a line feed, which is the end of a record.
    """
    records.select(record_bytes(records).cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magic lines, with their archive, the split that read them and their order in it."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece"),
    ).withColumn("size", F.octet_length("piece") + len(MAGIC))


def with_offsets(pieces: DataFrame) -> DataFrame:
    """Replace split, at and size of stored pieces by their offset in the archive.

    Pieces cover a file without gaps, so their offsets are sums of the lengths before
    them: within a split first, then over the splits of a file.
    """
    splits = pieces.groupBy("archive", "split").agg(F.sum("size").alias("bytes"))
    before = W.partitionBy("archive").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    base = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    splits = stored(splits.select(F.col("archive").alias("_a"), F.col("split").alias("_s"), base.alias("base")), "splits")
    # a split is some megabytes, so the window over its pieces is bounded; it carries lengths only
    earlier = W.partitionBy("archive", "split").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    placed = pieces.select("archive", "split", "at", inner.alias("inner"), "size").join(
        splits, (F.col("archive") == F.col("_a")) & (F.col("split") == F.col("_s"))
    )
    # the first piece of a file is the empty one before its first magic line
    placed = stored(placed.select(F.col("at").alias("_at"), (F.col("base") + F.col("inner") - len(MAGIC)).alias("offset")), "placed")
    return pieces.join(placed, F.col("at") == F.col("_at")).drop("_at", "at", "split", "size").filter("offset >= 0")


def header_field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}: *([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def candidate_records(pieces: DataFrame) -> DataFrame:
    """The pieces with a readable header: head, where the body begins, its length, and the digest of a body that is all there."""
    rows = pieces.withColumn("text", F.col("piece").cast("string"))
    end = F.instr("text", "\r\n\r\n")
    rows = rows.withColumn("head", F.when(end > 0, F.substring("text", F.lit(1), end + 1)))
    rows = rows.withColumns({"length": header_field(F.col("head"), "Content-Length").try_cast("bigint"), "body_at": F.octet_length("head") + 2})
    rows = rows.withColumn("whole", F.octet_length("piece") - F.col("body_at") >= F.col("length"))
    rows = rows.withColumn("d", payload_digests(F.when(F.col("whole"), body_of(F.col("piece")))))
    return rows.select("archive", "split", "at", "size", "head", "length", "body_at", "whole", F.when(F.col("whole"), F.col("d.sha1")).alias("sha1"))


def body_of(piece: Column) -> Column:
    return F.substring(piece, F.col("body_at") + 1, F.col("length").cast("int"))


def reachable(links: DataFrame) -> DataFrame:
    """(archive, offset) of the records on the chain from the start of each file.

    Pointer jumping: in every round each record that is known hands its mark to where its
    pointer leads, and every pointer is replaced by the pointer of its target, so marks
    cover twice as much of the chain each time. The largest file sets the number of rounds.
    """
    now = stored(links.select("archive", "offset", F.col("follows").alias("jump"), (F.col("offset") == 0).alias("known")), "jumps")
    most = now.groupBy("archive").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(0, int(most - 1).bit_length()) if most else 0):
        onward = now.filter("jump IS NOT NULL")
        target = now.select(F.col("archive").alias("a"), F.col("offset").alias("o"), F.col("jump").alias("next"))
        moved = onward.join(target, (F.col("archive") == F.col("a")) & (F.col("jump") == F.col("o")))
        rows = now.select("archive", "offset", F.lit(None).cast("bigint").alias("jump"), "known").unionByName(
            moved.select("archive", "offset", F.col("next").alias("jump"), F.lit(False).alias("known"))
        )
        rows = rows.unionByName(moved.filter("known").select("archive", F.col("jump").alias("offset"), F.lit(None).cast("bigint").alias("jump"), F.lit(True).alias("known")))
        now = stored(rows.groupBy("archive", "offset").agg(F.max("jump").alias("jump"), F.max("known").alias("known")), "jumps")
    return now.filter("known").select("archive", "offset")


def verified_records(spark: SparkSession, path: str) -> DataFrame:
    """The true records: archive, offset, follows, head, body_at, length, whole, sha1. No payload is kept."""
    pieces = with_offsets(stored(candidate_records(scan_pieces(spark, path)), "candidates"))
    follows = F.col("offset") + len(MAGIC) + F.col("body_at") + F.col("length") + 4
    links = stored(pieces.filter("length >= 0").withColumn("follows", follows), "links")
    true = reachable(links).select(F.col("archive").alias("a"), F.col("offset").alias("o"))
    return stored(links.join(true, (F.col("archive") == F.col("a")) & (F.col("offset") == F.col("o"))).drop("a", "o"), "records")


def payloads(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """(archive, offset, payload) of verified records, from a second scan of their archives.

    A payload with magic lines inside is put together from its pieces.
    """
    wanted = stored(records.select("archive").distinct(), "archives")
    pieces = with_offsets(stored(scan_pieces(spark, path).join(wanted, "archive", "left_semi"), "pieces"))
    # the record that a piece belongs to is the last one that begins at or before it; offsets only, not bytes
    starts = records.select("archive", "offset", "follows", "body_at", "length")
    marked = pieces.select("archive", "offset").join(starts, ["archive", "offset"], "left")
    upto = W.partitionBy("archive").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    known = F.when(F.col("follows").isNotNull(), F.struct(F.col("offset").alias("start"), "follows", "body_at", "length"))
    owned = marked.select("archive", "offset", F.last(known, ignorenulls=True).over(upto).alias("own")).filter("offset < own.follows")
    parts = pieces.join(owned, ["archive", "offset"]).groupBy("archive", "own")
    # the pieces of one payload, whose size bounds the list
    glued = parts.agg(F.sort_array(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
    glued = glued.select("archive", "own.*", glue("parts").alias("glued"))
    return glued.select("archive", F.col("start").alias("offset"), body_of(F.col("glued")).alias("payload"))


def fields(records: DataFrame) -> DataFrame:
    field = lambda name: header_field(F.col("head"), name)
    return records.select(
        "archive", "offset", field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Target-URI").alias("url"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("named_digest"),
        field("WARC-Payload-Length").try_cast("bigint").alias("named_length"), field("WARC-Refers-To").alias("refers_to"),
        "length", "sha1",
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the WARC files under ``path``: header fields, payload length and digest, and the payload.

    Length and digest are those of the payload that was read; for a revisit, which has none,
    those its header names. Empty files give no rows, and a file is read as far as its
    chain of records goes. The payload of a revisit is null.
    """
    records = verified_records(spark, path)
    found = fields(records)
    cut = records.filter("NOT whole")
    if with_payload or not cut.isEmpty():
        glued = payloads(spark, path, records if with_payload else cut).withColumnsRenamed({"archive": "a", "offset": "o"})
        glued = glued.withColumn("glued_sha1", payload_digests("payload")["sha1"])
        found = found.join(glued, (F.col("archive") == F.col("a")) & (F.col("offset") == F.col("o")), "left").drop("a", "o")
        found = found.withColumn("sha1", F.coalesce("glued_sha1", "sha1")).drop("glued_sha1")
    revisit = F.col("record_type") == "revisit"
    found = found.withColumn("payload_digest", F.when(revisit, F.col("named_digest")).otherwise(F.col("sha1")))
    found = found.withColumn("payload_bytes", F.when(revisit, F.col("named_length")).otherwise(F.col("length")))
    columns = ["archive", "offset", "record_type", "record_id", "url", "payload_bytes", "payload_digest", "refers_to"]
    if with_payload:
        found = found.withColumn("payload", F.when(~revisit, F.col("payload")))
        columns.append("payload")
    return found.select(*columns)


@F.arrow_udf(T.BinaryType())
def glue(parts: pa.Array) -> pa.Array:
    return pa.array([MAGIC.encode().join(p["piece"] for p in row) for row in parts.to_pylist()], pa.binary())


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", with_payload: bool = True) -> DataFrame:
    """Write ``pages`` as archives in the work folder and read them back: the records, with ``page_id`` and ``refers_to``.

    Other columns of ``pages`` are not archived. A null page has an empty payload.
    """
    spark = pages.sparkSession
    path = work_folder(spark, "llm-warc")
    payload = F.col(html).cast("binary")
    write_archives(plan_records(pages, payload, page_id, url), path)
    number = lambda name: F.regexp_extract(name, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    read = read_archives(spark, path, with_payload)
    return read.withColumns({"page_id": number("record_id"), "refers_to": number("refers_to")})
