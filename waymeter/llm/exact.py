"""Exact duplicates through counting quotient filters.

Each partition counts its fingerprints in a quotient filter: the high bits (quotient)
choose a block, the low bits (remainder) are kept sorted in it, with a count. Filters of
different partitions merge without loss by merging the sorted remainders of a block and
adding counts. A fingerprint counted once belongs to a unique text. The texts of the
others are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from waymeter.llm.bloom import split
from waymeter.llm.common import fold, packed, stored, texts, unpacked

#: Distinct fingerprints that one block of a merged filter is laid out for.
BLOCK_ENTRIES = 1 << 16
#: A partition's filter is sent on when it holds so many entries, and a new one begun.
FILTER_ENTRIES = 1 << 20

FILTER = "block bigint, remainders array<bigint>, counts array<bigint>"


def normalised(column: pa.Array) -> list[bytes]:
    data, offsets = texts(column)
    data = fold(data).tobytes()
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


@F.arrow_udf(T.BinaryType())
def text_digest(column: pa.Array) -> pa.Array:
    """SHA-256 of a text with A-Z lower-cased, in UTF-8; null counts as empty."""
    return pa.array([hashlib.sha256(x).digest() for x in normalised(column)], pa.binary())


@F.arrow_udf(T.BinaryType())
def normal_bytes(column: pa.Array) -> pa.Array:
    return pa.array(normalised(column), pa.binary())


def count_sorted(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge runs of remainders: sorted distinct values and the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[heads], np.add.reduceat(counts, heads)


def _filter_batch(values: np.ndarray, counts: np.ndarray, remainder_bits: int) -> pa.RecordBatch:
    blocks, remainders = values >> np.uint64(remainder_bits), values & np.uint64((1 << remainder_bits) - 1)
    heads = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
    offsets = pa.array(np.append(heads, len(values)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (remainders, counts)]
    return pa.RecordBatch.from_arrays([pa.array(blocks[heads].astype(np.int64)), *lists], ["block", "remainders", "counts"])


def partition_filters(prints: DataFrame, remainder_bits: int) -> DataFrame:
    """One counting quotient filter (or more, beyond FILTER_ENTRIES) for each partition of a bigint column."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            new = np.asarray(batch.column(0)).astype(np.uint64)
            values, counts = count_sorted(np.concatenate((values, new)), np.concatenate((counts, np.ones(len(new), np.int64)))) if len(new) else (values, counts)
            if len(values) >= FILTER_ENTRIES:
                yield _filter_batch(values, counts, remainder_bits)
                values, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(values):
            yield _filter_batch(values, counts, remainder_bits)

    return prints.mapInArrow(build, FILTER)


def merged_filter(filters: DataFrame) -> DataFrame:
    """Merge filters block by block. A block holds about BLOCK_ENTRIES entries at most, as copies share one entry."""

    def merge(pieces: pa.Table) -> pa.Table:
        column = lambda name: np.asarray(pieces[name].combine_chunks().flatten())
        remainders, counts = count_sorted(column("remainders"), column("counts"))
        block = pieces["block"][0]
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
        return pa.table({"block": pa.array([block.as_py()], pa.int64()), "remainders": whole(remainders), "counts": whole(counts)})

    return filters.groupBy("block").applyInArrow(merge, FILTER)


def repeated_prints(filters: DataFrame, remainder_bits: int) -> DataFrame:
    """Fingerprints counted twice or more, with their count."""
    entries = filters.select("block", F.explode(F.arrays_zip("remainders", "counts")).alias("e")).filter("e.counts > 1")
    print_ = F.shiftleft(F.col("block"), remainder_bits).bitwiseOR(F.col("e.remainders"))
    return entries.select(print_.alias("_print"), F.col("e.counts").alias("n"))


def find_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", print_bits: int = 60) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty.
    Of equal texts the row with the largest ``doc_id`` stays, null being the smallest; of
    rows that repeat that id as well, exactly one does. ``keep_id`` is the id of the row that
    stays and may be null. Columns of ``docs`` with the name of a result column are replaced.

    ``print_bits`` (62 at most) sets how often different texts share a fingerprint, never
    the result. Copies of one text meet only as counts: the filter, the comparison and
    the choice of the row that stays are all summed in each task before the shuffle.
    """
    spark = docs.sparkSession
    rows = packed(docs).withColumn("_sha", text_digest(F.col(f"_row.`{text}`"))).withColumn("_uid", F.monotonically_increasing_id())
    high = F.conv(F.hex(F.substring("_sha", 1, 8)), 16, 10).cast("decimal(20,0)")
    rows = stored(rows.withColumn("_print", F.floor(high / F.lit(2 ** (64 - print_bits)).cast("decimal(20,0)")).cast("bigint")), "digests")
    blocks = max(rows.count() / BLOCK_ENTRIES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    remainder_bits = print_bits - min(print_bits, int(np.ceil(np.log2(blocks))))
    filters = merged_filter(partition_filters(rows.select("_print"), remainder_bits))
    routed = stored(repeated_prints(filters, remainder_bits).select("_print"), "prints")

    # only rows whose fingerprint may repeat are shuffled with their text
    possible, alone_at_once = split(rows, F.col("_print"), routed, "_print")
    # texts whose fingerprint repeats, grouped by their bytes
    suspects = possible.select("_sha", "_print", "_uid", F.col(f"_row.`{doc_id}`").alias("_id"), F.col(f"_row.`{text}`").alias("_text"))
    suspects = suspects.join(routed, "_print", "left_semi").withColumn("_bytes", normal_bytes("_text"))
    same = suspects.groupBy("_sha", "_bytes").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("_id", "_uid")).alias("last"))
    alone = F.when(F.max("_bytes") == F.min("_bytes"), F.max("n")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")))
    groups = same.groupBy("_sha").agg(alone.alias("n"), F.max("last").alias("last")).filter("n > 1")
    groups = stored(groups.select(F.col("_sha").alias("_of"), "n", F.col("last._id").alias("_keep"), F.col("last._uid").alias("_keep_uid")), "groups")

    joined = possible.join(groups, F.col("_sha") == F.col("_of"), "left").unionByName(alone_at_once, allowMissingColumns=True)
    copy = F.col("_of").isNotNull()
    return unpacked(
        joined,
        docs,
        {
            "keep_id": F.when(copy, F.col("_keep")).otherwise(F.col(f"_row.`{doc_id}`")),
            "group_size": F.coalesce("n", F.lit(1)).cast("bigint"),
            "kept": F.coalesce(F.col("_uid") == F.col("_keep_uid"), F.lit(True)),
            "text_sha256": F.lower(F.hex("_sha")),
        },
    )
