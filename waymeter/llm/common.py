"""Helpers shared by the operators: tables, stored intermediate results, text as arrays.

Intermediate results go to a Parquet table under ``spark.checkpoint.dir`` (see
:func:`stored`). A lost executor then costs the tasks it ran, never the lineage behind
them, and the planner sees the true size of the table when it picks a join.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waymeter.session import work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that the array functions handle at once; the arrays take some 60 times as much.
CHUNK_BYTES = 1 << 20
#: Of stored tables, most of which are texts: smaller than the default of Spark, for a little more time.
COMPRESSION = "zstd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, f"llm-{name}")
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark removes them once their plans are collected."""
    gc.collect()
    for _ in range(2):
        # what the first round finds unreachable may have held on to more
        spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows for the jobs run inside: bounds what a Python worker holds."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns in one struct, so that names an operator adds cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, source: DataFrame, added: dict[str, Column], name: str = "_row") -> DataFrame:
    """The columns of ``source`` again, and ``added``; an added name replaces an input column."""
    kept = [F.col(f"{name}.`{c}`") for c in source.columns if c not in added]
    return df.select(*kept, *[value.alias(c) for c, value in added.items()])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer row is a range of its own."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes; every byte of other characters is over 127 and stays."""
    return _FOLD[data]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: runs of bytes that are not ``breaks`` (space, tab to carriage return)."""
    solid = ~breaks[data]
    if not solid.any():
        none = np.empty(0, np.int64)
        return none, none, none
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.concatenate(([False], solid[:-1]))
    before[edges] = False
    after = np.concatenate((solid[1:], [False]))
    after[edges - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: bytes times pseudo-random odd factors by place, summed, mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    at = np.arange(len(first))
    byte = data[at + first].astype(np.uint64) + np.uint64(1)
    heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = at - np.repeat(heads, lengths)
    factors = mix(np.arange(1, int(lengths.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return mix(np.add.reduceat(byte * factors[place], heads) + lengths.astype(np.uint64))
