"""Ordered work per key that holds up when one key owns a large share of the rows.

A window over one key runs in one task. That is right for ordinary keys and wrong for
a key with a third of all rows. So rows are split first: rows of heavy keys are cut
into consecutive chunks of the order column, each chunk is scanned on its own, and one
small summary row per chunk carries the running values across chunk edges. No row is
dropped or sampled, and ordinary keys keep the plain one-shuffle plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

SLOTS = 4096
#: Chunks of one heavy slot at most.
MOST_CHUNKS = 256
ROWS_PER_TASK = 2_000_000
CHUNK = "_chunk"
SLOT = "_slot"


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def heavy_slots(df: DataFrame, key: str, order: str, rows_per_task: int = ROWS_PER_TASK) -> list[tuple[int, list[int]]]:
    """Hash slots that hold too many rows for one task, with the values of ``order`` to cut them at.

    Counting slots in place of keys bounds the shuffle (SLOTS partial rows per task) and
    still finds every heavy key, since its slot is at least as heavy. A slot is heavy
    beyond four times the mean slot and ``rows_per_task``, so at most SLOTS / 4 small
    rows reach the driver, whatever the data. Cuts are quantiles, so chunks are even
    however ``order`` is spread; only heavy slots pay for them.
    """
    slotted = df.select(_slot(key).alias(SLOT), F.col(order).alias("value"))
    counts = slotted.groupBy(SLOT).agg(F.count(F.lit(1)).alias("n"))
    # a window over at most SLOTS rows
    mean = F.sum("n").over(W.partitionBy(F.lit(0))) / F.lit(SLOTS)
    heavy = counts.withColumn("mean", mean).filter((F.col("n") > 4 * F.col("mean")) & (F.col("n") > rows_per_task))
    parts = {r[SLOT]: min(MOST_CHUNKS, math.ceil(r["n"] / max(rows_per_task, r["mean"]))) for r in heavy.collect()}
    if not parts:
        return []
    steps = [i / MOST_CHUNKS for i in range(1, MOST_CHUNKS)]
    spread = slotted.filter(F.col(SLOT).isin(*parts)).groupBy(SLOT).agg(F.percentile_approx("value", steps, 10_000).alias("at"))
    return [(r[SLOT], sorted({r["at"][i * MOST_CHUNKS // parts[r[SLOT]] - 1] for i in range(1, parts[r[SLOT]])})) for r in spread.collect()]


def per_key(
    df: DataFrame,
    key: str,
    order: str,
    body: Callable[[DataFrame, list[str]], DataFrame],
    rows_per_task: int = ROWS_PER_TASK,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Run ``body`` over ordinary keys whole and over heavy keys in chunks.

    ``body(rows, chunk)`` gets ``chunk=[]`` for ordinary keys and the name of the chunk
    column for heavy ones, and must pass both to :func:`carry`. Without heavy keys the
    plan is just ``body(df, [])``. Finding them takes one pass over (key, order) when the
    plan is made; ``keys`` may give the two from a cheaper scan than ``df``. ``order`` has
    to be an integer, unique within a key, whether or not a key is heavy.
    """
    if not isinstance(df.schema[order].dataType, (T.LongType, T.IntegerType)):
        raise ValueError(f"rows are ordered by an integer that is unique within a key; {order!r} is {df.schema[order].dataType.simpleString()}")
    heavy = heavy_slots((df if keys is None else keys).select(key, order), key, order, rows_per_task)
    if not heavy:
        return body(df, [])
    # at most SLOTS / 4 rows of MOST_CHUNKS numbers, so this broadcast does not grow with the data
    ranges = F.broadcast(df.sparkSession.createDataFrame(heavy, f"{SLOT} int, cuts array<bigint>"))
    slotted = df.withColumn(SLOT, _slot(key))
    ordinary = slotted.join(ranges, SLOT, "left_anti").drop(SLOT)
    # rising in the order column: chunks never overlap
    chunk = F.size(F.filter("cuts", lambda cut: cut < F.col(order)))
    chunked = slotted.join(ranges, SLOT).withColumn(CHUNK, chunk).drop(SLOT, "cuts")
    return body(ordinary, []).unionByName(body(chunked, [CHUNK]).drop(CHUNK))


def carry(
    df: DataFrame,
    key: str,
    order: str,
    chunk: list[str],
    upto: Mapping[str, Column] | None = None,
    before: Mapping[str, Column] | None = None,
    total_before: Mapping[str, Column] | None = None,
    final: str | None = None,
) -> DataFrame:
    """Running values per key in the order of ``order`` (unique within a key).

    upto          last non-null value so far, this row included
    before        last non-null value over the earlier rows
    total_before  sum over the earlier rows, 0 at the start
    final         name of a flag that marks the last row of the key
    """
    upto, before, total_before = dict(upto or {}), dict(before or {}), dict(total_before or {})
    ordered = W.partitionBy(key, *chunk).orderBy(order)
    so_far = ordered.rowsBetween(W.unboundedPreceding, 0)
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    columns = {
        **{name: F.last(value, ignorenulls=True).over(so_far) for name, value in upto.items()},
        **{name: F.last(value, ignorenulls=True).over(earlier) for name, value in before.items()},
        **{name: F.coalesce(F.sum(value).over(earlier), F.lit(0)) for name, value in total_before.items()},
    }
    if final:
        columns[final] = F.lead(order).over(ordered).isNull()
    local = df.withColumns(columns)
    if not chunk:
        return local

    lasts = {**upto, **before}
    summary = df.groupBy(key, *chunk).agg(
        *[F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(name) for name, value in lasts.items()],
        *[F.sum(value).alias(name) for name, value in total_before.items()],
        F.max(order).alias("_end"),
    )
    # one row per chunk of a heavy key
    chunks = W.partitionBy(key).orderBy(*chunk)
    previous = chunks.rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select(
        key,
        *chunk,
        *[F.last(name, ignorenulls=True).over(previous).alias(f"{name}_in") for name in lasts],
        *[F.sum(name).over(previous).alias(f"{name}_in") for name in total_before],
        F.lead("_end").over(chunks).isNull().alias("_last_chunk"),
    )
    # both sides are partitioned and sorted by (key, chunk): no shuffle of the rows
    joined = local.join(carried, [key, *chunk], "left")
    merged = {
        **{name: F.coalesce(F.col(name), F.col(f"{name}_in")) for name in lasts},
        **{name: F.col(name) + F.coalesce(F.col(f"{name}_in"), F.lit(0)) for name in total_before},
    }
    if final:
        merged[final] = F.col(final) & F.col("_last_chunk")
    extra = [f"{name}_in" for name in (*lasts, *total_before)]
    return joined.withColumns(merged).drop(*extra, "_last_chunk")


def latest(df: DataFrame, keys: list[str], order: Column | str, columns: list[str]) -> DataFrame:
    """The row with the highest ``order`` per key.

    An aggregate, not a row_number window: each task sends at most one row per key, so
    a heavy key costs no more than any other.
    """
    row = F.max_by(F.struct(*columns), F.col(order) if isinstance(order, str) else order)
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
