"""Repeated strings across documents, by sorted suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier. Sorting every
suffix is out of reach, and not needed: of each such string the smallest gram (a hash of a
quarter of its length) is an anchor, and equal strings have equal anchors at equal places.
So only anchors are compared, some two in ``length - gram`` positions, and of those only the
ones whose gram occurs twice anywhere. That is found by counting quotient filters.

An anchor's context is all that a string around it can touch. Occurrences with equal contexts
form a class, and all but the first lose every string around them. Of grams with several
classes, the first occurrences are compared by the suffixes that start at the anchor and the
reversed prefixes that end there. Both are ordered by deep-shallow sorting: multikey
quicksort over eight-byte words to a shallow depth, for all groups of a task at once, then a
blind trie for each group that has so much in common. Two strings that lie ``o`` bytes before their
anchors are equal if the prefixes share ``o`` bytes and the suffixes the rest, which the two
orders and their common lengths tell for every ``o``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from waymeter.llm.common import CHUNK_BYTES, mix, packed, release, row_chunks, stored, texts, unpacked
from waymeter.llm.exact import BLOCK_ENTRIES, FILTER, FILTER_ENTRIES, _filter_batch, merged_filter, repeated_prints

#: Bits of a gram's hash that the filters keep.
GRAM_BITS = 60
#: Words of eight bytes that quicksort looks at before blind tries take over.
SHALLOW_WORDS = 6
#: Contexts that are sorted in one go; a group is never cut.
SORT_ROWS = 20_000
#: Classes of one gram up to which its contexts are sorted in one task; larger groups are
#: compared string by string, in an aggregate that every task takes part in.
MOST_CLASSES = 1 << 17

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
ANCHORS = T.StructType([T.StructField(n, T.ArrayType(t)) for n, t in (("pos", T.IntegerType()), ("gram", T.LongType()), ("context", T.LongType()))])
CONTEXTS = T.ArrayType(T.StructType([T.StructField("left", T.IntegerType()), T.StructField("bytes", T.BinaryType())]))
RESULT = T.StructType(
    [T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]
)


def gram_of(length: int) -> int:
    return max(1, length // 4)


class _Sums:
    """Sums of bytes times powers of an odd number: the hash of any range from two of them."""

    def __init__(self, data: np.ndarray, multiplier: int):
        n = len(data) + 1
        self.inverse = np.full(n, pow(multiplier, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)
        powers = np.full(n, multiplier, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.sums[1:])

    def hashes(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def _slide(values: np.ndarray, width: int, extreme) -> np.ndarray:
    """The extreme of each ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = extreme(values[:-step], values[step:])
        have += step
    return values


def anchors_in(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of rows that lie end to end: places, hashes of grams, hashes of contexts with their sizes."""
    gram = gram_of(length)
    width = length - gram + 1
    none = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if len(data) < length:
        return none
    grams = _Sums(data, _MULTIPLIERS[0])
    places = np.arange(len(data) - gram + 1)
    hashes = grams.hashes(places, places + gram) | np.uint64(1)
    smallest = _slide(hashes, width, np.minimum)
    row_ends = np.repeat(offsets[1:], np.diff(offsets))
    # strings that end in another row are none
    starts = np.arange(len(smallest))
    smallest[starts + length > row_ends[: len(smallest)]] = 0
    around = np.concatenate((np.zeros(width - 1, np.uint64), smallest, np.zeros(width - 1, np.uint64)))
    at = np.flatnonzero(_slide(around, width, np.maximum) == hashes)
    if not len(at):
        return none
    rows = np.searchsorted(offsets, at, "right") - 1
    left = np.minimum(at - offsets[rows], length - gram)
    right = np.minimum(offsets[rows + 1] - at, length)
    context = _Sums(data, _MULTIPLIERS[1]).hashes(at - left, at + right)
    sizes = (left * (length + 1) + right).astype(np.uint64)
    return at, hashes[at] >> np.uint64(64 - GRAM_BITS), mix(context + sizes * np.uint64(_MULTIPLIERS[0]))


def anchored(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after, places in the row, row of each, grams, contexts) for chunks of a column.

    A row longer than a chunk is read in pieces that overlap by what a string and a context can span.
    """
    data, offsets = texts(column)
    for low, high in row_chunks(offsets):
        begin, end = int(offsets[low]), int(offsets[high])
        if end - begin <= 2 * CHUNK_BYTES:
            within = offsets[low : high + 1] - begin
            at, grams, contexts = anchors_in(data[begin:end], within, length)
            rows = np.searchsorted(within, at, "right") - 1
            yield low, high, at - within[rows], rows + low, grams, contexts
            continue
        found = {}
        for start in range(begin, end, CHUNK_BYTES):
            a, b = max(begin, start - 2 * length), min(end, start + CHUNK_BYTES + 2 * length)
            at, grams, contexts = anchors_in(data[a:b], np.array([0, b - a]), length)
            # places near a cut are seen whole in the next piece
            mine = (at + a >= start) & (at + a < start + CHUNK_BYTES)
            found[start] = at[mine] + a - begin, grams[mine], contexts[mine]
        at, grams, contexts = (np.concatenate(x) for x in zip(*found.values()))
        yield low, high, at, np.full(len(at), low), grams, contexts


def anchors_udf(length: int):
    @F.arrow_udf(ANCHORS)
    def anchors(column: pa.Array) -> pa.Array:
        counts, parts = [np.zeros(1, np.int64)], [[], [], []]
        for low, high, at, rows, grams, contexts in anchored(column, length):
            counts.append(np.bincount(rows - low, minlength=high - low))
            for part, values in zip(parts, (at.astype(np.int32), grams.view(np.int64), contexts.view(np.int64))):
                part.append(values)
        ends = pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32))
        kinds = (np.int32, np.int64, np.int64)
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(p) if p else np.empty(0, k))) for p, k in zip(parts, kinds)]
        return pa.StructArray.from_arrays(lists, ["pos", "gram", "context"])

    return anchors


def gram_filters(column: DataFrame, length: int, remainder_bits: int) -> DataFrame:
    """Counting quotient filters of the grams of each partition of a text column."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for *_, grams, _ in anchored(batch.column(0), length):
                held.append(grams)
                size += len(grams)
                if size >= FILTER_ENTRIES:
                    yield _filter_batch(*np.unique(np.concatenate(held), return_counts=True), remainder_bits)
                    held, size = [], 0
        if size:
            yield _filter_batch(*np.unique(np.concatenate(held), return_counts=True), remainder_bits)

    return column.mapInArrow(build, FILTER)


def contexts_udf(length: int):
    left, right = length - gram_of(length), length

    @F.arrow_udf(CONTEXTS)
    def contexts(column: pa.Array, places: pa.Array) -> pa.Array:
        data, offsets = texts(column)
        out = []
        for a, b, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), places.to_pylist()):
            row = data[a:b].tobytes()
            out.append([{"left": min(p, left), "bytes": row[max(0, p - left) : p + right]} for p in at])
        return pa.array(out, pa.list_(pa.struct([("left", pa.int32()), ("bytes", pa.binary())])))

    return contexts


# ---- deep-shallow sorting --------------------------------------------------------------


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of strings, and what each has in common with the one before it (0 for the first).

    Inner nodes are [depth, {next byte: child}], where the end of a string counts as byte -1;
    leaves are the numbers of strings. Going down looks at the branching bytes only, and one comparison
    with the leaf it ends at tells where the new string leaves the path.
    """
    equal: dict[bytes, list[int]] = {}
    for i, s in enumerate(strings):
        equal.setdefault(s, []).append(i)
    names = list(equal)
    root: list | int = 0
    for new, s in enumerate(names[1:], 1):
        node = root
        while not isinstance(node, int):
            depth, children = node
            node = children.get(s[depth] if depth < len(s) else -1)
            if node is None:
                node = next(iter(children.values()))
        other = names[node]
        n = min(len(s), len(other))
        differ = int.from_bytes(s[:n], "big") ^ int.from_bytes(other[:n], "big")
        common = n - (differ.bit_length() + 7) // 8
        above, node = None, root
        while not isinstance(node, int) and node[0] < common:
            above, node = node, node[1][s[node[0]]]
        byte = s[common] if common < len(s) else -1
        if not isinstance(node, int) and node[0] == common:
            node[1][byte] = new
            continue
        branch = [common, {other[common] if common < len(other) else -1: node, byte: new}]
        if above is None:
            root = branch
        else:
            above[1][s[above[0]]] = branch
    order, shared = [], []
    stack: list[tuple[list | int, int]] = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if isinstance(node, int):
            same = equal[names[node]]
            order += same
            shared += [before] + [len(names[node])] * (len(same) - 1)
        else:
            depth, children = node
            keys = sorted(children)
            stack += [(children[k], depth if k != keys[0] else before) for k in reversed(keys)]
    return order, shared


def deep_shallow(group: np.ndarray, strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings by group and content, and what neighbours have in common (-1 between groups)."""
    n = len(strings)
    words = -(-width // 8)
    bytes_ = np.frombuffer(b"".join(s.ljust(words * 8, b"\0") for s in strings), np.uint8).reshape(n, words * 8)
    values = bytes_.view(">u8").astype(np.uint64)
    lengths = np.array([len(s) for s in strings], np.int64)
    slots = np.argsort(group, kind="stable")
    segment = np.cumsum(np.concatenate(([0], group[slots][1:] != group[slots][:-1])))
    depth = np.zeros(n, np.int64)
    shallow = min(SHALLOW_WORDS, words)
    while True:
        # segments of two or more that quicksort still divides
        heads = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        sizes = np.diff(np.append(heads, n))
        many = (sizes > 1) & (depth[heads] < shallow)
        if not many.any():
            break
        # of each segment the word of its middle element divides the others in three
        chosen = np.repeat(many, sizes)
        pivots = np.repeat(values[slots[heads + sizes // 2], np.minimum(depth[heads], words - 1)], sizes)
        at = np.flatnonzero(chosen)
        word = values[slots[at], depth[at]]
        part = np.zeros(n, np.int64)
        part[at] = 2 * (word > pivots[at]) + (word == pivots[at])
        moved = np.argsort(segment * 3 + part, kind="stable")
        slots, segment, part, depth, chosen = slots[moved], segment[moved], part[moved], depth[moved], chosen[moved]
        depth = depth + (chosen & (part == 1))
        key = segment * 3 + part
        segment = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    shared = np.full(n, -1, np.int64)
    for a, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        members = slots[a : a + size]
        order, inner = blind_trie([strings[i] for i in members])
        slots[a : a + size] = members[order]
        shared[a + 1 : a + size] = inner[1:]
    # neighbours that quicksort has parted
    edge = np.setdiff1d(np.flatnonzero(shared < 0), [0])
    edge = edge[group[slots[edge]] == group[slots[edge - 1]]]
    x, y = slots[edge - 1], slots[edge]
    differ = bytes_[x] != bytes_[y]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), words * 8)
    shared[edge] = np.minimum(first, np.minimum(lengths[x], lengths[y]))
    return slots, shared


def repeated_offsets(group: np.ndarray, left: np.ndarray, contexts: list[bytes], age: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance to the anchor of a string that also occurs earlier in its group (-1: none).

    ``age`` orders the occurrences.
    """
    n, reach = len(contexts), length - gram_of(length)
    suffixes = [c[i:] for c, i in zip(contexts, left.tolist())]
    prefixes = [c[:i][::-1] for c, i in zip(contexts, left.tolist())]
    right = np.array([len(s) for s in suffixes])
    orders = [deep_shallow(group, suffixes, length), deep_shallow(group, prefixes, max(1, reach))]
    oldest = np.argsort(age, kind="stable")
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    names = np.empty((2, n), np.int64)
    for o in range(reach + 1):
        for name, (slots, shared), depth in zip(names, orders, (length - o, o)):
            name[slots] = np.cumsum(shared < depth)
        have = oldest[((left >= o) & (right >= length - o))[oldest]]
        if len(have) < 2:
            continue
        _, first = np.unique(names[0, have] * (n + 1) + names[1, have], return_index=True)
        again = np.ones(len(have), bool)
        again[first] = False
        hit = have[again]
        low[hit] = np.where(low[hit] < 0, o, low[hit])
        high[hit] = o
    return low, high


def sorter(length: int):
    """Arrow function over contexts sorted by gram: what their first occurrences lose to each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def lost(rows: pa.Table) -> pa.RecordBatch:
            columns = {name: np.asarray(rows[name].combine_chunks()) for name in ("gram", "rank", "pos", "left", "_uid")}
            contexts = rows["bytes"].to_pylist()
            age = np.empty(len(contexts), np.int64)
            age[np.lexsort((columns["pos"], columns["rank"]))] = np.arange(len(contexts))
            low, high = repeated_offsets(columns["gram"], columns["left"].astype(np.int64), contexts, age, length)
            hit = np.flatnonzero(low >= 0)
            pos = columns["pos"][hit].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(columns["_uid"][hit]), pa.array(pos - high[hit]), pa.array(pos - low[hit] + length)], ["_uid", "low", "high"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SORT_ROWS:
                rows = pa.Table.from_batches(held)
                grams = np.asarray(rows["gram"].combine_chunks())
                # the last group may go on in the next batch
                cut = int(np.searchsorted(grams, grams[-1]))
                if cut:
                    yield lost(rows.slice(0, cut))
                    held = rows.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield lost(pa.Table.from_batches(held))

    return run


def strings_udf(length: int):
    """Digest of every string around an anchor, with its distance to the anchor."""
    reach = length - gram_of(length)
    shape = T.ArrayType(T.StructType([T.StructField("before", T.IntegerType()), T.StructField("digest", T.BinaryType())]))

    @F.arrow_udf(shape)
    def strings(left: pa.Array, contexts: pa.Array) -> pa.Array:
        out = []
        for at, context in zip(left.to_pylist(), contexts.to_pylist()):
            whole = [(o, context[at - o : at - o + length]) for o in range(min(at, reach) + 1)]
            out.append([{"before": o, "digest": hashlib.blake2b(s, digest_size=16).digest()} for o, s in whole if len(s) == length])
        return pa.array(out, pa.list_(pa.struct([("before", pa.int32()), ("digest", pa.binary())])))

    return strings


def removal_udf(keep: bool):
    @F.arrow_udf(RESULT)
    def remove(column: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
        data, offsets = texts(column)
        out = []
        for a, b, low, high in zip(offsets[:-1], offsets[1:], lows.to_pylist(), highs.to_pylist()):
            low, high = np.array(low), np.array(high)
            order = np.argsort(low, kind="stable")
            low, reach = low[order], np.maximum.accumulate(high[order])
            # spans that touch are one run
            heads = np.flatnonzero(np.concatenate(([True], low[1:] > reach[:-1])))
            starts, ends = low[heads], reach[np.append(heads[1:] - 1, len(reach) - 1)]
            marks = np.zeros(b - a + 1, np.int8)
            marks[starts] += 1
            marks[ends] -= 1
            kept = data[a:b][np.cumsum(marks[:-1]) == 0].tobytes()
            out.append({"n_removed": int((ends - starts).sum()), "n_spans": len(heads), "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if keep else None})
        shape = pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
        return pa.array(out, shape)

    return remove


# ---- the operator ----------------------------------------------------------------------


def _ranks(rows: DataFrame) -> DataFrame:
    """Number of each row in the order of the documents."""
    order = ["_id", "_tie", "_uid"]
    sorted_ = rows.select(*order, "_n").repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_.select("_uid", "_n", F.monotonically_increasing_id().alias("rank")), "ranks")


def remove_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 100, keep_text: bool = True, most_classes: int = MOST_CLASSES
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, with ``keep_text``, ``kept_bytes``.

    A byte of a text in UTF-8 is removed if a string of ``length`` bytes covers it that also
    starts earlier: in a document with a smaller ``doc_id``, or in the same one. A null text is
    empty; a text shorter than ``length`` loses nothing. A row without ``doc_id`` comes first. Rows that
    repeat an id are ordered by a hash of their texts; of equal rows one comes first.
    What is left is bytes, as a cut may fall inside a character. Columns of ``docs``
    with the name of a result column are replaced. An empty table gives an empty one.

    ``most_classes`` chooses how a gram's contexts are compared, never the result. Hashes of 124 bits
    stand for a gram with its context.
    """
    spark = docs.sparkSession
    rows = packed(docs)
    row = F.col("_row") if keep_text else F.col("_row").dropFields(f"`{text}`")
    whole = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    rows = rows.select(
        row.alias("_row"), F.col(f"_row.`{doc_id}`").alias("_id"), whole.alias("_text"), F.octet_length(whole).cast("bigint").alias("_n"),
        F.sha2(whole, 256).alias("_sha"), F.monotonically_increasing_id().alias("_uid"),
    )
    rows = stored(rows.withColumn("_tie", F.conv(F.substring("_sha", 1, 15), 16, 10).cast("bigint")), "rows")
    long = rows.filter(F.col("_n") >= length)
    total = long.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    ranks = _ranks(rows.filter(F.col("_n") >= length))

    # grams that occur twice, and where
    entries = total * 2 / (length - gram_of(length) + 2)
    blocks = max(entries / BLOCK_ENTRIES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    remainder_bits = GRAM_BITS - min(GRAM_BITS, math.ceil(math.log2(blocks)))
    filters = merged_filter(gram_filters(long.select("_text"), length, remainder_bits))
    repeated = stored(repeated_prints(filters, remainder_bits).select(F.col("_print").alias("gram")), "grams")
    every = long.select("_uid", anchors_udf(length)("_text").alias("a")).select("_uid", F.explode(F.arrays_zip("a.pos", "a.gram", "a.context")).alias("a"))
    every = every.select("_uid", "a.pos", "a.gram", "a.context").join(repeated, "gram", "left_semi")
    every = stored(every.join(ranks, "_uid"), "anchors")
    release(spark)

    # one class for each context; the first occurrence keeps its strings for now
    classes = every.groupBy("gram", "context").agg(F.min(F.struct("rank", "pos", "_uid")).alias("first"))
    classes = stored(classes, "classes")
    many = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    asked = classes.join(many, "gram").select("gram", "classes", "first.*")
    asked = asked.groupBy("_uid").agg(F.collect_list(F.struct("pos", "gram", "rank", "classes")).alias("asked"))
    reach = length - gram_of(length)
    span = [
        (F.col("pos") - F.least("pos", F.lit(reach))).cast("bigint").alias("low"),
        (F.col("pos") - F.greatest(F.lit(0), F.lit(length) - F.col("_n") + F.col("pos")) + length).cast("bigint").alias("high"),
    ]
    later = every.join(classes, ["gram", "context"]).filter("rank != first.rank OR pos != first.pos")
    lost = stored(later.select("_uid", *span), "later")
    del later
    release(spark)
    contexts = rows.select("_uid", "_text").join(asked, "_uid").withColumn("contexts", contexts_udf(length)("_text", F.col("asked.pos")))
    contexts = contexts.select("_uid", F.explode(F.arrays_zip("asked", "contexts")).alias("c")).select("_uid", "c.asked.*", "c.contexts.*")
    contexts = stored(contexts, "contexts")
    release(spark)
    sorted_ = contexts.filter(F.col("classes") <= most_classes).repartition("gram").sortWithinPartitions("gram")
    between = sorted_.select("gram", "rank", "pos", "left", "_uid", "bytes").mapInArrow(sorter(length), "_uid bigint, low bigint, high bigint")
    lost = lost.unionByName(between).unionByName(_lost_in_large(contexts.filter(F.col("classes") > most_classes), length))

    pieces = stored(lost.groupBy("_uid").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")), "pieces")
    release(spark)
    pieces = rows.select("_uid", "_text").join(pieces, "_uid").select(F.col("_uid").alias("_of"), removal_udf(keep_text)("_text", "lows", "highs").alias("r"))
    pieces = stored(pieces, "removed")
    release(spark)
    joined = rows.drop("_id", "_tie", *([] if keep_text else ["_text"])).join(pieces, F.col("_uid") == F.col("_of"), "left")
    found = {
        "n_bytes": F.col("_n"),
        "n_removed": F.coalesce("r.n_removed", F.lit(0)).cast("bigint"),
        "n_spans": F.coalesce("r.n_spans", F.lit(0)).cast("bigint"),
        "kept_sha256": F.coalesce("r.kept_sha256", "_sha"),
    }
    if keep_text:
        found["kept_bytes"] = F.coalesce("r.kept", F.encode("_text", "UTF-8"))
    return unpacked(joined, docs if keep_text else docs.drop(text), found)


def _lost_in_large(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many classes: every string around them, by a minimum that is formed in each task first."""
    strings = contexts.select("_uid", "rank", "pos", F.explode(strings_udf(length)("left", "bytes")).alias("s"))
    strings = strings.select("_uid", "rank", (F.col("pos") - F.col("s.before")).cast("bigint").alias("start"), "s.digest")
    first = strings.groupBy("digest").agg(F.min(F.struct("rank", "start")).alias("first"))
    again = strings.join(first, "digest").filter("rank != first.rank OR start != first.start")
    return again.select("_uid", F.col("start").alias("low"), (F.col("start") + length).alias("high"))
