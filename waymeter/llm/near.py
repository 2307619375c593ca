"""Near duplicates by HyperMinHash sketches, banding and exact verification.

A text is the set of its word shingles. Its sketch has 256 buckets; each keeps, of the
smallest hash that falls into it, the count of leading zeros and ten bits after them.
Groups of registers (bands) are hashed to keys; texts that share a key are candidates.
Their Jaccard similarity is estimated from equal registers, corrected for registers that
agree by chance, and what is near the threshold or above is verified on the full sets.

A bucket of g texts gives about g pairs, each text with the hub of the bucket (the text that
shares most keys overall), not g * g: texts that link join a component, and only texts of
different components still have to meet. Small buckets give those pairs at once. The texts of
large ones are dealt anew, by their rarest shingles: similar texts have one of so many in
common, and its place in both tells which sizes can still meet; see :func:`_Linker._places`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymeter.llm.bloom import split
from waymeter.llm.common import arrow_rows, fold, mix, packed, release, row_chunks, stored, texts, unpacked, word_bounds, word_hashes
from waymeter.llm.graph import components
from waymeter.session import work_folder

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
EMPTY = np.uint16(0xFFFF)
#: Share of register pairs that agree by chance, over 2**MANTISSA, for sets of equal size.
CHANCE = 0.16992
#: A linked pair is missed by all bands with at most this probability.
MISS = 1e-8
#: The estimate may fall so far below the threshold: about six standard errors of 256 registers.
SLACK = 0.15
#: Open buckets up to this size give every pair of different components; texts of larger ones are dealt anew.
SMALL = 32
#: Cells, by leading bits, in which elements are counted to order them by rarity.
CELL_BITS = 18
#: Rows of an Arrow batch; each may bring two sets of some kilobytes.
BATCH_ROWS = 1000

SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)
SET = T.StructType([T.StructField("own_id", T.BinaryType()), T.StructField("registers", T.BinaryType()), T.StructField("shingles", T.BinaryType())])


def band_rows(threshold: float) -> int:
    """The most registers a band may have so that MISS holds at the threshold."""
    return max(r for r in range(1, 9) if r == 1 or (1 - threshold**r) ** (BUCKETS // r) <= MISS)


def shingle_sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each row, as uint64 arrays.

    A-Z are lower-cased; fewer words than ``size`` make one shingle; no words make none.
    """
    data, offsets = texts(column)
    factors = mix(np.arange(1, size + 2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for low, high in row_chunks(offsets):
        part = fold(data[offsets[low] : offsets[high]])
        starts, ends, rows = word_bounds(part, offsets[low : high + 1] - offsets[low])
        hashes = word_hashes(part, starts, ends)
        bounds = np.searchsorted(rows, np.arange(high - low + 1))
        sums = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for i in range(size):
            sums += hashes[i : i + len(sums)] * factors[i]
        sums = mix(sums + factors[size])
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= size:
                yield np.unique(sums[a : b - size + 1])
            elif b > a:
                whole = (hashes[a:b] * factors[: b - a]).sum() + np.uint64(b - a)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct hashes."""
    found = np.full(BUCKETS, EMPTY, np.uint16)
    if len(hashes):
        buckets = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
        # sorted, so the first hash of a bucket is its smallest
        rest = (hashes[heads] << np.uint64(BUCKET_BITS)) | np.uint64(1 << (BUCKET_BITS - 1))
        zeros = np.uint64(64) - np.frexp(rest.astype(np.float64))[1].astype(np.uint64)
        mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
        found[buckets[heads]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    return found


def _orders() -> np.ndarray:
    """For each bucket an order of all buckets in which an empty one looks for a value."""
    cells = np.arange(BUCKETS * BUCKETS, dtype=np.uint64).reshape(BUCKETS, BUCKETS)
    return np.argsort(mix(cells + np.uint64(0x9E3779B97F4A7C15)), axis=1)


def filled(found: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Registers with the empty ones filled from others, so that small sets band like large ones."""
    empty = np.flatnonzero(found == EMPTY)
    if not len(empty) or len(empty) == BUCKETS:
        return found
    used = found != EMPTY
    out = found.copy()
    for width in (16, BUCKETS):
        choice = used[orders[empty, :width]]
        first = choice.argmax(axis=1)
        done = choice[np.arange(len(empty)), first]
        out[empty[done]] = found[orders[empty[done], first[done]]]
        empty = empty[~done]
        if not len(empty):
            break
    return out


def band_keys(full: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` registers."""
    bands = BUCKETS // rows
    grouped = full[: bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, i])
    return key.view(np.int64)


def sketcher(size: int, rows: int):
    @F.arrow_udf(SKETCH)
    def sketch(column: pa.Array) -> pa.Array:
        orders = _orders()
        n, ids, keys = [], [], []
        for hashes in shingle_sets(column, size):
            found = registers(hashes)
            n.append(len(hashes))
            ids.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            keys.append(band_keys(filled(found, orders), rows) if len(hashes) else [])
        arrays = [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, fields=[pa.field(f.name, a.type) for f, a in zip(SKETCH.fields, arrays)])

    return sketch


PLACES = T.ArrayType(T.StructType([T.StructField("element", T.LongType()), T.StructField("most", T.LongType())]))


def _cell(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def element_counts(sets: DataFrame) -> np.ndarray:
    """How often elements fall into each of a fixed number of cells, summed in each task first."""

    def count(batches):
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.bincount(_cell(np.frombuffer(x, np.uint64)), minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["cell", "n"])

    found = np.zeros(1 << CELL_BITS, np.int64)
    # as many rows as cells at most
    for row in sets.select("shingles").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        found[row.cell] = row.n
    return found


def places_of(percent: int, counts: np.ndarray):
    """The rarest elements of a set, each with the size of the largest set that can be similar and have it as the first in common.

    All sets are in one order, by how full an element's cell is; shingles of frequent passages come last. If
    sets x, y have their first common element after p elements of x, they have at most |x| - p in
    common, and similar ones have t / (1 + t) * (|x| + |y|) at least. As |y| >= t * |x|, places
    after the first (1 - t) * |x| need not be looked at.
    """

    @F.arrow_udf(PLACES)
    def places(sets: pa.Array) -> pa.Array:
        elements, most, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [0]
        for x in sets.to_pylist():
            x = np.frombuffer(x, np.uint64)
            n, width = len(x), (100 - percent) * len(x) // 100 + 1
            x = x[np.lexsort((x, counts[_cell(x)]))[:width]]
            elements.append(x.view(np.int64))
            most.append(((100 + percent) * (n - np.arange(len(x))) - percent * n) // percent)
            ends.append(ends[-1] + len(x))
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(elements)), pa.array(np.concatenate(most))], ["element", "most"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return places


@F.arrow_udf(T.DoubleType())
def estimate(regs_a: pa.Array, regs_b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
    """Jaccard similarity by equal registers, corrected for those equal by chance."""
    if not len(regs_a):
        return pa.array([], pa.float64())
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, BUCKETS) for x in (regs_a, regs_b))
    sizes = np.asarray(n_a, float), np.asarray(n_b, float)
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    ratio = sizes[0] / sizes[1]
    chance = CHANCE / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return pa.array((equal / used - chance) / (1 - chance))


@F.arrow_udf(T.LongType())
def common(set_a: pa.Array, set_b: pa.Array) -> pa.Array:
    """The size of the intersection of two sorted sets."""
    pairs = zip(set_a.to_pylist(), set_b.to_pylist())
    return pa.array([len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), True)) for a, b in pairs], pa.int64())


class _Linker:
    """The search for links between classes of texts that have one set."""

    def __init__(self, classes: DataFrame, docs: DataFrame, size: int, percent: int):
        # classes: rep (a number of its own), first (its smallest document id), set_id, n, keys
        self.classes, self.docs, self.size, self.percent = classes, docs, size, percent
        self.links = self.tested = self.labels = None
        self.folders: dict[str, str] = {}

    def run(self) -> DataFrame | None:
        bucket = self._shared(self.classes.select("rep", F.explode("keys").alias("key")))
        if bucket.isEmpty():
            return None
        self.near = self._with_sets(bucket)
        self._verify(self._hub_pairs(bucket))
        open_ = self._open(bucket)
        pairs = self._cross_pairs(open_.filter(F.col("size") <= SMALL))
        large = stored(open_.filter(F.col("size") > SMALL).select("rep").distinct(), "large")
        if not large.isEmpty():
            places = self._places(large)
            self._verify(self._first_pairs(places))
            pairs = pairs.unionByName(self._place_pairs(places)).distinct()
        self._verify(pairs)
        return self.labels

    def _shared(self, bucket: DataFrame) -> DataFrame:
        """Members of keys that two classes or more share, with the size of the bucket."""
        sizes = stored(bucket.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
        return stored(bucket.join(sizes, "key"), "members")

    def _with_sets(self, bucket: DataFrame) -> DataFrame:
        """Sketch and full set, made again from the text, of the classes that have company at all."""
        size = self.size

        @F.arrow_udf(SET)
        def sets_of(column: pa.Array) -> pa.Array:
            sets = list(shingle_sets(column, size))
            ids = pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary())
            drawn = pa.array([registers(x).tobytes() for x in sets], pa.binary())
            return pa.StructArray.from_arrays([ids, drawn, pa.array([x.tobytes() for x in sets], pa.binary())], ["own_id", "registers", "shingles"])

        near = self.classes.drop("keys").join(bucket.select("rep").distinct(), "rep", "left_semi")
        near = stored(near, "wanted")
        # the filter lets few other texts pass; their sets find no partner in the join below, so no text is shuffled
        wanted = stored(near.select(F.col("first").alias("_of")).distinct(), "wanted-ids")
        rows, _ = split(self.docs, F.col("_id"), wanted, "_of")
        sets = rows.select(F.col("_id").alias("_of"), sets_of("_text").alias("s")).select("_of", "s.*")
        # a document id may have several texts: the set is told by its digest; null-safe, as a test for null would make all sets
        both = near.join(sets, (F.col("first") == F.col("_of")) & F.col("set_id").eqNullSafe(F.col("own_id")))
        both = stored(both.select("rep", "n", "registers", "shingles"), "near")
        if both.count() > near.count():
            # equal rows have one set
            both = stored(both.dropDuplicates(["rep"]), "near")
        release(self.docs.sparkSession)
        return both

    def _hub_pairs(self, bucket: DataFrame) -> DataFrame:
        weight = bucket.groupBy("rep").agg(F.sum("size").alias("weight"))
        weighed = stored(bucket.join(weight, "rep"), "weighed")
        hubs = stored(weighed.groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub")), "hubs")
        return _ordered(weighed.join(hubs, "key"), F.col("rep"), F.col("hub"))

    def _labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("component", F.col("rep"))
        return rows.join(self.labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def _open(self, bucket: DataFrame) -> DataFrame:
        """Members, with their component, of buckets that still hold more than one."""
        # two members have met their hub
        labelled = stored(self._labelled(bucket.filter("size > 2")), "labelled")
        mixed = stored(labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key"), "open")
        return stored(labelled.join(mixed, "key"), "open")

    def _cross_pairs(self, bucket: DataFrame) -> DataFrame:
        left = bucket.select("key", F.col("rep").alias("a"), F.col("component").alias("of_a"))
        right = bucket.select("key", F.col("rep").alias("b"), F.col("component").alias("of_b"))
        return _ordered(left.join(right, "key").filter("of_a < of_b"), F.col("a"), F.col("b"))

    def _places(self, large: DataFrame) -> DataFrame:
        """The rarest elements of each set, if another set has them too: (element, rep, n, most), see :func:`places_of`."""
        rows = stored(self.near.select("rep", "n", "shingles").join(large, "rep", "left_semi"), "crowded")
        places = places_of(self.percent, element_counts(rows))
        return self._meeting(rows.select("rep", "n", F.inline(places("shingles"))))

    def _meeting(self, places: DataFrame) -> DataFrame:
        """Places whose element is at a place of a set of another component as well."""
        labelled = stored(self._labelled(places), "places")
        mixed = labelled.groupBy("element").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("element")
        return stored(labelled.join(stored(mixed, "elements"), "element"), "places")

    def _first_pairs(self, places: DataFrame) -> DataFrame:
        """Each set with the one of like size that has the least before their common element: most links are found so."""
        places = places.withColumn("sizes", F.floor(F.log("n") / np.log(100 / self.percent)))
        hubs = stored(places.groupBy("element", "sizes").agg(F.max_by("rep", F.struct("most", -F.col("rep"))).alias("hub")), "hubs")
        return _ordered(places.join(hubs, ["element", "sizes"]), F.col("rep"), F.col("hub"))

    def _place_pairs(self, places: DataFrame) -> DataFrame:
        """All pairs of different components that can be similar with this element as the first in common."""
        rows = self._meeting(places.drop("component"))
        side = lambda tag: rows.select("element", *[F.col(c).alias(f"{c}_{tag}") for c in ("rep", "n", "most", "component")])
        both = side("a").join(side("b"), "element").filter("component_a < component_b AND n_a <= most_b AND n_b <= most_a")
        return _ordered(both.filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")), F.col("rep_a"), F.col("rep_b"))

    def _kept(self, pairs: DataFrame, name: str) -> DataFrame:
        """All pairs of one name so far, in one table: plans stay as small as in the first round."""
        path = self.folders.setdefault(name, work_folder(self.docs.sparkSession, f"llm-all-{name}"))
        pairs.write.mode("append").parquet(path)
        return self.docs.sparkSession.read.schema(pairs.schema).parquet(path)

    def _verify(self, pairs: DataFrame) -> None:
        """Test pairs not tested yet; links are kept, and components formed anew."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        side = lambda tag, *more: self.near.select(*[F.col(c).alias(f"{c}_{tag}") for c in ("rep", "n", *more)])
        pairs = stored(pairs, "pairs")
        self.tested = self._kept(pairs, "tested")
        at = lambda tag: F.col(tag) == F.col(f"rep_{tag}")
        sized = pairs.join(side("a"), at("a")).join(side("b"), at("b"))
        # sizes alone rule out most pairs, before any sketch is moved
        sized = sized.filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).select("a", "b")
        sized = stored(sized, "sized")
        if sized.isEmpty():
            return
        drawn = sized.join(side("a", "registers"), at("a")).join(side("b", "registers"), at("b"))
        likely = estimate("registers_a", "registers_b", "n_a", "n_b") >= self.percent / 100 - SLACK
        # few registers say little: small sets go to verification at once
        drawn = drawn.filter((F.least("n_a", "n_b") < BUCKETS) | likely).select("a", "b")
        chosen = stored(drawn, "likely")
        full = chosen.join(side("a", "shingles"), at("a")).join(side("b", "shingles"), at("b"))
        full = full.withColumn("both", common("shingles_a", "shingles_b"))
        found = full.filter(100 * F.col("both") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")
        found = stored(found, "links")
        if found.isEmpty():
            return
        self.links = self._kept(found, "links")
        self.labels = components(self.links)


def _ordered(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a != b").distinct()


def _one_document(rows: DataFrame, classes: DataFrame, links: DataFrame | None, labels: DataFrame | None) -> DataFrame | None:
    """Labels with the classes joined that hold texts of one and the same document id."""
    several = rows.groupBy("_id").agg(F.min("set_id").alias("least"), F.max("set_id").alias("most")).filter("least != most")
    several = stored(several.select("_id", "least"), "repeated")
    if several.isEmpty():
        return labels
    number = classes.select("set_id", "rep")
    ties = rows.select("_id", "set_id").join(several, "_id").select("set_id", "least").distinct()
    ties = ties.join(number.withColumnRenamed("rep", "a"), "set_id").join(number.select(F.col("set_id").alias("least"), F.col("rep").alias("b")), "least")
    ties = ties.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
    return components(stored(ties if links is None else ties.unionByName(links), "ties"))


def find_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept`` (one document of each group).

    Two texts are linked when 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles, and a group is what links connect; its id is the smallest
    ``doc_id`` in it. A null or empty text, or one without words, has an empty set and links
    with nothing. A row without ``doc_id`` links with nothing either, has no group and is
    kept. ``doc_id`` names a document: rows that repeat it are in one group, and those with
    equal texts are one.
    Columns of ``docs`` with the name of a result column are replaced.

    Rows are stored once with their sketch; ``keep_text=False`` leaves the text out of that
    table and of the result.
    """
    rows = packed(docs)
    source = rows.select(F.col(f"_row.`{doc_id}`").alias("_id"), F.col(f"_row.`{text}`").alias("_text"))
    sketch = sketcher(size, band_rows(percent / 100))
    row = F.col("_row") if keep_text else F.col("_row").dropFields(f"`{text}`")
    drawn = rows.withColumn("s", sketch(F.col(f"_row.`{text}`"))).select(row.alias("_row"), F.col(f"_row.`{doc_id}`").alias("_id"), "s.*")
    release(docs.sparkSession)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        drawn = stored(drawn, "sketches")
        named_rows = drawn.filter("n > 0 AND _id IS NOT NULL")
        alike = named_rows.groupBy("set_id").agg(F.min("_id").alias("first"), *[F.first(c).alias(c) for c in ("n", "keys")])
        classes = stored(alike.withColumn("rep", F.monotonically_increasing_id()), "classes")
        linker = _Linker(classes, source, size, percent)
        labels = linker.run()
        labels = _one_document(named_rows, classes, linker.links, labels)
        named = classes.select("set_id", "rep", "first")
        if labels is not None:
            named = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("rep", F.coalesce("component", "rep"))
        group = named.groupBy("rep").agg(F.min("first").alias("_group"))
        named = stored(named.join(group, "rep").select(F.col("set_id").alias("_of"), "_group"), "named")
        release(docs.sparkSession)
    joined = drawn.select("_row", "_id", "n", "set_id").join(named, F.col("set_id") == F.col("_of"), "left")
    group = F.when(F.col("n") > 0, F.col("_group")).otherwise(F.col("_id"))
    group = F.when(F.col("_id").isNotNull(), group)
    kept = F.coalesce(F.col("_id") == group, F.lit(True))
    return unpacked(joined, docs if keep_text else docs.drop(text), {"n_shingles": F.col("n"), "component_id": group, "kept": kept})
