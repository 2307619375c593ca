"""The prefix trie of rebuilt conversations, by composable fingerprints.

A conversation is rebuilt from the head of its base and its own later turns. The text of a
rebuilt conversation never exists. The fingerprint of a sequence is the pair of its length
and, in four lanes, the sum of turn hash times ``r`` to the place of the turn, modulo a
prime. Such pairs form a monoid: (m, x) * (n, y) = (m + n, x + r^m y), and differences undo a
prefix. So the fingerprint of any rebuilt prefix follows from three prefixes of original
conversations: the base's head, the own prefix, and the own head taken off again.

Equal fingerprints make a node. Its members must agree in their last turn, by content id,
and in their parent; content ids are held against the stored turns byte by byte. Should
a fingerprint ever stand for two sequences, the trie is built again from other factors.

Sums over subtrees take no walk through the levels. The smallest member of a node owns it, and
what a conversation owns is the lower end of its path. So a subtree's sum is the sum over
its members of what each owns, corrected for the one that owns the node itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from waymeter.llm.common import mix, stored
from waymeter.operators.keyed import union_all

PRIME, LANES = (1 << 31) - 1, 4
#: Conversations in a row of which the first is the base, and the modulus of the head's length.
BASE, HEADS = 5, 9
#: Nodes of one owner that are summed in one window; sums of blocks carry over.
BLOCK = 4096
KEY = ["depth", "a", "b"]


def factors(seed: int) -> list[int]:
    """The base r of each lane."""
    drawn = mix(np.arange(1, LANES + 1, dtype=np.uint64) + np.uint64(seed * LANES))
    return [int(x) % (PRIME - 2) + 2 for x in drawn]


def _powers(bases: list[int], exponents: np.ndarray) -> np.ndarray:
    """Powers of every base modulo PRIME, by squaring; one row per exponent."""
    out = np.ones((len(exponents), LANES), np.uint64)
    square = np.array(bases, np.uint64)
    left = exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % np.uint64(PRIME)
        square = square * square % np.uint64(PRIME)
        left = left >> np.uint64(1)
    return out


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * LANES
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64).ravel()))


def turn_terms(bases: list[int]):
    """Hash of a turn times r to its place, in each lane; the hash is never 0."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def terms(x: pa.Array, y: pa.Array, place: pa.Array) -> pa.Array:
        x, y = (np.asarray(v).astype(np.uint64) for v in (x, y))
        hashes = np.stack([mix(mix(x + np.uint64(i + 1)) ^ y) for i in range(LANES)], axis=1) % np.uint64(PRIME - 1) + np.uint64(1)
        return _lists(hashes * _powers(bases, np.asarray(place)) % np.uint64(PRIME))

    return terms


def powers_of(bases: list[int]):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def powers(exponent: pa.Array) -> pa.Array:
        return _lists(_powers(bases, np.asarray(exponent)))

    return powers


def _lanes(make) -> Column:
    return F.array(*[F.pmod(make(i), F.lit(PRIME)) for i in range(LANES)])


def _zeros() -> Column:
    return F.array(*[F.lit(0).cast("bigint")] * LANES)


def _packed(lanes: Column, first: int) -> Column:
    return lanes[first] * F.lit(1 << 31) + lanes[first + 1]


def read_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns with content ids, and the same in order: pieces of conversations that follow each other.

    The order comes from ranges of (conversation, turn, role, text), so one conversation with
    very many turns is spread over tasks.
    """
    name = lambda c: F.col(f"`{c}`")
    turns = conversations.filter(name(conv_id).isNotNull()).select(
        name(conv_id).cast("bigint").alias("conv"), name(turn).alias("turn"),
        F.coalesce(name(role), F.lit("")).alias("role"), F.coalesce(name(text), F.lit("")).alias("text"),
    )
    sha = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    part = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("bigint")
    turns = turns.withColumn("sha", sha).select("*", part(1).alias("x"), part(16).alias("y"), F.octet_length("text").cast("bigint").alias("bytes")).drop("sha")
    order = ["conv", "turn", "role", "text"]
    sorted_ = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    light = sorted_.select("conv", "x", "y", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    return turns, stored(light, "turns")


def content_clashes(turns: DataFrame) -> DataFrame:
    """Content ids that stand for different turns; compared by bytes, copies collapse in each task."""
    return turns.groupBy("x", "y", "role", "text").agg(F.count(F.lit(1)).alias("n")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def prefixes(light: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the prefixes of original conversations, and their lengths.

    Each piece sums its own turns; what came before enters by the monoid.
    """
    bases = factors(seed)
    local = Window.partitionBy("part", "conv").orderBy("at")
    rows = light.withColumn("place", F.row_number().over(local).cast("bigint"))
    rows = rows.withColumn("t", turn_terms(bases)("x", "y", F.col("place") - 1))
    sums = [F.sum(F.col("t")[i]).over(local.rowsBetween(Window.unboundedPreceding, 0)).alias(f"s{i}") for i in range(LANES)]
    rows = stored(rows.select("*", *sums).drop("at"), "sums")
    pieces = rows.groupBy("part", "conv").agg(F.max("place").alias("n"), F.max(F.struct("place", *[f"s{i}" for i in range(LANES)])).alias("total"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pieces = pieces.withColumn("p", powers_of(bases)("offset"))
    ahead = lambda i: F.coalesce(F.sum(F.pmod(F.col("total")[f"s{i}"], F.lit(PRIME)) * F.col("p")[i] % F.lit(PRIME)).over(before), F.lit(0))
    pieces = stored(pieces.select("part", "conv", "n", "offset", "p", _lanes(ahead).alias("ahead")), "pieces")
    joined = rows.join(pieces.drop("n"), ["part", "conv"])
    whole = lambda of: _lanes(lambda i: F.col("ahead")[i] + F.pmod(of(i), F.lit(PRIME)) * F.col("p")[i])
    found = joined.select(
        "conv", (F.col("offset") + F.col("place")).alias("pos"), "x", "y", "bytes",
        whole(lambda i: F.col(f"s{i}")).alias("lanes"), whole(lambda i: F.col(f"s{i}") - F.col("t")[i]).alias("before"),
    )
    return stored(found, "prefixes"), pieces.groupBy("conv").agg(F.sum("n").alias("n"))


def rebuilt(found: DataFrame, lengths: DataFrame, seed: int) -> DataFrame:
    """One row per rebuilt conversation and depth, with the key of its node and of the node above."""
    head = F.sort_array(F.collect_list(F.struct("pos", "lanes", "before", "x", "y", "bytes")))
    # HEADS - 1 turns at most
    heads = stored(found.filter(F.col("pos") < HEADS).groupBy("conv").agg(head.alias("head")), "heads")
    convs = lengths.select(
        "conv", "n", (F.col("conv") - F.col("conv") % BASE).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")
    )
    convs = convs.join(heads.select("conv", F.col("head").alias("own")), "conv").join(heads.select(F.col("conv").alias("base"), "head"), "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")))
    convs = convs.withColumn("k", F.size("head").cast("bigint"))
    lanes_at = lambda turns, n: F.when((n > 0) & (n <= F.size(turns)), F.get(F.col(turns), (n - 1).cast("int"))["lanes"]).otherwise(_zeros())
    shift = [F.lit(pow(r, e, PRIME)) for r in factors(seed) for e in range(1 - HEADS, HEADS)]
    width = 2 * HEADS - 1
    convs = convs.select(
        "conv", "h", "k", "head", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        lanes_at("head", F.col("k")).alias("base_lanes"), lanes_at("own", F.col("h")).alias("own_lanes"),
    )
    convs = stored(convs, "rebuilt")
    key = lambda lanes, a, b: [_packed(lanes, 0).alias(a), _packed(lanes, 2).alias(b)]
    none = F.lit(0).cast("bigint")
    root = convs.select("conv", none.alias("depth"), *[none.alias(c) for c in ("a", "b", "above_a", "above_b", "x", "y", "bytes")], (F.col("length") == 0).alias("last"))
    of_base = convs.select("conv", "length", F.explode("head").alias("t")).select(
        "conv", F.col("t.pos").alias("depth"), *key(F.col("t.lanes"), "a", "b"), *key(F.col("t.before"), "above_a", "above_b"),
        "t.x", "t.y", "t.bytes", (F.col("t.pos") == F.col("length")).alias("last"),
    )
    own = found.join(convs.drop("head"), "conv").filter("pos > h")
    power = lambda i: F.get(F.array(*shift[i * width : (i + 1) * width]), (F.col("k") - F.col("h") + HEADS - 1).cast("int"))
    moved = lambda lanes: _lanes(lambda i: F.col("base_lanes")[i] + F.pmod(F.col(lanes)[i] - F.col("own_lanes")[i], F.lit(PRIME)) * power(i))
    own = own.select("*", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), moved("lanes").alias("to"), moved("before").alias("from"))
    own = own.select("conv", "depth", *key(F.col("to"), "a", "b"), *key(F.col("from"), "above_a", "above_b"), "x", "y", "bytes", (F.col("depth") == F.col("length")).alias("last"))
    return stored(union_all([root, of_base, own]), "paths")


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of each key. A hash of one sequence cannot be cut, so it
    reads its rows in order, one batch at a time, and holds none of them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([*[(c, pa.int64()) for c in KEY], ("ends_sha256", pa.string())])
        now, running = None, None
        for batch in batches:
            out = []
            for *key, conv in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if key != now:
                    if now is not None:
                        out.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256(str(conv).encode())
                else:
                    running.update(f",{conv}".encode())
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, row)) for row in out], shape)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, (*now, running.hexdigest())))], shape)

    rows = ends.select(*KEY, "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv")
    return rows.mapInArrow(digest, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _nodes(paths: DataFrame) -> tuple[DataFrame, bool]:
    """Nodes with members and owner, and whether every group agrees in its last turn and its parent."""
    same = lambda c: F.min(c) == F.max(c)
    agreed = same("above_a") & same("above_b") & same("x") & same("y")
    nodes = paths.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("owner"), F.max("bytes").alias("bytes"),
        F.max("above_a").alias("above_a"), F.max("above_b").alias("above_b"), agreed.alias("agreed"),
    )
    nodes = stored(nodes, "nodes")
    return nodes, nodes.filter("NOT agreed").isEmpty()


def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (of the parent; null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself
    included), ``saved_tokens`` (over the subtree, members beyond the first times bytes of
    the last text) and ``ends_sha256`` (of the members that end here).

    Turns are ordered by number, null first; of one number by role and text. A null role or text is
    empty. Rows without ``conv_id`` belong to no conversation. Repeated rows are turns of their
    own. An empty table has no nodes, not even a root. Other columns are not read.
    """
    turns, light = read_turns(conversations, conv_id, turn, role, text)
    if not content_clashes(turns).isEmpty():
        raise ValueError("two turns have one content id")
    for seed in count():
        paths = rebuilt(*prefixes(light, seed), seed)
        nodes, sound = _nodes(paths)
        if sound:
            break
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b"))
    nodes = nodes.drop("agreed").join(children.agg(F.count(F.lit(1)).alias("n_children")), KEY, "left")
    nodes = nodes.fillna(0, ["n_children"]).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = stored(nodes.withColumn("block", F.floor(F.col("depth") / BLOCK)), "children")

    # what a conversation owns: its total, the top of it, and whether it ends in a leaf
    blocks = nodes.groupBy("owner", "block").agg(
        F.sum("saved").alias("total"), F.min("depth").alias("top"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves")
    )
    below = Window.partitionBy("owner").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(blocks.withColumn("below", F.coalesce(F.sum("total").over(below), F.lit(0))), "blocks")
    owned = stored(blocks.groupBy("owner").agg(F.sum("total").alias("total"), F.min("top").alias("top"), F.sum("leaves").alias("leaves")), "owned")
    in_block = Window.partitionBy("owner", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.join(blocks.select("owner", "block", "below"), ["owner", "block"])
    nodes = nodes.withColumn("own_sum", F.col("below") + F.sum("saved").over(in_block))
    nodes = nodes.join(owned.select("owner", F.col("total").alias("own_total"), "top"), "owner")
    shares = paths.select("conv", *KEY).join(owned.select(F.col("owner").alias("conv"), "total", "leaves"), "conv")
    shares = shares.groupBy(*KEY).agg(F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"))

    # only the top of what a conversation owns has a parent with another owner
    nodes = stored(nodes, "owners")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"), F.col("owner").alias("above_owner"))
    tops = nodes.filter("depth = top AND depth > 0").select(*KEY, "above_a", "above_b").join(above, ["depth", "above_a", "above_b"])
    parent = F.when(F.col("depth") > F.col("top"), F.col("owner")).otherwise(F.col("above_owner"))
    joined = nodes.join(shares, KEY).join(tops.select(*KEY, "above_owner"), KEY, "left").join(ends_digest(paths.filter("last")), KEY, "left")
    return joined.select(
        F.col("owner").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("own_sum") + F.col("total") - F.col("own_total")).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
