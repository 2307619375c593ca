"""Ranked lexical search through classes of equal bags.

Only terms of the items can add to a score. So each document is cut down to its bag: the
terms of the items' vocabulary that it holds, with their counts. Documents with one bag and
one length factor form a class: they are found by a hash, compared by bytes, and scored
once. The best classes of an item hold its best documents; they are expanded to members
last. Items are taken in blocks, whose vocabulary is bounded by ``BLOCK_BYTES``; each block
meets all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from waymeter.llm.common import fold, row_chunks, stored, texts, word_bounds, word_hashes
from waymeter.operators.keyed import union_all

#: Bytes of item text, and items, of a block: together they bound what tasks hold of the query set.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 17, 256
#: Cells of a dense block of documents by terms.
CELLS = 1 << 21
#: Candidates that a task holds before it cuts them back to the best.
MOST_CANDIDATES = 1 << 18
LAST = 2**63 - 1

# terms are runs of digits, letters and everything beyond ASCII
_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
_BREAKS[48:58] = _BREAKS[65:91] = _BREAKS[97:123] = False

BAG = T.StructType([T.StructField("n", T.LongType()), T.StructField("bag", T.BinaryType())])
CANDIDATE = "item bigint, class binary, first bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order."""
    data = fold(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8))
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), _BREAKS)
    return [data[a:b].tobytes() for a, b in zip(starts, ends)]


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    return np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends


def bag_maker(vocabulary: list[bytes]):
    """Terms of a text, and its bag: (term, count) pairs of int32 by ascending term."""

    @F.arrow_udf(BAG)
    def bags(column: pa.Array) -> pa.Array:
        data, offsets = texts(column)
        known, known_starts, known_ends = _joined(vocabulary)
        known_hashes = word_hashes(known, known_starts, known_ends)
        order = np.argsort(known_hashes)
        sorted_hashes = known_hashes[order]
        counts, ends, pairs = [np.empty(0, np.int64)], [np.zeros(1, np.int64)], []
        for low, high in row_chunks(offsets):
            part = fold(data[offsets[low] : offsets[high]])
            starts, stops, rows = word_bounds(part, offsets[low : high + 1] - offsets[low], _BREAKS)
            counts.append(np.bincount(rows, minlength=high - low).astype(np.int64))
            of_row = np.zeros(high - low, np.int64)
            if len(starts) and len(vocabulary):
                hashes = word_hashes(part, starts, stops)
                at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(order) - 1)
                term = order[at]
                hit = np.flatnonzero((sorted_hashes[at] == hashes) & (stops - starts == (known_ends - known_starts)[term]))
                hit = hit[_same(part, starts[hit], known, known_starts[term[hit]], (stops - starts)[hit])]
                cells, n = np.unique(rows[hit] * len(vocabulary) + term[hit], return_counts=True)
                of_row = np.bincount(cells // len(vocabulary), minlength=high - low).astype(np.int64)
                pairs.append(np.stack((cells % len(vocabulary), n), axis=1).astype("<i4"))
            ends.append(ends[-1][-1] + np.cumsum(of_row))
        data = np.concatenate(pairs).tobytes() if pairs else b""
        bounds = (np.concatenate(ends) * 8).astype(np.int32)
        bag = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        return pa.StructArray.from_arrays([pa.array(np.concatenate(counts)), bag], ["n", "bag"])

    return bags


def _same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether words of one length are equal byte by byte."""
    if not len(lengths):
        return np.zeros(0, bool)
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    return np.logical_and.reduceat(a[place + np.repeat(a_starts, lengths)] == b[place + np.repeat(b_starts, lengths)], heads)


def document_counts(bags: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term, summed in each task first; as long as the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for bag in batch.column(0).to_pylist():
                total[np.frombuffer(bag, "<i4")[::2]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    found = np.zeros(terms, np.int64)
    summed = bags.select("bag").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for row in summed.collect():
        found[row.term] = row.df
    return found


def class_scorer(matrix: np.ndarray, k: int):
    """The best classes of each item in a partition: score first, then the smallest first document."""
    terms, items = matrix.shape

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(8, CELLS // max(1, terms))
        least = np.ones(items)
        held = [np.empty(0, np.int64), np.empty(0, object), np.empty(0, np.int64), np.empty(0, np.float64)]

        def cut() -> None:
            item, _, first, value = held
            order = np.lexsort((first, -value, item))
            bounds = np.searchsorted(item[order], np.arange(items + 1))
            rank = np.arange(len(order)) - bounds[item[order]]
            held[:] = [x[order][rank < k] for x in held]
            full = np.flatnonzero(np.bincount(held[0], minlength=items) >= k)
            least[full] = held[3][np.searchsorted(held[0], full, "right") - 1]

        for batch in batches:
            vectors, names, firsts = batch.column(1).to_pylist(), np.array(batch.column(0).to_pylist(), object), np.asarray(batch.column(2))
            for at in range(0, len(vectors), rows):
                dense = np.zeros((min(rows, len(vectors) - at), terms))
                for i, vector in enumerate(vectors[at : at + rows]):
                    m = int.from_bytes(vector[:8], "big", signed=True)
                    pairs = np.frombuffer(vector, "<i4", offset=8).reshape(-1, 2).astype(np.int64)
                    dense[i, pairs[:, 0]] = (1_000_000_000 * pairs[:, 1]) // (1000 * pairs[:, 1] + 12 * m)
                # whole numbers far below 2**53: products and sums of doubles are exact
                found = dense @ matrix
                doc, item = np.nonzero(found >= least)
                new = (item, names[at + doc], firsts[at + doc], found[doc, item])
                held[:] = [np.concatenate(x) for x in zip(held, new)]
                if len(held[0]) > MOST_CANDIDATES:
                    cut()
        cut()
        columns = [pa.array(held[0], pa.int64()), pa.array(list(held[1]), pa.binary()), pa.array(held[2], pa.int64()), pa.array(held[3].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "class", "first", "score"])

    return score


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    Terms are runs of digits, ASCII letters and all characters beyond ASCII, with A-Z
    lower-cased; a null or empty text has none. The weight of a term is
    floor(1000 ln((2N + 2) / (2 df + 1))), and a document scores the sum over the item's terms,
    repeats included, of weight * (10^9 tf div (1000 tf + 12 m)) with
    m = 75 + 25 n N div L. Only scores above 0 are listed; of equal scores the smaller
    ``doc_id`` comes first, null last. Each row of ``docs`` and of ``items`` counts by itself, also
    if it repeats an id. No items, or no documents with terms, give no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text"))
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    shape = T.StructType([T.StructField("item_id", asked.schema["item_id"].dataType), *T._parse_datatype_string("rank int, doc_id bigint, score bigint").fields])
    size, count = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(math.ceil(size / BLOCK_BYTES), math.ceil(count / BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    found = [_search_block(source, asked.filter(block == i).collect(), k, shape) for i in range(blocks)]
    found = [f for f in found if f is not None]
    return union_all(found) if found else spark.createDataFrame([], shape)


def _search_block(source: DataFrame, asked: list, k: int, shape: T.StructType) -> DataFrame | None:
    spark = source.sparkSession
    wanted = [Counter(terms_of(row.text)) for row in asked]
    vocabulary = sorted(set().union(*wanted)) if wanted else []
    place = {term: i for i, term in enumerate(vocabulary)}
    drawn = stored(source.withColumn("b", bag_maker(vocabulary)("_text")).select("_id", "b.*"), "bags")
    n_docs, n_terms = drawn.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not vocabulary:
        return None
    held = drawn.filter(F.octet_length("bag") > 0)
    df = document_counts(held, len(vocabulary))
    weights = np.floor([1000 * math.log((2 * n_docs + 2) / (2 * n + 1)) for n in df])
    matrix = np.zeros((len(vocabulary), len(asked)))
    for i, bag in enumerate(wanted):
        for term, times in bag.items():
            matrix[place[term], i] = times * weights[place[term]]

    # 8 bytes of m, then the bag: what a class has in common
    m = (F.lit(75) + F.expr(f"(25 * n * {n_docs}L) DIV {n_terms}L")).cast("bigint")
    vector = F.concat(F.unhex(F.lpad(F.hex(m), 16, "0")), F.col("bag"))
    members = held.select("_id", vector.alias("vector")).select("_id", "vector", F.unhex(F.sha2("vector", 256)).alias("class"))
    members = stored(members, "members")
    same = F.when(F.min("vector") == F.max("vector"), F.min("vector")).otherwise(F.raise_error(F.lit("two bags have one SHA-256")))
    classes = members.groupBy("class").agg(same.alias("vector"), F.coalesce(F.min("_id"), F.lit(LAST)).alias("first"))
    best = stored(classes.mapInArrow(class_scorer(matrix, k), CANDIDATE), "candidates")

    # the k best classes hold the k best documents, and of each class its k smallest ids are enough
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first")
    best = best.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).select("item", "class", "score")
    best = stored(best, "best")
    few = F.broadcast(best.select("class").distinct())  # k classes of BLOCK_ITEMS items or so
    in_class = Window.partitionBy("class").orderBy(F.col("_id").asc_nulls_last())
    smallest = members.select("class", "_id").join(few, "class", "left_semi").withColumn("at", F.row_number().over(in_class)).filter(F.col("at") <= k)
    listed = smallest.select("class", "_id").join(F.broadcast(best), "class")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("_id").asc_nulls_last()))
    ranked = listed.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(asked)], T.StructType([T.StructField("item", T.LongType()), shape["item_id"]]))
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("_id").alias("doc_id"), "score")
