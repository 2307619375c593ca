"""Personal data: base patterns, then terms that give protected entities away.

A value found by a base pattern is a protected entity. Over all different texts, the pointwise
mutual information of an entity and a term, divided by the information of the entity
itself, tells how much of the entity the term discloses: 1 if the term occurs only with
it. The share shrinks smoothly where few texts speak for it. A term above one threshold
is generalised and above a higher one removed, in whatever document it stands: where the
entity itself is missing the term still points to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from waymeter.llm.common import fold, packed, row_chunks, stored, texts, unpacked, word_bounds, word_hashes

#: Kinds in the order of ties.
KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
BASE = 4
#: Texts of doubt: a share counts n / (n + DOUBT) where n texts hold both entity and term.
DOUBT = 0.5
#: Shares of an entity's information from which a term is generalised or removed.
GENERALISE, REMOVE = 0.7, 0.9
#: Shorter terms, in bytes, are left alone.
LEAST_TERM = 3
#: Bytes of text whose terms are located at once.
LOCATED_BYTES = 1 << 18
#: Bits of the filter of rated terms that tasks hold: this many for each term, a power of two within the bounds.
FILTER_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("entity", T.StringType())]
)
TERM = T.StructType([T.StructField("term", T.LongType()), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("length", T.LongType())])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, which keeps long runs linear
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
#: Terms are runs of letters and digits, every byte over 127 counting as a letter.
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and domain, found from the ``@`` so that long runs stay linear."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of the kind, end, entity) of every match, in order."""
    spans = []
    if "@" in text:
        spans += [(a, 0, b, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            spans.append((m.start(), 1, m.end(), m.group()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _DIGITS.sub("", m.group())
            if 10 <= len(digits) <= 15:
                spans.append((m.start(), 3, m.end(), digits))
    return sorted(spans)


def base_of(column: pa.Array) -> pa.Array:
    """The base spans of each text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("entity", pa.string())]))
    rows = ([{"kind": KINDS[k], "start": a, "end": b, "entity": f"{KINDS[k]}:{e}"} for a, k, b, e in base_spans(text.as_py() or "")] for text in column)
    return pa.array(list(rows), kind)


find_base = F.arrow_udf(base_of, T.ArrayType(SPAN))


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, row, start and end of every term of some texts."""
    starts, ends, rows = word_bounds(data, offsets, _BREAKS)
    long_enough = ends - starts >= LEAST_TERM
    starts, ends, rows = starts[long_enough], ends[long_enough], rows[long_enough]
    return word_hashes(fold(data), starts, ends).view(np.int64), rows, starts, ends


def document_counts(docs: DataFrame, text: str) -> DataFrame:
    """(term, n): in how many documents each term of the corpus occurs.

    A task counts into arrays and sends one row for each term it saw, then counts add up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merge(parts):
            terms, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(terms, kind="stable")
            terms, n = terms[order], n[order]
            heads = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
            return terms[heads], np.add.reduceat(n, heads)

        parts, size = [], 0
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for low, high in row_chunks(offsets):
                part = data[offsets[low] : offsets[high]]
                terms, rows, *_ = _terms(part, offsets[low : high + 1] - offsets[low])
                if not len(terms):
                    continue
                # once for each document
                order = np.lexsort((rows, terms))
                terms, rows = terms[order], rows[order]
                new = np.concatenate(([True], (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])))
                found, n = np.unique(terms[new], return_counts=True)
                parts.append((found, n))
                size += len(found)
                if size > 1 << 21:
                    parts = [merge(parts)]
                    size = len(parts[0][0])
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], ["term", "n"])
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merge(parts)], ["term", "n"])

    partial = docs.select(text).mapInArrow(count, "term bigint, n bigint")
    return partial.groupBy("term").agg(F.sum("n").alias("n"))


def distinct_texts(docs: DataFrame, text: str, keys: DataFrame) -> DataFrame:
    """The texts of ``docs``, each once; only those that ``keys`` (_key, rows) has several rows of are grouped."""
    several = stored(keys.filter("rows > 1").select(F.col("_key").alias("_several")), "several")
    own = docs.select(F.col(f"`{text}`").alias(text), F.xxhash64(F.col(f"`{text}`")).alias("_own"))
    again = F.col("_own") == F.col("_several")
    once = own.join(several, again, "left_anti").select(F.col(f"`{text}`"))
    return once.unionAll(own.join(several, again, "left_semi").select(F.col(f"`{text}`")).distinct())


def located(column: pa.Array, spans: pa.Array, wanted=None) -> pa.Array:
    """The terms of each text outside its base spans, with their places in code points; only those with ``wanted`` hashes, if given."""
    kind = pa.list_(pa.struct([("term", pa.int64()), ("starts", pa.list_(pa.int64())), ("length", pa.int64())]))
    data, offsets = texts(column)
    out: list[list[dict]] = [[] for _ in range(len(column))]
    for low, high in row_chunks(offsets, LOCATED_BYTES):
        part = data[offsets[low] : offsets[high]]
        terms, rows, starts, ends = _terms(part, offsets[low : high + 1] - offsets[low])
        if wanted is not None:
            near = wanted(terms)
            terms, rows, starts, ends = terms[near], rows[near], starts[near], ends[near]
        if not len(terms):
            continue
        # bytes that begin a character, counted up to each place and from the start of its text
        chars = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
        begun = chars[offsets[low:high] - offsets[low]][rows]
        a, b = chars[starts] - begun, chars[ends] - begun
        cuts = np.searchsorted(rows, np.arange(high - low + 1))
        for row in np.flatnonzero(cuts[1:] > cuts[:-1]):
            own = slice(cuts[row], cuts[row + 1])
            found = spans[low + int(row)].as_py() or []
            t, x, y = terms[own], a[own], b[own]
            free = np.ones(len(t), bool)
            for s in found:
                free &= (y <= s["start"]) | (x >= s["end"])
            t, x, y = t[free], x[free], y[free]
            if not len(t):
                continue
            order = np.argsort(t, kind="stable")
            groups = np.split(order, np.flatnonzero(t[order][1:] != t[order][:-1]) + 1)
            out[low + row] = [{"term": int(t[g[0]]), "starts": x[g].tolist(), "length": int(y[g[0]] - x[g[0]])} for g in groups]
    return pa.array(out, kind)


@F.arrow_udf(T.ArrayType(TERM))
def find_terms(column: pa.Array, spans: pa.Array) -> pa.Array:
    """The terms of a text outside its base spans."""
    return located(column, spans)


def term_filter(rated: DataFrame):
    """An Arrow function from texts to base spans and those other terms whose bit some rated term sets.

    The bits are or-ed together by words of 64 before they reach the driver, so their size is bounded
    whatever the number of terms; a full filter only passes more to the exact join.
    """
    size = LEAST_BITS
    n = rated.count()
    while size < min(n * FILTER_BITS, MOST_BITS):
        size *= 2
    bit = F.col("of_term").bitwiseAND(F.lit(size - 1))
    words = rated.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(of_term & 63 AS int))").alias("bits"))
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = rated.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf(T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("near", T.ArrayType(TERM))]))
    def judged(column: pa.Array) -> pa.Array:
        own, spans = sent.value, base_of(column)
        near = located(column, spans, lambda terms: (own[(terms & (size - 1)) >> 6] >> (terms & 63)) & 1 == 1)
        return pa.StructArray.from_arrays([spans, near], ["spans", "near"])

    return judged


@F.arrow_udf(T.StringType())
def rewritten(column: pa.Array, spans: pa.Array) -> pa.Array:
    """The text with base spans replaced by their kind, generalised terms by ``[TERM]``, removed ones by nothing."""
    out = []
    for text, found in zip(column, spans.to_pylist()):
        text = text.as_py()
        if text is None or not found:
            out.append(text)
            continue
        parts, at = [], 0
        for s in found:
            if s["end"] <= at:
                continue
            parts.append(text[at : max(at, s["start"])])
            parts.append({"generalised": "[TERM]", "removed": ""}.get(s["kind"], f"[{s['kind'].upper()}]"))
            at = s["end"]
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def disclosing_terms(docs: DataFrame, text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(of_term, action): hashes of the terms that give an entity away, each once with its severest action.

    All counts are of different texts, so copies are no evidence. Pairs that cannot reach the
    threshold are dropped by exact bounds before terms and entities of a text meet.
    """
    own = docs.select(F.col(f"`{text}`").alias("_text")).withColumn("_spans", find_base("_text"))
    keyed = docs.select(F.xxhash64(F.col(f"`{text}`")).alias("_key"))
    keys = stored(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("rows")), "keys")
    n_docs = float(keys.count())
    held = own.filter(F.size("_spans") > 0).withColumn("_key", F.xxhash64("_text"))
    held = stored(stored(held, "held").dropDuplicates(["_key"]), "held-once")
    entities = F.explode(F.array_distinct(F.transform("_spans", lambda s: s["entity"]))).alias("entity")
    pairs = held.select(F.col("_key").alias("_owner"), entities)
    protected = pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # n / (n + DOUBT) is the most that n texts can show
    shown = lambda n: n / (n + F.lit(DOUBT))
    protected = stored(protected.filter(shown(F.col("n_entity")) >= generalise), "entities")
    owners = stored(pairs.join(protected, "entity"), "owners")
    counts = document_counts(distinct_texts(docs, text, keys), text).filter(shown(F.col("n")) >= generalise)
    with_text = held.join(owners.select("_owner").distinct(), F.col("_key") == F.col("_owner"), "left_semi")
    terms = with_text.select("_key", F.explode(find_terms("_text", "_spans")).alias("t")).select("_key", "t.term").join(counts, "term")
    # a term in n texts discloses at most log2(n_docs / n) bits of an entity in fewer
    bits = F.log2(n_docs / F.col("n_entity"))
    reachable = (F.col("_key") == F.col("_owner")) & (F.log2(n_docs / F.greatest("n", "n_entity")) >= generalise * bits - 1e-9)
    together = terms.join(owners, reachable).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"), F.first("n").alias("n"), F.first("n_entity").alias("n_entity"))
    gain = F.log2(n_docs * F.col("n_both") / (F.col("n_entity") * F.col("n")))
    share = shown(F.col("n_both")) * gain / F.nullif(bits, F.lit(0.0))
    action = F.when(share >= remove, "removed").when(share >= generalise, "generalised")
    rated = together.select(F.col("term").alias("of_term"), action.alias("action")).filter("action IS NOT NULL")
    return stored(rated.groupBy("of_term").agg(F.max("action").alias("action")), "rated")  # removed is the later word


def sanitise(
    docs: DataFrame, text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, entity; code points, end exclusive) and the ``sanitised`` text.

    Spans come by start, then in the order of KINDS. Base spans always stay; a term that discloses
    an entity is added wherever it stands outside base spans. Counts are of different texts, so copies of one text are no
    evidence, and a pair seen together in one text only stays below any threshold over 1 / (1 + DOUBT). A null text has no spans and
    stays null. Rows are numbered when they are stored, so repeated rows are treated alike; an empty table stays empty.
    ``keep_text=False`` leaves text and ``sanitised`` out. Columns of ``docs`` with the name
    of a result column are replaced.
    """
    rated = disclosing_terms(docs, text, generalise, remove)
    column = F.col(f"_row.`{text}`")
    rows = packed(docs).withColumn("_found", term_filter(rated)(column)).withColumn("_uid", F.monotonically_increasing_id())
    if not keep_text:
        rows = rows.withColumn("_row", F.col("_row").dropFields(f"`{text}`"))
    found = stored(rows.select("_row", "_uid", F.col("_found.spans").alias("_spans"), F.col("_found.near").alias("_near")), "spans")
    hit = found.select("_uid", F.explode("_near").alias("t")).select("_uid", "t.*").join(rated, F.col("term") == F.col("of_term"))
    spans = hit.select("_uid", "action", "length", F.explode("starts").alias("start"))
    span = F.struct(F.col("action").alias("kind"), "start", (F.col("start") + F.col("length")).alias("end"), F.lit(None).cast("string").alias("entity"))
    extra = stored(spans.groupBy(F.col("_uid").alias("_treated")).agg(F.collect_list(span).alias("_extra")), "treated")
    order = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    joined = found.join(extra, F.col("_uid") == F.col("_treated"), "left")
    both = F.concat("_spans", F.coalesce("_extra", F.array().cast(T.ArrayType(SPAN))))
    placed = F.sort_array(F.transform(both, lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("b"), s.alias("s"))))
    added = {"spans": F.when(F.col("_extra").isNull(), F.col("_spans")).otherwise(F.transform(placed, lambda p: p["s"]))}
    if keep_text:
        added["sanitised"] = rewritten(F.col(f"_row.`{text}`"), added["spans"])
    return unpacked(joined, docs if keep_text else docs.drop(text), added)
