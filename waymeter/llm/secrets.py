"""Secret scans through a trigram index.

From the syntax of each rule's pattern a Boolean query over trigrams is derived that every
match must satisfy. The index holds, for each segment of up to 4,096 texts and each trigram
that some query asks for, a bitmap of the texts that contain it. Queries are answered by
joining and intersecting bitmaps; only candidates are scanned with the pattern. A rule
without a mandatory trigram scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymeter.llm.common import fold, packed, row_chunks, stored, texts, unpacked

#: Texts of one segment of the index.
SEGMENT = 4096
#: A set of strings that grows beyond this is cut: the query then asks for less.
MOST_STRINGS = 64

INDEX = "segment bigint, trigram int, bits binary, keys array<bigint>"
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts if its group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are base kinds. Patterns are fixed values; ASCII letters in (?i:) match in either case.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
BASE = 3


def trigrams(text: str) -> set[int]:
    raw = text.encode()
    return {raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2] for i in range(len(raw) - 2)}


def _all_of(parts: list) -> object:
    parts = [p for p in parts if p is not True]
    return ("and", parts) if parts else True


def _any_of(parts: list) -> object:
    return True if any(p is True for p in parts) or not parts else ("or", parts)


def _of_strings(strings: set[str]) -> object:
    """What a text must contain if it contains one of the strings."""
    return _any_of([_all_of(sorted(trigrams(s))) for s in sorted(strings)])


def trigram_query(pattern: str) -> object:
    """True (no mandatory trigram), a trigram, or ("and" | "or", parts), over lower-cased ASCII."""
    strings, query = _walk(re._parser.parse(pattern, re.ASCII))
    return _all_of([query, _of_strings(strings)])


def _walk(nodes) -> tuple[set[str], object]:
    """The strings that the last part of a match must be, and the query of what came before."""
    run, parts = {""}, []

    def flush() -> None:
        nonlocal run
        parts.append(_of_strings(run))
        run = {""}

    def follow(strings: set[str]) -> None:
        nonlocal run
        if len(run) * len(strings) > MOST_STRINGS:
            flush()
        if len(strings) > MOST_STRINGS:
            return
        run = {a + b for a, b in product(run, strings)}

    for op, value in nodes:
        name = str(op)
        if name == "LITERAL":
            follow({_lower(value)})
        elif name == "IN" and (chars := _members(value)):
            follow(chars)
        elif name == "SUBPATTERN":
            inner, query = _walk(value[3])
            if query is not True:
                flush()
                parts.append(query)
            follow(inner)
            if query is not True:
                flush()
        elif name == "BRANCH":
            ways = [_walk(way) for way in value[1]]
            if all(query is True for _, query in ways):
                follow(set().union(*[strings for strings, _ in ways]))
            else:
                flush()
                parts.append(_any_of([_all_of([query, _of_strings(strings)]) for strings, query in ways]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, item = value
            inner, query = _walk(item)
            if least == 0 and most == 1 and query is True:
                follow(inner | {""})
            else:
                if least and query is True:
                    follow(inner)
                flush()
                if least:
                    parts.append(query)
        elif name not in ("AT", "ASSERT", "ASSERT_NOT"):
            flush()
    return run, _all_of(parts)


def _lower(code: int) -> str:
    return chr(code + 32) if 65 <= code <= 90 else chr(code)


def _members(parts) -> set[str]:
    """The characters of a class, or none if there are many."""
    chars: set[str] = set()
    for op, value in parts:
        if str(op) == "LITERAL":
            chars.add(_lower(value))
        elif str(op) == "RANGE" and value[1] - value[0] < MOST_STRINGS:
            chars |= {_lower(c) for c in range(value[0], value[1] + 1)}
        else:
            return set()
    return chars if len(chars) <= 8 else set()


def asked(query: object) -> set[int]:
    if query is True:
        return set()
    return {query} if isinstance(query, int) else set().union(*[asked(p) for p in query[1]])


def answer(query: object, bits: dict[int, int], every: int) -> int:
    """Intersect and unite postings, as integers of one bit for each text of a segment."""
    if query is True:
        return every
    if isinstance(query, int):
        return bits.get(query, 0)
    found = [answer(p, bits, every) for p in query[1]]
    total = found[0]
    for x in found[1:]:
        total = total & x if query[0] == "and" else total | x
    return total


def build_index(keyed: DataFrame, wanted: set[int]) -> DataFrame:
    """The postings of ``wanted`` trigrams over columns ``_key`` and ``_text``.

    A row with trigram -1 lists the keys of its segment, in the order of the bits.
    """
    numbers = np.array(sorted(wanted), np.int64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId() << 32
        place = np.full(1 << 24, -1, np.int16)
        place[numbers] = np.arange(len(numbers))
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for begin in range(0, batch.num_rows, SEGMENT):
                end = min(batch.num_rows, begin + SEGMENT)
                hits = np.zeros((len(numbers), end - begin), bool)
                for low, high in row_chunks(offsets[begin : end + 1]):
                    a, b = offsets[begin + low], offsets[begin + high]
                    part = fold(data[a:b]).astype(np.int32)
                    if len(part) < 3:
                        continue
                    which = place[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
                    at = np.flatnonzero(which >= 0)
                    row = np.searchsorted(offsets[begin : end + 1], at + a, "right") - 1
                    inside = at + a + 3 <= offsets[begin + 1 + row]
                    hits[which[at[inside]], row[inside]] = True
                used = np.flatnonzero(hits.any(axis=1))
                packed_bits = [np.packbits(hits[i], bitorder="little").tobytes() for i in used]
                keys = [None] * len(used) + [batch.column(0).slice(begin, end - begin).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment] * (len(used) + 1), pa.int64()),
                        pa.array([*numbers[used].tolist(), -1], pa.int32()),
                        pa.array([*packed_bits, None], pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["segment", "trigram", "bits", "keys"],
                )
                segment += 1

    return keyed.select("_key", "_text").mapInArrow(build, INDEX)


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(_key, rules): the texts that satisfy the query of a rule, one segment at a time."""

    def ask(rows: pa.Table) -> pa.Table:
        bits, keys = {}, []
        for trigram, raw, own in zip(*[rows[c].to_pylist() for c in ("trigram", "bits", "keys")]):
            if trigram < 0:
                keys = own
            else:
                bits[trigram] = int.from_bytes(raw, "little")
        every = (1 << len(keys)) - 1
        found: dict[int, list[str]] = {}
        for kind, query in queries.items():
            hit = answer(query, bits, every)
            while hit:
                low = hit & -hit
                found.setdefault(low.bit_length() - 1, []).append(kind)
                hit ^= low
        return pa.table({"_key": pa.array([keys[i] for i in found], pa.int64()), "rules": pa.array(list(found.values()), pa.list_(pa.string()))})

    rows = index.groupBy("segment").applyInArrow(ask, "_key bigint, rules array<string>")
    # equal texts give equal rows, at most one for each segment
    return rows.groupBy("_key").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("rules"))


def verifier(rules: tuple[Rule, ...], always: set[str]):
    @F.arrow_udf(SPANS)
    def verify(text: pa.Array, chosen: pa.Array) -> pa.Array:
        compiled = [(i, rule, re.compile(rule.pattern, re.ASCII)) for i, rule in enumerate(rules)]
        out = []
        for value, kinds in zip(text, chosen):
            value, kinds = value.as_py() or "", always.union(kinds.as_py() or ())
            spans = []
            for order, rule, pattern in compiled:
                if rule.kind in kinds:
                    for m in pattern.finditer(value):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans.append((m.start(), order, m.end()))
            out.append([{"kind": rules[order].kind, "start": a, "end": b} for a, order, b in sorted(spans)])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return verify


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``spans``: kind, start, end (code points, end exclusive) by start, then order of the rules.

    Per rule, matches are leftmost and do not overlap. A null or empty text has no spans.
    Rows are matched by a hash of their text, so repeated rows are scanned alike and a
    hash that two texts share only adds a candidate. A column named ``spans`` is replaced.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    always = {kind for kind, query in queries.items() if query is True}
    queries = {kind: query for kind, query in queries.items() if query is not True}
    rows = packed(docs).withColumn("_text", F.col(f"_row.`{text}`")).withColumn("_key", F.xxhash64("_text"))
    if not keep_text:
        rows = rows.withColumn("_row", F.col("_row").dropFields(f"`{text}`"))
    index = stored(build_index(rows, set().union(*[asked(q) for q in queries.values()])), "trigrams")
    chosen = stored(candidates(index, queries).withColumnRenamed("_key", "_of"), "candidates")
    joined = rows.join(chosen, F.col("_key") == F.col("_of"), "left")
    spans = verifier(rules, always)(F.col("_text"), F.col("rules"))
    return unpacked(joined.withColumn("_spans", spans), docs if keep_text else docs.drop(text), {"spans": F.col("_spans")})


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
