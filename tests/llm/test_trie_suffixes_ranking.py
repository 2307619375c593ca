"""Prefix trie, repeated strings and ranked search against brute force, and odd inputs of each."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeter.llm import ranking, suffixes, trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    out = []
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        inner = {k[:-1] for k in members if k}
        out.append(
            (
                min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), sum(1 for k in below if len(k) == len(key) + 1),
                sum(1 for k in below if k not in inner), sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k),
                hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(key)).encode()).hexdigest(),
            )
        )
    return Counter(out)


def made_turns(seed):
    random_ = random.Random(seed)
    rows = []
    for c in [*range(-7, 40), 10**12, 10**12 + 3]:
        if random_.random() < 0.2:
            continue
        numbers = [random_.choice([None, 0, 1, 2, 3, 4, 5]) for _ in range(random_.choice([1, 2, 3, 6, 12, 40]))]
        rows += [(c, n, random_.choice(["user", "assistant", None, ""]), random_.choice(["a", "b", "é", None, ""])) for n in numbers]
    return rows + [(None, 1, "user", "nobody's")] + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = made_turns(seed)
    frame = spark.createDataFrame(rows, TURNS).withColumns({"conv": F.lit(1), "depth": F.lit("x"), "part": F.lit(0)}).repartition(3)
    found = Counter(tuple(r) for r in trie.prefix_trie(frame).collect())
    assert found == brute_trie(rows)


def test_trie_of_one_long_conversation_in_pieces(spark):
    rows = [(5, i, "user", f"t{i % 7}") for i in range(3000)] + [(6, i, "user", f"t{i % 7}") for i in range(2500)]
    found = trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    h = zlib.crc32(b"6") % 9
    by_depth = {(r.depth, r.n_convs): r for r in found.collect()}
    assert len(by_depth) == 3001 and by_depth[0, 2].n_leaves == 1 and by_depth[2500, 2].conv_id == 5 and 0 <= h < 9
    assert by_depth[0, 2].saved_tokens == 2 * 2500
    assert by_depth[2500, 2].ends_sha256 == hashlib.sha256(b"6").hexdigest()


def test_trie_is_built_again_after_a_clash(spark, monkeypatch):
    rows = made_turns(3)
    seeds = []
    real = trie.factors
    # with r = 1 in every lane the order of turns does not show
    monkeypatch.setattr(trie, "factors", lambda seed: seeds.append(seed) or ([1] * trie.LANES if seed == 0 else real(seed)))
    found = Counter(tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect())
    assert found == brute_trie(rows) and max(seeds) == 1


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).collect() == []


# ---- repeated strings ------------------------------------------------------------------


def brute_repeats(rows, length):
    """Rows (id, text) in their order; equal ids do not occur."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            gram = data[i : i + length]
            if gram in seen:
                gone[i : i + length] = True
            seen.add(gram)
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(gone) else 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def made_texts(seed, length):
    random_ = random.Random(seed)
    passages = ["".join(random_.choice("abé \0") for _ in range(random_.choice([length - 2, length, length + 9, 3 * length]))) for _ in range(6)]
    noise = lambda: "".join(random_.choice("abcdefgh") for _ in range(random_.choice([0, 1, 5, length])))
    rows = [(i, "".join(noise() + random_.choice(passages) for _ in range(random_.randrange(4))) + noise()) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "a" * 5 * length), (53, "ab" * 3 * length), (54, rows[3][1]), (55, rows[3][1]), (None, rows[3][1] + "x")]
    return rows


@pytest.mark.parametrize(("seed", "length", "most"), [(1, 100, 1 << 17), (2, 40, 1 << 17), (3, 40, 1), (4, 12, 1 << 17), (5, 3, 1 << 17)])
def test_repeats_against_brute_force(spark, seed, length, most, monkeypatch):
    monkeypatch.setattr(suffixes, "SORT_ROWS", 64)
    rows = made_texts(seed, length)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n_bytes": F.lit("old"), "_uid": F.lit(1)}).repartition(3)
    found = suffixes.remove_repeats(frame, length=length, most_classes=most)
    assert set(found.columns) == {"doc_id", "text", "_uid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_bytes)) for r in found.collect()}
    assert got == brute_repeats(rows, length)


def test_repeated_rows_keep_one(spark):
    random_ = random.Random(7)
    text = "".join(random_.choice("abcdef ") for _ in range(400))
    rows = spark.createDataFrame([(1, text)] * 3 + [(1, text[:150]), (2, text)], "doc_id bigint, text string")
    found = sorted((r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(rows, keep_text=False).collect())
    # of equal rows one stays; which of the two texts of id 1 comes first, a hash decides
    assert found in ([(150, 0), (400, 150), (400, 400), (400, 400), (400, 400)], [(150, 150), (400, 0), (400, 400), (400, 400), (400, 400)])


def test_long_texts_are_read_in_pieces(monkeypatch):
    import pyarrow as pa

    random_ = random.Random(9)
    text = "".join(random_.choice("abcd ") for _ in range(9000)) + "z" * 3000
    whole = [x for x in suffixes.anchored(pa.array([text]), 100)]
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 700)
    cut = [x for x in suffixes.anchored(pa.array([text]), 100)]
    for a, b in zip(whole[0][2:], cut[0][2:]):
        assert np.array_equal(a, b)


def test_repeats_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffixes.remove_repeats(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id bigint, text string")
    assert {(r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_repeats(blank).collect()} == {(0, 0, 0)}


def test_blind_trie_orders_strings():
    random_ = random.Random(11)
    for size in (1, 2, 60):
        strings = [bytes(random_.choice(b"\0ab") for _ in range(random_.randrange(9))) for _ in range(size)]
        order, shared = suffixes.blind_trie(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(size))
        for a, b, n in zip(order, order[1:], shared[1:]):
            x, y = strings[a], strings[b]
            assert x[:n] == y[:n] and (x[: n + 1] != y[: n + 1] or n == len(x) == len(y))


def test_deep_shallow_orders_groups():
    random_ = random.Random(12)
    strings = [b"k" * random_.choice([0, 8, 60]) + bytes(random_.choice(b"\0ab") for _ in range(random_.randrange(12))) for _ in range(300)]
    group = np.array([random_.randrange(5) for _ in strings])
    slots, shared = suffixes.deep_shallow(group, strings, 80)
    assert [(group[i], strings[i]) for i in slots] == sorted(zip(group, strings))
    for a, b, n in zip(slots, slots[1:], shared[1:]):
        if group[a] != group[b]:
            assert n == -1
        else:
            x, y = strings[a], strings[b]
            assert x[:n] == y[:n] and (x[: n + 1] != y[: n + 1] or n == len(x) == len(y))


# ---- ranked search ---------------------------------------------------------------------


def brute_search(docs, items, k):
    terms = lambda text: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))
    bags = [(doc, terms(text)) for doc, text in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            tf = Counter(bag)
            m = 75 + 25 * len(bag) * n_docs // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms(text) if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


@pytest.mark.parametrize(("seed", "k", "block"), [(1, 3, 1 << 17), (2, 20, 1 << 17), (3, 4, 60)])
def test_search_against_brute_force(spark, seed, k, block, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranking, "CELLS", 40)
    monkeypatch.setattr(ranking, "MOST_CANDIDATES", 50)
    random_ = random.Random(seed)
    words = ["a", "B", "été", "Été", "x1", "42", "_", "-", "東京", "zz", "\x7f", "ÀB"]
    text = lambda n: random_.choice([" ", ",", "\n"]).join(random_.choice(words) for _ in range(random_.randrange(n)))
    docs = [(i, text(12)) for i in range(60)] + [(70, None), (71, ""), (None, "a b x1"), (3, "a b"), (72, "zz " * 5000)]
    docs += [(100 + i, docs[5][1]) for i in range(30)] + [(5, docs[5][1])]
    items = [(i, text(6)) for i in range(12)] + [(20, None), (21, "nowhere"), (3, "a a b"), (None, "x1")]
    frame = spark.createDataFrame(docs, DOCS).withColumns({"n": F.lit(1), "bag": F.lit("x"), "rank": F.lit(0)}).repartition(3)
    found = ranking.search(frame, spark.createDataFrame(items, ITEMS).withColumn("score", F.lit(1)), k=k)
    assert Counter(tuple(r) for r in found.collect()) == brute_search(docs, items, k)


def test_search_of_nothing(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], DOCS)
    asked = spark.createDataFrame([(1, "a")], ITEMS)
    assert ranking.search(none, asked).collect() == []
    assert ranking.search(some, asked.limit(0)).collect() == []
    assert ranking.search(some, spark.createDataFrame([(1, None)], ITEMS)).collect() == []
    assert ranking.search(spark.createDataFrame([(1, "...")], DOCS), asked).collect() == []
