"""Near duplicates against comparing all pairs."""

import random

import pytest

from waymeter.llm import near


def shingles(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", lowered) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    group = {i: i for i, _ in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus():
    rng = random.Random(5)
    word = lambda: "w" + str(rng.randrange(4000))
    base = [word() for _ in range(150)]
    texts = []

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = word()
        return words

    texts += [edited(base, rng.randrange(9)) for _ in range(90)]  # many too far from the first
    variant = edited(base, 12)
    texts += [edited(variant, rng.randrange(6)) for _ in range(50)]  # a group beside it, similar to some
    texts += [base[: rng.randrange(90, 150)] for _ in range(40)]  # cut off: they lack, and add nothing
    texts += [base[20:60] + [word() for _ in range(rng.randrange(5, 200))] for _ in range(60)]  # a shared passage
    texts += [[word() for _ in range(n)] for n in (1, 2, 3, 4, 5, 8)] + [["a"], ["A"], ["the"] * 40, ["the"] * 41]
    rows = [(i * 3 % 1009, " ".join(t).upper() if i % 7 == 0 else "  ".join(t)) for i, t in enumerate(texts)]
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (2003, "x" * 200_000), (2004, "é b c d"), (2005, "É b c d")]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, size, percent):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id bigint, text string, key string, n int")
    found = near.find_groups(docs, size=size, percent=percent).collect()
    expected = brute(rows, size, percent)
    assert len(found) == len(rows) and set(found[0].asDict()) == {"doc_id", "text", "key", "n", "n_shingles", "component_id", "kept"}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_rows_without_id_repeats_and_empty_tables(spark):
    text = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(None, text), (None, text), (5, text), (5, text), (3, text), (None, None)], "doc_id bigint, text string")
    rows = near.find_groups(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True)] * 3 + [(3, 3, True), (5, 3, False), (5, 3, False)]
    assert near.find_groups(docs.limit(0)).count() == 0


def test_repeated_ids_with_different_texts_lose_no_link(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(1, a), (1, b), (2, a[:-1] + ["x"]), (3, b[:-1] + ["y"]), (4, [f"c{i}" for i in range(60)])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id bigint, text string")
    found = sorted((r.doc_id, r.component_id) for r in near.find_groups(docs).collect())
    assert found == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_one_passage_in_many_texts_is_divided(spark):
    """Two frequent passages, alone and together, in texts that else differ: no pairs, and groups inside are found."""
    rng = random.Random(8)
    word = lambda: "w" + str(rng.randrange(10**6))
    one, two = [word() for _ in range(40)], [word() for _ in range(40)]
    rows = []
    for i in range(240):
        own = [word() for _ in range(rng.randrange(20, 40))]
        rows.append((2 * i, (one if i % 3 else two) + (two if i % 5 == 0 else []) + own))
        if i % 10 == 0:
            rows.append((2 * i + 1, rows[-1][1][:-1]))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id bigint, text string")
    expected = brute([(i, " ".join(t)) for i, t in rows], 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near.find_groups(docs).collect()} == expected


def test_bands_keep_similar_pairs():
    for percent in (80, 85):
        rows = near.band_rows(percent / 100)
        assert (1 - (percent / 100) ** rows) ** (near.BUCKETS // rows) <= near.MISS


def test_one_large_group_of_near_copies_is_dealt_anew_once(spark, monkeypatch):
    """Copies of one text with few to many edits, some shared: buckets are not divided round after round, and no link is lost."""
    rng = random.Random(11)
    word = lambda: "w" + str(rng.randrange(10**6))
    base, common = [word() for _ in range(120)], [word() for _ in range(12)]
    rows = []
    for i in range(260):
        words = list(base[: rng.randrange(100, 121)])
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = rng.choice(common) if i % 3 == 0 else word()
        rows.append((i, " ".join(words)))
    names, stored = [], near.stored
    monkeypatch.setattr(near, "stored", lambda df, name: names.append(name) or stored(df, name))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near.find_groups(docs, size=3, percent=85).collect()}
    assert found == brute(rows, 3, 85)
    assert names.count("members") == 1 and names.count("pairs") <= 3
