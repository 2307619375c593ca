"""Mixing and the whole pipeline."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeter.llm import mixing
from waymeter.llm.common import stored, table
from waymeter.llm.queries import TARGETS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), "stage"))
    return docs


def test_classifier_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = mixing.train(docs, labels.filter("doc_id % 3 > 0"))
    rows = docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").select(mixing.domain_of(F.col("quality"), F.col("toxic")).alias("y"), mixing.posteriors(model)(F.col("text"))["p"].alias("p")).collect()
    right = np.mean([int(np.argmax(r.p)) == int(r.y) for r in rows])
    assert len(rows) > 100 and right > 0.85


def test_rates_meet_the_targets(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    targets = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
    rows = mixing.mix(docs, labels, targets, keep_text=False).collect()
    assert len(rows) == docs.count()
    rate, tokens, p = np.array([r.rate for r in rows]), np.array([r.n_tokens for r in rows]), np.array([r.posterior for r in rows])
    assert rate.min() >= 0
    reached = (rate * tokens) @ p / tokens.sum()
    assert np.allclose(reached, [0.7, 0.2, 0.1], atol=0.01)
    # the same by plain projected gradient
    w, have = np.ones(len(rows)), tokens @ p
    gram = (p * tokens[:, None]).T @ p / np.sqrt(np.outer(have, have))
    for _ in range(mixing.MOST_STEPS):
        w = np.maximum(0, w - p @ (((w * tokens) @ p - np.array([0.7, 0.2, 0.1]) * tokens.sum()) / have) / np.linalg.eigvalsh(gram).max())
    assert np.allclose(w, rate, atol=0.02)


def test_rates_of_soft_documents_converge(spark):
    rng = np.random.default_rng(5)
    logits = np.eye(3)[rng.choice(3, 2000, p=[0.7, 0.27, 0.03])] * 2 + rng.normal(size=(2000, 3))
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    tokens = rng.integers(1, 2000, 2000)
    scored = stored(spark.createDataFrame([(int(t), list(map(float, q))) for t, q in zip(tokens, p)], "tokens bigint, p array<double>"), "soft")
    share = np.array([TARGETS[d] for d in mixing.DOMAINS])
    rate, report = mixing.fit_rates(scored, TARGETS)
    rows = scored.select("tokens", "p", rate.alias("w")).collect()
    w, t, q = np.array([r.w for r in rows]), np.array([r.tokens for r in rows]), np.array([r.p for r in rows])
    assert report["met"] and w.min() >= 0 and np.allclose((w * t) @ q / t.sum() / share, 1, atol=2e-4)
    # of all rates that meet the targets, those nearest to 1: accelerated gradient steps on the dual, to the end
    x = y = np.zeros(3)
    most = np.linalg.eigvalsh((q * t[:, None]).T @ q).max()
    for n in range(60_000):
        x, last = y - ((np.maximum(0, 1 + q @ y) * t) @ q - share * t.sum()) / most, x
        y = x + (n % 500) / (n % 500 + 3) * (x - last)
    assert np.allclose(np.maximum(0, 1 + q @ x), w, atol=0.02)
    # all documents alike: no rates can meet the targets, and the report says so
    alike = spark.createDataFrame([(7, [0.5, 0.3, 0.2])] * 20, "tokens bigint, p array<double>")
    rate, report = mixing.fit_rates(alike, TARGETS)
    assert not report["met"]
    have, want = 140 * np.array([0.5, 0.3, 0.2]), 140 * share
    best = (have * want / have).sum() / have.sum()
    assert np.isclose(alike.select(rate.alias("w")).first().w, best, atol=1e-4)


def test_the_mix_of_the_pipeline_is_kept(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = {r.doc_id for r in corpus_pipeline.source_mixing(spark, docs, SF).select("doc_id").collect()}
    label = {r._labelled: int(r.label) for r in mixing.worst_labels(labels).collect()}
    scored = docs.select("doc_id", mixing.posteriors(mixing.train(docs, labels))(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    assert len(kept) > 0.7 * len(scored) and not [r.doc_id for r in scored if label.get(r.doc_id) == 0 and r.doc_id not in kept]
    p = np.array([np.eye(3)[label[r.doc_id]] if r.doc_id in label else r.p for r in scored if r.doc_id in kept])
    t = np.array([r.tokens for r in scored if r.doc_id in kept])
    # what is left is the noise of drawing whole documents
    assert np.allclose(t @ p / t.sum(), [corpus_pipeline.TARGETS[d] for d in mixing.DOMAINS], atol=0.004)
    # a domain without labels is left out, and the others keep their proportion
    two = spark.createDataFrame([(7, [1.0, 1e-22, 0.0])] * 20 + [(7, [0.0, 1e-22, 1.0])] * 20, "tokens bigint, p array<double>")
    report = mixing.fit_rates(two, corpus_pipeline.TARGETS, once=True)[1]
    assert report["met"] and np.isclose(report["reached"][2] / report["reached"][0], 0.001 / 0.97, atol=1e-6) and report["reached"][0] > 139
    soft = spark.createDataFrame([(7, [0.5, 0.3, 0.2])] * 20, "tokens bigint, p array<double>")
    rate, report = mixing.fit_rates(soft, corpus_pipeline.TARGETS, once=True)
    assert not report["met"] and soft.select(rate.alias("w")).first().w == 1


def test_a_scarce_domain_holds_nothing_back(spark):
    """Hardly any poor text: all of it stays, and so does everything good."""
    rows = [(100, [1.0, 0.0, 0.0])] * 500 + [(10, [0.0, 1.0, 0.0])] * 3 + [(100, [0.0, 0.0, 1.0])] * 20
    scored = spark.createDataFrame(rows, "tokens bigint, p array<double>")
    rate, report = mixing.fit_rates(scored, corpus_pipeline.TARGETS, once=True)
    found = scored.select("p", rate.alias("w")).collect()
    of = lambda i: [r.w for r in found if r.p[i] == 1.0]
    assert report["met"] and min(of(0)) > 0.999 and min(of(1)) > 0.99
    assert abs(sum(of(2)) * 100 - 50_000 * 0.001 / 0.97) < 1


def test_mixing_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (None, "a b", 1.0), (2, "", 1.0), (2, "", 1.0)], "doc_id bigint, text string, rate double")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 0), (7, None, None)], "doc_id bigint, quality int, toxic int")
    assert mixing.mix(docs, labels, {"good": 1.0}).count() == 4
    assert mixing.mix(docs, labels.limit(0), {"good": 1.0}).count() == 4
    assert mixing.mix(docs.limit(0), labels, {"good": 1.0}).count() == 0


def test_each_stage_keeps_its_promise(spark, stages):
    docs, rules, exact, near, mixed, coded = [s.toPandas() for s in stages]
    for frame in (rules, exact, near, mixed):
        assert list(frame.columns) == list(docs.columns)
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    by_text = rules.assign(t=rules.text.map(fold)).groupby("t").doc_id.max()
    assert sorted(exact.doc_id) == sorted(by_text)
    left = [set(zip(*[fold(t).split()[i:] for i in range(5)])) for t in near.text]
    for i in range(len(left)):
        for j in range(i):
            if len(left[i]) and len(left[i] & left[j]) * 100 >= 80 * len(left[i] | left[j]):
                raise AssertionError((near.doc_id[i], near.doc_id[j]))
    assert set(near.doc_id) <= set(exact.doc_id) and set(mixed.doc_id) <= set(near.doc_id) and set(coded.doc_id) == set(mixed.doc_id)
    labels = table(spark, SF, "labels").toPandas().set_index("doc_id")
    lost = [i for i in set(near.doc_id) - set(mixed.doc_id) if i in labels.index]
    clean = [i for i in lost if labels.quality[i] == 1 and labels.toxic[i] == 0]
    assert len(clean) <= 0.03 * len(near) and coded.decoded_equal.all()


def test_stored_tables_are_packed(spark):
    from waymeter.llm.common import stored

    assert all(".zstd." in name for name in stored(spark.range(10), "packed").inputFiles())


def test_stages_shuffle_texts_only_of_what_they_drop(spark, monkeypatch):
    """Joins too large to broadcast: all but a few of the rows pass by them, and the rows kept are those of the operators."""
    from waymeter.llm import exact, near

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    odd = docs.filter("doc_id % 50 = 0")
    odd = odd.withColumn("doc_id", F.expr("CASE WHEN doc_id % 100 = 0 THEN doc_id + 1 END")).unionByName(odd).unionByName(odd.limit(5).withColumn("text", F.lit(None).cast("string")))
    docs = stored(docs.unionByName(odd), "odd")
    passed, plain = [], corpus_pipeline.split

    def split(*given):
        possible, clear = plain(*given)
        passed.append((given[0].count(), possible.count(), clear.count()))
        return possible, clear

    for module in (corpus_pipeline, exact, near):
        monkeypatch.setattr(module, "split", split)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = [
            (corpus_pipeline.exact_dedup, exact.find_copies(docs).filter("kept")),
            (corpus_pipeline.near_dedup, near.find_groups(docs).filter("kept")),
            (corpus_pipeline.source_mixing, mixing.mix(docs, labels, corpus_pipeline.TARGETS, once=True).filter("copies > 0")),
        ]
        for stage, expected in whole:
            passed.clear()
            got, expected = stage(spark, docs, SF), expected.select(*docs.columns)
            assert got.columns == docs.columns and got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
            assert passed and all(p + c == n and p < 0.5 * n for n, p, c in passed), (stage, passed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    from waymeter.llm import bloom

    rows = spark.range(4000).selectExpr("CASE WHEN id % 7 > 0 THEN id END AS k", "id")
    known = stored(rows.filter("id % 4 = 0").select("k"), "known")
    for most in (bloom.BROADCAST_BLOCKS, 1):
        monkeypatch.setattr(bloom, "BROADCAST_BLOCKS", most)
        possible, clear = bloom.split(rows, F.col("k"), known, "k")
        assert possible.unionByName(clear).exceptAll(rows).isEmpty() and possible.count() + clear.count() == 4000
        assert clear.filter("id % 4 = 0").isEmpty() and clear.filter("k IS NULL").isEmpty() and (most == 1 or clear.count() > 2400)
