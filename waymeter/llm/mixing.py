"""Mixing to target weights with soft domain membership.

A classifier trained on the labelled table gives each document posterior probabilities of
its domain. Nonnegative rates are then fitted by least squares so that expected tokens per
domain, the sum of rate * tokens * posterior, match the targets, by projected gradient steps.
Every document has a place, at first 1, and its rate is the place projected on what rates may
be: 0 or more, and 1 at most where a document may be drawn once only. A step moves the places
against the gradient of the squared residuals, the posterior times one number for each domain.
As places are not projected themselves, the sum of all steps tells them, and of all rates that
meet the targets the steps lead to those nearest to 1. The numbers are the residuals, scaled by
the inverse of what rates that are free to move can do for them, so few steps are needed. A
step needs only sums over all documents and is one aggregate over a narrow table; rates are
never stored, they follow from a document's posterior and the moves.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymeter.llm.common import fold, packed, release, row_chunks, stored, texts, unpacked, word_bounds, word_hashes

DOMAINS = ("good", "poor", "toxic")
HASH_BITS = 18
#: Word features, and after them shares of a text in sixteen steps each.
WORDS, STEPS, SHARES = 1 << HASH_BITS, 16, 4
FEATURES = WORDS + STEPS * SHARES
#: The classifier is fitted on at most so many labelled documents, those with the smallest hash of their id.
SAMPLE_ROWS = 8000
#: Features that fewer of them have are left out.
LEAST_ROWS = 4
#: Penalties on the classifier's weights, by their size and by their squares; its steps, and the change of its loss that ends them.
LASSO, SQUARES, FIT_STEPS, FIT_CHANGE = 9e-5, 1e-5, 400, 1e-7
#: Steps end when each domain's expected tokens are within this share of its target.
TOLERANCE = 1e-4
#: Passes over the documents; what then is not met is reported.
MOST_STEPS = 60
#: The least damping of a step, and the gain below which no step helps, as a share of the loss.
RIDGE, GAIN = 1e-8, 1e-6
#: A domain with no more than this share of all tokens has no document; the classifier never gives an exact 0.
ABSENT = 1e-12

_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SIGNS = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("features", T.ArrayType(T.IntegerType()))])


def text_features(column: pa.Array):
    """For each text its words (runs without white space) and the sorted features it has.

    Features are hashed terms, and the shares of distinct words, capitals, characters
    other than letters and digits, and long words.
    """
    data, offsets = texts(column)
    for low, high in row_chunks(offsets):
        part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        starts, ends, rows = word_bounds(part, own, _BREAKS)
        terms = (word_hashes(fold(part), starts, ends) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        plain = word_bounds(part, own)[2]
        tokens = np.bincount(plain, minlength=high - low)
        edges = np.searchsorted(rows, np.arange(high - low + 1))
        capital = np.concatenate(([0], np.cumsum((part >= 65) & (part <= 90))))
        sign = np.concatenate(([0], np.cumsum(_BREAKS[part] & (part > 32))))
        for i in range(high - low):
            a, b = edges[i], edges[i + 1]
            distinct = np.unique(terms[a:b])
            size = max(1, own[i + 1] - own[i])
            shares = (
                len(distinct) / max(1, b - a),
                (capital[own[i + 1]] - capital[own[i]]) / size,
                min(1.0, 4 * (sign[own[i + 1]] - sign[own[i]]) / size),
                float(np.count_nonzero(ends[a:b] - starts[a:b] > 8)) / max(1, b - a),
            )
            steps = [WORDS + n * STEPS + min(STEPS - 1, int(share * STEPS)) for n, share in enumerate(shares)]
            yield int(tokens[i]), np.concatenate((distinct, steps))


@F.arrow_udf(SIGNS)
def find_features(column: pa.Array) -> pa.Array:
    found = list(text_features(column))
    arrays = [pa.array([t for t, _ in found], pa.int64()), pa.array([f.astype(np.int32) for _, f in found], pa.list_(pa.int32()))]
    return pa.StructArray.from_arrays(arrays, ["tokens", "features"])


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 1, 0).when(quality == 0, 1).cast("double")


def worst_labels(labels: DataFrame) -> DataFrame:
    """(_labelled, label): the worst domain that a document is labelled with."""
    named = labels.select(F.col("doc_id").alias("_labelled"), domain_of(F.col("quality"), F.col("toxic")).alias("label"))
    return named.filter("_labelled IS NOT NULL AND label IS NOT NULL").groupBy("_labelled").agg(F.max("label").alias("label"))


def fit_classifier(at: np.ndarray, edges: np.ndarray, y: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x domains) and biases of a multinomial logistic classifier by accelerated proximal gradient steps.

    Row i has the features ``at[edges[i]:edges[i + 1]]``, each once, and domain ``y[i]``. The
    loss is the mean log loss with the penalties LASSO and SQUARES, the bias being free of them.
    """
    n, k = len(y), len(DOMAINS)
    sizes = np.diff(edges)
    of_row = np.repeat(np.arange(n), sizes)
    goal = np.eye(k)[y]
    # each weight has a step of its own: a row with s features bends the loss by s / 2 at most in each of them
    bend = np.bincount(at, (sizes[of_row] + 1) / (2 * n), n_features)
    rate, bias_rate = (1 / (bend + SQUARES))[:, None], 1 / ((sizes + 1).sum() / (2 * n))
    w, bias = np.zeros((n_features, k)), np.zeros(k)
    ahead, bias_ahead, pace, last = w, bias, 1.0, np.inf
    for _ in range(FIT_STEPS):
        z = np.stack([np.bincount(of_row, ahead[at, d], n) for d in range(k)], axis=1) + bias_ahead
        z -= z.max(axis=1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        loss = -(log_p * goal).sum() / n + LASSO * np.abs(ahead).sum() + SQUARES / 2 * (ahead**2).sum()
        if abs(last - loss) <= FIT_CHANGE * loss:
            break
        if loss > last:
            pace = 1.0  # the momentum went too far: start it anew
        last = loss
        g = (np.exp(log_p) - goal) / n
        slope = np.stack([np.bincount(at, g[of_row, d], n_features) for d in range(k)], axis=1) + SQUARES * ahead
        moved = ahead - rate * slope
        new = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * LASSO)
        new_bias = bias_ahead - bias_rate * g.sum(axis=0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, bias_ahead = new + (pace - 1) / faster * (new - w), new_bias + (pace - 1) / faster * (new_bias - bias)
        w, bias, pace = new, new_bias, faster
    return w, bias


def _fit_sample(batches):
    """All rows of the bounded sample (label, at) to (feature, w): weights other than 0, and the bias as feature -1."""
    labels, lists = [], []
    for batch in batches:
        labels.append(batch.column("label").to_numpy(zero_copy_only=False))
        lists.append(batch.column("at"))
    y = np.concatenate(labels).astype(np.int64) if labels else np.zeros(0, np.int64)
    sizes = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in lists] or [y])
    raw = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in lists] or [y])
    seen = np.unique(y)
    usual = np.flatnonzero(np.bincount(raw, minlength=FEATURES) >= LEAST_ROWS)
    feature, w = [-1], [np.isin(np.arange(len(DOMAINS)), seen) * 50.0]
    if len(seen) > 1 and len(usual):
        keep = np.isin(raw, usual)
        left = np.bincount(np.repeat(np.arange(len(y)), sizes)[keep], minlength=len(y))
        found, bias = fit_classifier(np.searchsorted(usual, raw[keep]), np.concatenate(([0], np.cumsum(left))), y, len(usual))
        bias = np.where(np.isin(np.arange(len(DOMAINS)), seen), bias, -50.0)
        used = np.flatnonzero(np.abs(found).sum(axis=1))
        feature, w = [-1, *usual[used].tolist()], [bias, *found[used]]
    yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int32()), pa.array([list(map(float, x)) for x in w], pa.list_(pa.float64()))], ["feature", "w"])


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """A sparse multinomial logistic classifier: features in order, and weights with one row for each domain, the last column the bias.

    ``labels`` has ``doc_id quality toxic``; a document labelled more than once counts as the worst.
    At most ``sample_rows`` labelled documents are fitted, in one task that holds only which
    features they have; their number does not grow with the data. With no labelled document,
    every domain is as likely; with labels of a single domain, that one is certain.
    """
    named = worst_labels(labels)
    # at most sample_rows small rows, so this broadcast does not grow with the data
    chosen = F.broadcast(named.orderBy(F.xxhash64("_labelled"), "_labelled").limit(sample_rows))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, F.col("_id") == F.col("_labelled"))
    rows = stored(rows.select("label", find_features("_text")["features"].alias("at")), "labelled")
    # no more than FEATURES rows, of which the penalty leaves few
    found = sorted(rows.coalesce(1).mapInArrow(_fit_sample, "feature int, w array<double>").collect())
    kept = np.array([r.feature for r in found if r.feature >= 0], np.int64)
    bias = [r.w for r in found if r.feature < 0] or [[0.0] * len(DOMAINS)]
    return kept, np.array([*[r.w for r in found if r.feature >= 0], bias[0]]).T


def posteriors(model: tuple[np.ndarray, np.ndarray]):
    """Arrow function from texts to (tokens, posterior of each domain)."""
    kept, weights = model

    @F.arrow_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))]))
    def score(column: pa.Array) -> pa.Array:
        column_of = np.full(FEATURES, len(kept) + 1, np.int32)
        column_of[kept] = np.arange(len(kept))
        # one more column for features that are not kept
        own = np.concatenate((weights[:, :-1], weights[:, -1:], np.zeros((len(DOMAINS), 1))), axis=1)
        tokens, p = [], []
        for n, at in text_features(column):
            raw = own[:, column_of[at]].sum(axis=1) + own[:, len(kept)]
            raw = np.exp(raw - raw.max())
            tokens.append(n)
            p.append(raw / raw.sum())
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(p, pa.list_(pa.float64()))], ["tokens", "p"])

    return score


def rate_of(moved: np.ndarray, share: np.ndarray | None = None) -> Column:
    """The rate as a column over ``p``: the place 1 less the posteriors times what was moved, projected on 0 or more.

    With ``share`` posteriors count by what they exceed it, and the rate is 1 at most.
    """
    return _projected(_place(moved, share), share)


def _place(moved: np.ndarray, share: np.ndarray | None) -> Column:
    over = np.zeros(len(DOMAINS)) if share is None else share
    return F.lit(1.0) - sum((F.col("p")[i] - float(over[i])) * float(x) for i, x in enumerate(moved))


def _projected(place: Column, share: np.ndarray | None) -> Column:
    return F.greatest(F.lit(0.0), place if share is None else F.least(F.lit(1.0), place))


def descend(measure, aim: np.ndarray, scale: np.ndarray, slack_of) -> tuple[np.ndarray, np.ndarray, float, bool, int]:
    """Projected gradient steps towards ``aim``: what they move, the sums and tokens reached, whether all aims are met, and passes.

    ``measure(moved)`` gives the sums of the domains, the sums of products of posteriors over
    documents whose rate is free to move, and the tokens kept; ``slack_of(tokens)`` how far
    sums may be off. The loss is the sum of squared residuals over ``scale``. A step that does
    not lower it is damped and tried again; one damped in full is the plain gradient step of
    a length that cannot raise it.
    """
    root, moved, damp = np.sqrt(scale), np.zeros(len(aim)), RIDGE
    loss = lambda sums: float((((sums - aim) / root) ** 2).sum())
    sums, gram, kept = measure(moved)
    norm = np.linalg.eigvalsh(gram / np.outer(root, root)).max()
    passes = 1
    while not (met := bool((np.abs(sums - aim) <= slack_of(kept)).all())) and passes < MOST_STEPS:
        residual = (sums - aim) / root
        inner = gram / np.outer(root, root) + damp * norm * np.eye(len(root))
        step = (residual / norm if damp >= 1 else np.linalg.solve(inner, residual)) / root
        tried = measure(moved + step)
        passes += 1
        if loss(sums) - loss(tried[0]) > GAIN * loss(sums):
            moved, damp = moved + step, max(RIDGE, damp / 10)
            sums, gram, kept = tried
        elif damp >= 1:
            break
        else:
            damp = min(1.0, damp * 10)
    return moved, sums, kept, met, passes


def fit_rates(
    scored: DataFrame, targets: dict[str, float], total: float | None = None, reach: float | None = None, once: bool = False
) -> tuple[Column, dict]:
    """The rate as a column over ``p``, and a report of available, wanted and reached tokens per domain.

    ``targets`` are weights that are scaled to one. The total of expected tokens is ``total``,
    or ``reach`` times what the first domain has, by its weight, or else all tokens there are.
    A domain that no document belongs to is left out. ``report["met"]`` tells whether every
    target is met within TOLERANCE. If not, these are the rates with the least scaled
    residuals that MOST_STEPS passes found.

    With ``once`` rates are 1 at most and the total is what then can be kept with these
    shares; a domain too scarce for its share, beside all of the first domain, has the share it
    can have. If no documents have them, all rates are 1 and the report says that targets are not met.
    """
    k = range(len(DOMAINS))
    pairs = [(i, j) for i in k for j in k if i <= j]

    def measure(moved: np.ndarray, over: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        x = [F.col("p")[i] - (0.0 if over is None else float(over[i])) for i in k]
        free = (F.col("place") > 0) & (F.lit(True) if over is None else F.col("place") <= 1)
        weighed = scored.select("tokens", "p", _place(moved, over).alias("place"))
        weighed = weighed.select("p", (F.col("tokens") * _projected(F.col("place"), over)).alias("drawn"), (F.col("tokens") * free.cast("double")).alias("active"))
        sums = [F.sum("drawn").alias("kept"), *[F.sum(F.col("drawn") * x[i]).alias(f"a{i}") for i in k]]
        row = weighed.agg(*sums, *[F.sum(F.col("active") * x[i] * x[j]).alias(f"g{i}{j}") for i, j in pairs]).first()
        gram = np.array([[row[f"g{min(i, j)}{max(i, j)}"] or 0.0 for j in k] for i in k])
        return np.array([row[f"a{i}"] or 0.0 for i in k]), gram, row["kept"] or 0.0

    have, _, _ = measure(np.zeros(len(DOMAINS)))
    used = have > ABSENT * have.sum()
    share = np.array([targets.get(d, 0.0) for d in DOMAINS])
    if not share.sum() > 0:
        raise ValueError("targets need a weight above 0")
    share = share / share.sum()
    if total is None:
        total = reach * have[0] / share[0] if reach and share[0] > 0 else have.sum()
    want = share * total
    report = {"available": have, "wanted": want, "reached": have, "steps": 0, "met": True}
    if not used.any():
        return F.lit(1.0), report
    over, aim = None, want
    if once:
        if not share[used].sum() > 0:
            return F.lit(1.0), report | {"met": False}
        if have[0] > 0 and share[0] > 0:
            # a domain with less than its part beside all of the first one is kept whole, and holds nothing else back
            share = np.where(used, np.minimum(share, share[0] * have / have[0]), share)
        share = np.where(used, share, 0.0) / share[used].sum()
        over, aim, total = share, np.zeros(len(DOMAINS)), have.sum()

    def slack_of(kept: float) -> np.ndarray:
        aims = share * kept if once else want
        return (TOLERANCE * np.maximum(aims, TOLERANCE * aims.sum()))[used]

    def full(moved: np.ndarray) -> np.ndarray:
        all_domains = np.zeros(len(DOMAINS))
        all_domains[used] = moved
        return all_domains

    def of_used(moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        sums, gram, kept = measure(full(moved), over)
        return sums[used], gram[np.ix_(used, used)], kept

    scale = np.maximum(share, TOLERANCE)[used] * total if once else have[used]
    moved, sums, kept, met, passes = descend(of_used, aim[used], scale, slack_of)
    met = met and bool(not once or kept > ABSENT * total)
    report |= {"wanted": share * kept if once else want, "reached": full(sums) + (share * kept if once else 0), "steps": passes, "met": met}
    if once and not met:
        return F.lit(1.0), report | {"reached": have}
    return rate_of(full(moved), over), report


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    text: str = "text",
    doc_id: str = "doc_id",
    reach: float | None = None,
    seed: int = 0,
    keep_text: bool = True,
    once: bool = False,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posterior`` (of DOMAINS), ``rate`` and ``copies``.

    ``copies`` is the rate rounded up or down at random, so that its mean is the rate; the
    draw follows from ``doc_id`` and ``seed`` (from the text where the id is null). A null or
    empty text has no tokens and counts for nothing, but has a rate. Rows are independent,
    so repeated rows stay. ``keep_text=False`` leaves the text out. Columns of ``docs`` with
    the name of a result column are replaced; an empty table gives an empty result.

    With ``once`` no document is drawn more than once, the shares of what is kept are the
    targets, and a labelled document belongs to the domain of its label for certain.
    """
    model = train(docs, labels, text, doc_id)
    release(docs.sparkSession)
    rows = packed(docs).withColumn("s", posteriors(model)(F.col(f"_row.`{text}`")))
    place = F.coalesce(F.xxhash64(F.col(f"_row.`{doc_id}`"), F.lit(seed)), F.lit(0))
    place = F.when(F.col(f"_row.`{doc_id}`").isNull(), F.xxhash64(F.col(f"_row.`{text}`"), F.lit(seed))).otherwise(place)
    rows = rows.withColumn("_draw", F.shiftrightunsigned(place, 11).cast("double") / F.lit(float(1 << 53)))
    row = F.col("_row") if keep_text else F.col("_row").dropFields(f"`{text}`")
    p = F.col("s.p")
    # before the join, so that a text left out is not shuffled either
    rows = rows.select(row.alias("_row"), F.col(f"_row.`{doc_id}`").alias("_id"), "_draw", "s")
    if once:
        rows = rows.join(worst_labels(labels), F.col("_id") == F.col("_labelled"), "left")
        p = F.when(F.col("label").isNull(), p).otherwise(F.array(*[(F.col("label") == i).cast("double") for i in range(len(DOMAINS))]))
    scored = stored(rows.select("_row", "_draw", "s.tokens", p.alias("p")), "posteriors")
    rate, report = fit_rates(scored.select("tokens", "p"), targets, reach=reach, once=once)
    if not report["met"]:
        warnings.warn(f"no rates meet the targets; these come nearest: {report}", stacklevel=2)
    rated = scored.withColumn("_rate", rate)
    copies = F.floor("_rate") + (F.col("_draw") < F.col("_rate") - F.floor("_rate")).cast("bigint")
    added = {"n_tokens": F.col("tokens"), "posterior": F.col("p"), "rate": F.col("_rate"), "copies": copies.cast("bigint")}
    return unpacked(rated, docs if keep_text else docs.drop(text), added)
