"""Quality rules whose limits adapt to each language and source.

Per text a few counts become integer rates. Their distribution in every (language, source)
is kept in a mergeable quantile sketch: a histogram whose buckets are the integers up to
63 and then 64 per power of two, so a quantile is off by 1/32 at most, sketches merge
by adding counts, and any cluster layout gives the same limits. Limits are fences that lie
outside the quartiles by what the tails of the group spread; small groups lean on the sketch of
their language, and that on the one of all texts. Texts are filtered by a join with the limits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymeter.llm.common import packed, stored, unpacked

SPACES = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: rate: (numerator, denominator, scale, least spread below if that side is limited, least spread above)
RATES = {
    "word_length": ("word_chars", "n_words", 100, 60, 100),
    "symbols": ("n_symbols", "n_words", 1000, None, 20),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, None, 60),
    "repeats": ("n_repeat_words", "n_words", 1000, None, 30),
}
#: How many spreads a text may lie outside the quartile. A spread is half the way from the median to the outer 15 %, so junk up to that share does not widen it.
REACH = 6
#: Texts that the next wider sketch counts as when quantiles are blended.
PRIOR_TEXTS = 100
#: Quantiles that are read from a sketch, in twentieths.
QUANTILES = {"q15": 3, "q25": 5, "q50": 10, "q75": 15, "q85": 17}


def with_counts(rows: DataFrame, text: str = "_text") -> DataFrame:
    """Add ``n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words`` of a text column without nulls."""
    rows = rows.withColumn("_words", F.array_remove(F.split(text, SPACES, -1), ""))
    rows = rows.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t-\r]")))
    # 64-bit hashes of the words, then of each window of them, compared within one text only
    rows = rows.withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
    window = F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda at: F.xxhash64(*[F.get("_hashes", at + i) for i in range(WINDOW)]))
    rows = rows.withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda value, at: F.struct(value.alias("value"), at.alias("at"))))
    rows = rows.withColumn("_placed", F.when(repeats, placed))
    return rows.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": F.coalesce(_covered("_placed"), F.lit(0)).cast("bigint"),
        }
    ).drop("_words", "_lines", "_hashes", "_windows", "_placed")


def _covered(placed: str) -> Column:
    """Words in windows that occur twice or more; ``placed`` has (value, at) of all windows in order."""
    value = lambda at: F.get(placed, at)["value"]
    # in the sorted array a window repeats if a neighbour has the same value
    again = F.filter(placed, lambda x, i: x["value"].eqNullSafe(value(i - 1)) | x["value"].eqNullSafe(value(i + 1)))
    starts = F.sort_array(F.transform(again, lambda x: x["at"]))
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda so_far, at: F.struct((so_far["sum"] + F.least(F.lit(WINDOW), at - so_far["last"])).alias("sum"), at.alias("last")),
    )
    return total["sum"]


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < 10) | (100 * F.col(n_repeat_words) > 20 * F.col(n_words))


def rate(name: str) -> Column:
    part, whole, scale, *_ = RATES[name]
    return F.coalesce(F.expr(f"{part} * {scale} div nullif({whole}, 0)"), F.lit(0).cast("bigint"))


def bucket(value: Column) -> Column:
    """The number of the sketch's bucket: the value up to 63, then its power of two and six leading bits."""
    up = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (up * 64).cast("bigint") + F.call_function("shiftright", value, up)


def bucket_start(number: Column) -> Column:
    up = F.call_function("shiftright", number - 32, F.lit(6))
    return F.when(number < 64, number).otherwise(F.call_function("shiftleft", number - up * 64, up.cast("int")))


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of all rates: keys, rate, bucket, n. Each task sends its counts, not its rows."""
    cells = F.array(*[F.struct(F.lit(name).alias("rate"), bucket(rate(name)).alias("bucket")) for name in RATES])
    return rows.select(*keys, F.explode(cells).alias("c")).groupBy(*keys, "c.rate", "c.bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches to ``keys`` and read the QUANTILES of every rate."""
    merged = cells.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    # a window over the buckets of one sketch: some 1,500 at most, whatever the data
    whole = W.partitionBy(*keys, "rate")
    summed = merged.withColumns({"upto": F.sum("n").over(whole.orderBy("bucket")), "texts": F.sum("n").over(whole)})
    reached = [F.min(F.when(F.col("upto") * 20 >= F.col("texts") * k, F.col("bucket"))).alias(q) for q, k in QUANTILES.items()]
    found = summed.groupBy(*keys, "rate", "texts").agg(*reached)
    return found.select(*keys, "rate", "texts", *[bucket_start(F.col(q)).alias(q) for q in QUANTILES])


def limits(cells: DataFrame, reach: int = REACH, prior_texts: int = PRIOR_TEXTS) -> DataFrame:
    """One row per (language, source) with ``<rate>_low`` and ``<rate>_high``."""
    own, language = quantiles(cells, ["_lang", "_source"]), quantiles(cells, ["_lang"])
    every = quantiles(cells, [])
    other = lambda df, tag: df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])
    both = own.join(other(language, "l"), F.col("_lang").eqNullSafe(F.col("l__lang")) & (F.col("rate") == F.col("l_rate")))
    both = both.join(other(every, "e"), F.col("rate") == F.col("e_rate"))
    # a group of n texts weighs n against PRIOR_TEXTS of its language, and so on: no jump at any size
    blend = lambda n, value, wider: f"(({n} * {value} + {prior_texts} * {wider}) DIV ({n} + {prior_texts}))"
    mixed = [F.expr(blend("texts", q, blend("l_texts", f"l_{q}", f"e_{q}"))).alias(q) for q in QUANTILES]
    both = both.select("_lang", "_source", "rate", *mixed)
    least = lambda side: F.create_map(*[F.lit(x) for name, r in RATES.items() for x in (name, r[side] or 0)])[F.col("rate")]
    low = F.col("q25") - reach * F.greatest(F.expr("(q50 - q15) DIV 2"), least(3))
    high = F.col("q75") + reach * F.greatest(F.expr("(q85 - q50) DIV 2"), least(4))
    both = both.withColumns({"low": low, "high": high})
    at = lambda name, side: F.max(F.when(F.col("rate") == name, F.col(side)))
    sides = [at(name, side).alias(f"{name}_{side}") for name, r in RATES.items() for side in (["low", "high"] if r[3] else ["high"])]
    return both.groupBy("_lang", "_source").agg(*sides)


def assess(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    reach: int = REACH,
    prior_texts: int = PRIOR_TEXTS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the counts, ``n_lines``, ``base_failed`` and ``kept``.

    A null text counts as empty (no words: ``base_failed``). Null languages and sources are
    groups of their own. Texts that fail the fixed rules take no part in the sketches. Rows
    are judged one by one, so repeated rows stay; columns of ``docs`` with the name of a
    result column are replaced. An empty table gives an empty result.

    The counts are made once and stored with their rows, since sketches and filter both
    need them; ``keep_text=False`` leaves the text out of that table and of the result.
    """
    rows = packed(docs).select(
        "_row",
        F.coalesce(F.col(f"_row.`{text}`"), F.lit("")).alias("_text"),
        F.col(f"_row.`{lang}`").alias("_lang"),
        F.col(f"_row.`{source}`").alias("_source"),
    )
    names = [*COUNTS, "n_lines"]
    row = F.col("_row") if keep_text else F.col("_row").dropFields(f"`{text}`")
    counted = stored(with_counts(rows).select(row.alias("_row"), "_lang", "_source", *names), "counts")
    passed = counted.select("_lang", "_source", *names).filter(~base_failed())
    # the sketches are small; the limits are read from their table, and the planner sees its size
    bounds = stored(limits(stored(sketch(passed, ["_lang", "_source"]), "sketch"), reach, prior_texts), "limits")
    bounds = bounds.withColumnsRenamed({"_lang": "_of_lang", "_source": "_of_source"})
    joined = counted.join(bounds, F.col("_lang").eqNullSafe(F.col("_of_lang")) & F.col("_source").eqNullSafe(F.col("_of_source")), "left")
    inside = F.lit(True)
    for name, r in RATES.items():
        inside &= rate(name) <= F.coalesce(F.col(f"{name}_high"), rate(name))
        if r[3]:
            inside &= rate(name) >= F.coalesce(F.col(f"{name}_low"), rate(name))
    added = {name: F.col(name) for name in names} | {"base_failed": base_failed(), "kept": ~base_failed() & inside}
    return unpacked(joined, docs if keep_text else docs.drop(text), added)
