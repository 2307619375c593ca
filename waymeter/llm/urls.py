"""URL filters: host rules, then a list of canonical URLs behind a blocked Bloom filter.

The list is turned into a Bloom filter whose keys each set eight bits of one 256-bit
block, so a probe is one lookup. Pages that pass are possible hits; an exact hash join
with the list removes the false ones. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymeter.llm.bloom import BITS_PER_KEY, BROADCAST_BLOCKS, blocks_for, bloom_blocks, probed
from waymeter.llm.common import ascii_lower, packed, stored, unpacked

#: (action, host, path), fixed values
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling for the variants of a page: no scheme, query, fragment, ``www.``, ``m.``, ``.html`` or last slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html?|/)\z", ""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host`` + ``path``, and its action; null where none fits."""
    rule = action = F.lit(None).cast("string")
    # the longest is tested first, so it is put in last
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule, action = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(action)
    return rule, action


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    url: str = "url",
    bits_per_key: int = BITS_PER_KEY,
) -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict.

    ``listed`` has the URLs to block in a column ``url``, in any spelling; null ones and
    repeats are ignored. A rule decides where one fits; else the list does: block if the
    canonical URL is on it, allow otherwise. A null URL, or one without ``://``, has an
    empty host and path and is never listed. Columns of ``pages`` with the name of a result
    column are replaced; rows are never merged, so repeated rows stay.

    The filter takes ``bits_per_key`` bits for each listed URL. It is broadcast only up to
    BROADCAST_BLOCKS blocks; a larger one is joined by block.
    """
    names = stored(
        listed.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("_name")).filter("_name > ''").distinct(), "listed"
    )
    blocks = blocks_for(names.count(), bits_per_key)
    bloom = bloom_blocks(names, "_name", blocks)
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    place = F.col(f"_row.`{url}`")
    rows = packed(pages).withColumns({"_host": host_of(place), "_path": path_of(place)})
    rows = rows.withColumn("_page", canonical(F.col("_host"), F.col("_path")))
    beside, hit = probed(rows, F.col("_page"), bloom, blocks)
    pages_hit = beside.select("_row", "_host", "_path", "_page", ((F.col("_page") > "") & hit).alias("_hit"))
    possible, clear = pages_hit.filter("_hit"), pages_hit.filter("NOT _hit").withColumn("_listed", F.lit(False))
    checked = possible.join(names.withColumnRenamed("_name", "_known"), F.col("_page") == F.col("_known"), "left")
    checked = checked.withColumn("_listed", F.col("_known").isNotNull()).drop("_known")
    judged = checked.unionByName(clear)
    rule, action = matching_rule(F.col("_host"), F.col("_path"), rules)
    by_list = F.when(F.col("_listed"), "block").otherwise("allow")
    return unpacked(
        judged, pages, {"host": F.col("_host"), "path": F.col("_path"), "rule": rule, "listed": F.col("_listed"), "verdict": F.coalesce(action, by_list)}
    )


def tracked(pages: DataFrame, url: str = "url") -> DataFrame:
    """URLs published with a tracking parameter: the list of the registered query."""
    return pages.filter(F.col(url).rlike(r"[?&]utm_[a-z]+=")).select(F.col(url).alias("url"))
