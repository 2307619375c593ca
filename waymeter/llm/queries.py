"""The registered queries of the operators: the thin digests of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waymeter.llm import exact, mixing, near, pieces, privacy, quality, ranking, secrets, suffixes, tokens, trie, urls, warc
from waymeter.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2)
    of = lambda field: F.transform("samples", lambda s: s[field])
    return coded.select(
        "doc_id", "n_pieces", "decoded_equal", of("n_pieces").alias("sample_pieces"), of("log_p").alias("sample_log_p"),
        of("log_inclusion").alias("sample_log_inclusion"), of("digest").alias("sample_digests"), "ids", of("ids").alias("sample_ids"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, vocabulary).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _span_digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    own: Column = F.filter("spans", lambda s: s["kind"].isin(*base))
    digest = F.sha2(F.encode(secrets.joined_spans(own), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *[of(kind) for kind in base], digest, secrets.joined_spans(F.col("spans")).alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digest(privacy.sanitise(docs, keep_text=False), privacy.KINDS[: privacy.BASE])


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.tracked(pages)).select("page_id", "host", "path", "rule", "listed", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.assess(docs, keep_text=False).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digest(secrets.scan(docs, keep_text=False), tuple(rule.kind for rule in secrets.RULES[: secrets.BASE]))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = near.find_groups(docs, size=3, percent=85, keep_text=False)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


#: Weights of the domains in the registered query.
TARGETS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels"), TARGETS, keep_text=False)
    parts = [F.col("posterior")[i].alias(f"p_{name}") for i, name in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *parts, "rate", "copies")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.find_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffixes.remove_repeats(docs, length=100, keep_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranking.search(docs, table(spark, sf_dir, "benchmark"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_counts": op2_token_counts,
    "op3_pii": op3_pii,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_secret_scans": op7_secret_scans,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_ranked_search": op13_ranked_search,
}
