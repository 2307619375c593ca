"""The corpus pipeline: quality rules, exact and near duplicates, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept. All but the
last return the columns of ``documents``; a stage's result is written as Parquet and
read again as the documents of the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from waymeter.llm import exact, mixing, near, pieces, quality
from waymeter.llm.bloom import split
from waymeter.llm.common import stored, table

#: Shares of the domains in the tokens kept.
TARGETS = {"good": 0.97, "poor": 0.029, "toxic": 0.001}


def named_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with a digest of the text: id and text decide what a stage below does with a row, and stand for it without the text."""
    return docs.withColumn("_digest", F.unhex(F.sha2("text", 256)))


def without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """``docs`` less the rows with an id and text of ``dropped`` (doc_id, _digest).

    Texts are shuffled only of rows whose id may be among those dropped.
    """
    gone = stored(dropped.select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_of")).distinct(), name)
    possible, clear = split(docs, F.col("doc_id"), gone, "_id")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_digest").eqNullSafe(F.col("_of"))
    return clear.unionByName(named_texts(possible).join(gone, same, "left_anti").drop("_digest"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the fixed rules nor the limits of their language and source reject.

    Null and empty texts go, having no words; repeated rows are judged alike; an empty table stays empty.
    """
    return quality.assess(docs).filter("kept").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id.

    Null texts equal empty ones; of rows that repeat an id and a text one stays; an empty table stays empty.
    """
    return exact.find_copies(docs).filter("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8), the document with the smallest id.

    Null and empty texts are like nothing and stay, as do rows without an id; an empty table stays empty.
    """
    return without(docs, near.find_groups(named_texts(docs), keep_text=False).filter("NOT kept"), "near-copies")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates up to 1, so that their tokens have the shares TARGETS."""
    mixed = mixing.mix(named_texts(docs), table(spark, sf_dir, "labels"), TARGETS, keep_text=False, once=True)
    return without(docs, mixed.filter("copies = 0"), "undrawn")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, whether they decode to its text, and two segmentations sampled for its row with their inclusion.

    Null and empty texts have no ids; repeated rows have the same samples; an empty table stays empty.
    """
    coded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2)
    return coded.selectExpr("doc_id", "lang", "source", "n_pieces", "ids", "decoded_equal", "transform(samples, s -> s.ids) AS sampled_ids", "transform(samples, s -> s.log_p) AS sampled_log_p", "transform(samples, s -> s.log_inclusion) AS sampled_log_inclusion")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: The classifier and the sampler are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
