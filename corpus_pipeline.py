"""Corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

Language ID drops texts without a letter or far from every language profile for their length, exact and near deduplication keep one document
of each group, decontamination drops documents that hold a benchmark window, and BPE encodes what is left and decodes it again.
Every stage sees all that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, langid, near_dedup
from tidemark.llm.common import stage_table, table

#: Share of a language's mean closeness below which a text, if long enough to tell, is like no language. Random letters have
#: 0.03 to 0.05 of it, documents 0.3 or more.
LEAST_SHARE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, LEAST_SHARE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether the decoded bytes are the text's."""
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    text = F.coalesce(F.col("row.text").cast("binary"), F.lit("").cast("binary"))
    return coded.select(
        "row.doc_id", "row.lang", "row.source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), (F.col("decoded") == text).alias("round_trip")
    )


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

#: Language profiles and near-duplicate classes have no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
