"""Documents to token ids in five stages, each written as Parquet before the next begins.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents. Texts are changed by what the stages decide: lines that fail the
rules go, copies go, personal data is replaced, sources are repeated or thinned out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, mixing, ngram_join, quality, surrogates
from tallyline.llm.storing import stored

# SQL cannot express byte-pair merges; tests hold every stage against a plain version.
ORACLE_SQL = None


def _with_text(df: DataFrame, text, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` with another text, and its length where documents carry one."""
    df = df.withColumn("text", text)
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    return df.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail."""
    kept = quality.rate(docs, with_text=True).where("kept")
    return _with_text(kept, F.col("kept_text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return ngram_join.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data."""
    return _with_text(surrogates.pseudonymise(docs), F.col("text"), docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, whole or in part."""
    taken = mixing.mixed_documents(mixing.mix(docs))
    return _with_text(taken, F.col("text"), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("pii_surrogates", personal_data),
    ("mix_sources", mixture),
    ("byte_level_bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return stored(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
