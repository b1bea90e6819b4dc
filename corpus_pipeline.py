"""Documents through quality rules, near-dedup, decontamination, secret scans and
BPE encoding. Each stage is written as Parquet and read again by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricegrid.llm import bpe, decontaminate, near_dups, quality, secrets
from pricegrid.llm.common import read, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.kept_documents(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dups.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the secrets' kinds."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all documents with the digests of ids and decoded text."""
    return bpe.encoded_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("encoding", encode),
]

#: The stages on shingles, automata and tokenizers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
