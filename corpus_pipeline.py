"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing,
and byte-level BPE.  Every stage works on all documents its predecessor kept;
each result is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.llm import bpe, common, mixing, neardup, pii, quality, registry


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much of their text."""
    return quality.clean(docs)


NEAR_PERCENT = 80  # of the five-word windows of two documents; op2's contract has its own


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return neardup.deduplicate(docs, percent=NEAR_PERCENT)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become marks such as ``[EMAIL]``."""
    return pii.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each drawn document, with a digest of what they decode to."""
    path, pattern = registry.tokenizer()
    tokens = bpe.round_trip(docs, path, pattern)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                         F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
    ("bpe", bpe_stage),
]

# Several stages (MinHash, boosted trees, sampling by hash, BPE) have no SQL form;
# the tests hold run() against plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
