"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token file.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet to the shared folder and read again as
the next stage's ``docs``.

Edge cases, in every stage: rows with null ids, texts, languages or sources, empty and very long texts,
repeated rows and extra columns (maps too) are handled as the operators' docstrings say, and all columns are
carried to the last stage.  Quality rules drop null and empty texts (fewer than 50 words); of repeated
rows one stays; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import common, decontamination, mixing, quality_rules, simhash, token_planes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 4)."""
    return quality_rules.accepted_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (operator 1)."""
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window (operator 6)."""
    return decontamination.decontaminate(docs, common.documents(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or dropped so that sources meet their targets (operator 8)."""
    return mixing.mixed_documents(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as a token-id file, read back (operator 5)."""
    return token_planes.read_documents(token_planes.write_token_file(docs))


STAGES = [(name, common.with_package(step)) for name, step in (
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_file),
)]

# Fingerprints, robust covariances and tokenization have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; returns the last stage's written rows."""
    docs = common.documents(spark, sf_dir)
    for name, step in STAGES:
        docs = common.stage(step(spark, docs, sf_dir), name.split()[0].lower())
    return docs
