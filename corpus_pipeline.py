"""Corpus cleaning as five stages over ``documents``: quality classifier,
quality rules, SimHash near-dedup, secret scans, packing.

Every stage but the last returns the columns of its input.  ``run`` writes
each stage's rows as a Parquet table in the shared folder and reads them back
as the next stage's input, so a lost executor repeats at most one stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thermocline.llm import classifier, packing, rules, secrets, simhash
from thermocline.llm.common import staged
from thermocline.sources.tables import load


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the others go."""
    return classifier.resample(docs, load(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.passing(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of smallest doc_id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each found secret replaced by a mask."""
    return secrets.redact_secrets(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in 2048-token windows."""
    return packing.pack(docs, with_ids=True)


STAGES = [("quality classifier", quality_classifier), ("quality rules", quality_rules),
          ("SimHash near-dedup", simhash_dedup), ("secret scans", secret_scan), ("packing", pack_windows)]

#: Fingerprints, the fitted draw and the differencing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
