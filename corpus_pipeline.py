"""Training-corpus pipeline: quality rules, near-dedup, secret redaction, mixing, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns the rows that the next stage reads. All but the last return the columns of
``documents``. ``run`` writes every stage's rows as Parquet in the shared folder and
reads them again for the next stage, so lost executors cost one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pubstrata.llm import mixing, near_dedup, packing, quality_rules, secrets
from pubstrata.llm.common import Scratch, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup.keep_one(docs, near_dedup.STAGE_PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets replaced by their kind."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by their source's target, in training order."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the tokenizer and the packing; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    rows = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = scratch.cut(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
