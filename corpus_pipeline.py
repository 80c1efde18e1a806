"""A training-corpus pipeline of five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on, with
the columns of ``documents``; the last returns the token-id directory. ``run``
writes every stage's rows to the shared folder and reads them back, so a lost
executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortcraft.llm import decontaminate, mixing, near_dup, quality_rules
from cohortcraft.llm.queries import table, token_ids
from cohortcraft.llm.storage import written
from cohortcraft.llm.workers import ship_package

NEAR_PERCENT = 85
"""Similarity of the near-dedup stage, in percent of five-word shingles: op5's contract."""


TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}
"""Token shares of the mixing stage; toxic text is drawn down to what its classifier cannot tell from the rest."""


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return quality_rules.without_rejected(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, at op5's similarity so that stage and query agree."""
    ship_package(spark)
    return near_dup.without_near_duplicates(docs, percent=NEAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that stay when domains are brought to their target token shares."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), TARGETS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in indexed shards; one row per document read back from them."""
    ship_package(spark)
    return token_ids(spark, docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

# Near-duplicate components, the classifier's posteriors and subword ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
