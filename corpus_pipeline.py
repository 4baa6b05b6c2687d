"""Corpus pipeline: documents through the operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitscope.llm.pipeline import STAGES, run_stages

# Learned toxicity scores and fingerprint components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each one written and read by the next."""
    return run_stages(spark, sf_dir, STAGES)
