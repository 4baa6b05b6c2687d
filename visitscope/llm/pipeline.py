"""Stages of the corpus pipeline and the loop that runs them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, piece_encoding, simhash, substring_dedup, toxicity
from .catalog import PIECE_MODEL, tokenizer_path
from .common import drop_staged, read_table, staged, staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels of these documents, does not reject."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every SimHash component."""
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that smaller ids hold; `n_chars` follows the text."""
    kept = substring_dedup.dedup(docs)
    length = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return kept.select(*(length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in kept.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and hashes of every document that is left."""
    return piece_encoding.encode_digest(docs, tokenizer_path(PIECE_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("simhash near-dedup", drop_near_duplicates), ("substring dedup", cut_repeats),
    ("decontamination", drop_contaminated), ("piece encoding", encode_pieces)]


def run_stages(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    """The stages one after another over `documents`; once a stage's table is written, what only it has read is dropped."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(stages):
        if k + 1 == len(stages):
            return stage(spark, docs, sf_dir)
        with staging() as written:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{k + 1}")
        drop_staged(spark, [*before, *written[:-1]])
        before = written[-1:]
    return docs
