"""From raw documents to a training mix, in five stages.

Each stage works on all documents that the one before kept. ``run`` writes a stage's
documents to the shared folder and reads them back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlane.llm import decontamination, mixing, near_duplicates, quality, secret_scan
from marketlane.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more stay; taught by the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out())
    return quality.keep_good(docs, quality.fit(docs, labels))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_duplicates.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or paraphrased, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by their kind."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return secret_scan.redacted(docs, length=length)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes and its place in training, in that order."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicate_removal),
    ("decontamination", benchmark_decontamination),
    ("secrets", secret_redaction),
    ("mixing", source_mixing),
]

#: Nearest-neighbour votes, signatures and latent retrieval have no SQL; the tests compare
#: ``run`` with a plain Python version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
