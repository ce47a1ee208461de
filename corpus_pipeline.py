"""A corpus pipeline: each stage applies one operator of ``larkspur.llm`` to all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import jaccard, mixing, planes, suffix, toxicity
from larkspur.llm.text import table
from larkspur.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies of the pipeline: words of a shingle, and the least similarity in percent.
SHINGLE, PERCENT = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of the toxicity model."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of linked shingle sets."""
    return jaccard.first_of_each(docs, size=SHINGLE, percent=PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return suffix.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source comes near its target share."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the written files hold each document, and the checksum of its ids there."""
    return planes.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", one_per_group),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: Trained weights and binary files are not SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "corpus-pipeline")
    for position, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{position}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
