"""Evaluation of retrieval against expected sources, chunk-size comparison and rubrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.chunks import SWEEP, chunk_pages
from larkspur.operators.embed import Embedder
from larkspur.operators.search import MIN_SIMILARITY, TOP_K, search
from larkspur.session import durable

# Criteria of the answer rubric and the points for each.
CRITERIA = [
    "relevance", "grounding", "correctness", "completeness", "hallucination avoidance", "source references",
]
MAX_SCORE = 2


def judge(
    questions: DataFrame, hits: DataFrame, expected: DataFrame, query_id: str = "query_id",
    undefined: str = "fail",
) -> DataFrame:
    """(query_id, hits, passed, reason) for every question.

    Without an expectation row the question fails, or with ``undefined="unanswerable"``
    counts as one with no expected source. No expected source: passes with no hits.
    Otherwise: passes if a hit comes from an expected source.
    """
    found = hits.groupBy(query_id).agg(
        F.count(F.lit(1)).alias("hits"), F.collect_set(F.col("source").cast("string")).alias("sources")
    )
    rows = questions.select(query_id).join(found, query_id, "left").join(
        expected.select(query_id, "expected_sources"), query_id, "left"
    )
    rows = rows.withColumn("hits", F.coalesce("hits", F.lit(0)))
    wanted = F.col("expected_sources")
    if undefined == "unanswerable":
        wanted = F.coalesce(wanted, F.array().cast("array<string>"))
    matched = F.coalesce(F.arrays_overlap(wanted, F.col("sources")), F.lit(False))
    kind = (
        F.when(wanted.isNull(), "undefined question")
        .when((F.size(wanted) == 0) & (F.col("hits") == 0), "no hits, as expected")
        .when(F.size(wanted) == 0, "hits for an unanswerable question")
        .when(matched, "expected source found")
        .otherwise("expected source not found")
    )
    judged = rows.select(query_id, "hits", kind.alias("reason"))
    return judged.withColumn("passed", F.col("reason").isin("no hits, as expected", "expected source found"))


def pass_summary(judged: DataFrame, keys: list[str] = ()) -> DataFrame:
    """total, passed, failed and pass rate in percent (0 without questions)."""
    out = judged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )
    rate = F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(0.0))
    return out.withColumn("pass_rate", rate)


def chunk_size_sweep(
    pages: DataFrame, questions: DataFrame, expected: DataFrame, embedder: Embedder,
    configs: list[tuple[int, int]] = SWEEP, k: int = TOP_K, floor: float = MIN_SIMILARITY,
) -> DataFrame:
    """Per setting and question: chunks, hits, verdict and best source; one job for all settings.

    ``questions`` has query_id and question, ``expected`` query_id and expected_sources.
    An undefined question counts as unanswerable here.
    """
    chunks = durable(chunk_pages(pages, configs))  # read by the search and by the counts
    named = chunks.select(
        "source", "text",
        # Ties go by source and chunk number.
        F.concat("source", F.lit("\0"), F.lpad(F.col("chunk_number").cast("string"), 19, "0")).alias("chunk_id"),
        F.concat_ws("/", "chunk_size", "chunk_overlap").alias("setting"),
    )
    asked = embedder.embed(questions, "question", "embedding")
    stored = embedder.embed(named, "text", "embedding")
    hits = search(asked, stored, k, floor, within="setting", carry=["source"])

    found = hits.groupBy("setting", "query_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.collect_set("source").alias("sources"),
        F.max_by("source", F.struct(F.col("similarity_score"), -F.col("rank"))).alias("top_source"),
        F.max("similarity_score").alias("top_score"),
    )
    settings = F.explode(F.array(*[F.lit(f"{size}/{overlap}") for size, overlap in configs])).alias("setting")
    every = questions.select("query_id", settings).join(expected.select("query_id", "expected_sources"), "query_id", "left")
    rows = every.join(found, ["setting", "query_id"], "left")
    wanted = F.coalesce("expected_sources", F.array().cast("array<string>"))
    matched = F.coalesce(F.arrays_overlap(wanted, F.col("sources")), F.lit(False))
    passed = F.when(F.size(wanted) == 0, F.col("hits").isNull()).otherwise(matched)
    counts = named.groupBy("setting").agg(F.count(F.lit(1)).alias("chunks"))  # one row per setting
    parts = F.split("setting", "/")
    return rows.join(F.broadcast(counts), "setting", "left").select(
        parts[0].cast("int").alias("chunk_size"), parts[1].cast("int").alias("chunk_overlap"),
        F.coalesce("chunks", F.lit(0)).alias("chunks"), "query_id", F.coalesce("hits", F.lit(0)).alias("hits"),
        passed.alias("passed"), "top_source", "top_score",
    )


def sweep_summary(swept: DataFrame) -> DataFrame:
    """chunks and pass rate per setting."""
    return pass_summary(swept, ["chunk_size", "chunk_overlap", "chunks"])


def rubric_scores(scores: DataFrame) -> DataFrame:
    """Points per question from (question, criterion, score) rows.

    A score outside 0..2 is counted as invalid and earns nothing; a question is complete
    if every criterion has a valid score.
    """
    valid = F.col("score").between(0, MAX_SCORE)
    out = scores.groupBy("question").agg(
        F.coalesce(F.sum(F.when(valid, F.col("score"))), F.lit(0)).alias("points"),
        F.count_distinct(F.when(valid, F.col("criterion"))).alias("criteria"),
        F.count_if(~valid).alias("invalid"),
    )
    return out.select(
        "question", "points", F.lit(MAX_SCORE * len(CRITERIA)).alias("max_points"), "invalid",
        (F.col("criteria") == len(CRITERIA)).alias("complete"),
    )


def rubric_summary(per_question: DataFrame) -> DataFrame:
    """One row: questions, points, reachable points, share of complete questions."""
    return per_question.agg(
        F.count(F.lit(1)).alias("questions"),
        F.coalesce(F.sum("points"), F.lit(0)).alias("points"),
        F.coalesce(F.sum("max_points"), F.lit(0)).alias("max_points"),
        F.coalesce(F.avg(F.col("complete").cast("int")), F.lit(0.0)).alias("completion"),
    )


def top_hit(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """The best hit of each query."""
    return hits.where("rank = 1")
