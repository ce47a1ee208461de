"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import curve, divergence, forest, jaccard, lm_scores, mixing, planes, repeats, rules, suffix, toxicity, urls, whitening
from larkspur.llm.text import table

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_mixing": mixing.ORACLE, "op7_repeats": repeats.ORACLE, "op10_decontamination": suffix.ORACLE,
    "op12_curve_shards": curve.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    BUILDERS[build.__name__] = build
    return build


@register
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@register
def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.round_trip(table(spark, sf_dir, "documents"))


@register
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@register
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


@register
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score(table(spark, sf_dir, "documents"), lower=True)


@register
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.report(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@register
def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.report(table(spark, sf_dir, "embeddings"))


@register
def op12_curve_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve.report(table(spark, sf_dir, "documents"))


@register
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))
