"""Mixing sources to target weights.

Words are summed per source, each source gets a target, and a document is emitted
floor(rate) times plus one more copy with the probability of the fraction, drawn from a
hash of its id, so reruns agree.

Only per-source sums meet: the sums combine before their shuffle, so one source may hold
most rows. The table of sources is ranked and capped with distributed aggregates, and is
joined by broadcast only while it is measured to be small.

Defined cases: a missing text has size 0; a missing source is a source of its own, ranked
last; sources without words get rate 0; a document without an id draws by its text; rows
with equal ids share one draw; an empty table gives an empty mix. Extra columns are kept
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.text import unit_hash, word_count
from larkspur.operators.bounds import checked_small
from larkspur.operators.ranks import running_totals
from larkspur.session import durable

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target and rate from rows of (source, size).

    All targets together are all words. A target stops at ``max_repeats`` times its
    source's size; the excess goes to the others by weight until none is above, which
    leaves every open source at the same words per unit of weight (``share``).
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(sources, [], [F.col("source").asc_nulls_last()], {"position": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    ranked = durable(ranked.select("source", "source_size", weight.cast("long").alias("weight")))

    cap = F.col("source_size") * max_repeats
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, closed_before = 0.0, -1
    while True:  # more sources close with each round; ends when none is added
        closed = cap <= F.lit(share) * F.col("weight")
        row = ranked.agg(
            F.count_if(closed).alias("closed"),
            F.sum(F.when(closed, cap)).alias("capped"),
            F.sum(F.when(~closed, F.col("weight"))).alias("open_weight"),
        ).first()
        if row["closed"] == closed_before or not row["open_weight"]:
            break
        closed_before = row["closed"]
        share = float(total - (row["capped"] or 0)) / float(row["open_weight"])
    target = F.when(cap <= F.lit(share) * F.col("weight"), cap.cast("double")).otherwise(F.lit(share) * F.col("weight"))
    size = F.col("source_size")
    return ranked.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(size > 0, F.col("target") / size).otherwise(F.lit(0.0))
    )


def copies(rate: Column, doc_id: Column, text_key: Column, seed: str = SEED) -> Column:
    """How often a document is emitted at this rate."""
    drawn = unit_hash(F.lit(seed), F.coalesce(doc_id.cast("string"), text_key))
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _with_rate(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` (with source) and the rate table, joined on sources that may be missing."""
    right = checked_small(table.withColumnRenamed("source", "rate_source"))
    return rows.join(right, F.col("source").eqNullSafe(F.col("rate_source"))).drop("rate_source")


def draws(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies."""
    key = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    narrow = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")))
    joined = _with_rate(narrow, targets(narrow, weights, max_repeats))
    return joined.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), F.col("key"), seed)).drop("key")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with all their columns."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    table = targets(sizes, weights, max_repeats)
    rows = docs.select(F.col("source"), F.struct("*").alias("row"))
    key = F.md5(F.coalesce(F.col("row.text"), F.lit("")))
    taken = _with_rate(rows, table).withColumn("copies", copies(F.col("rate"), F.col("row.doc_id"), key, seed))
    repeated = taken.select(F.explode(F.array_repeat(F.col("row"), F.col("copies"))).alias("row"))
    return repeated.select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``draws``: what the mix takes of every document."""
    return draws(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3 * source_size AS cap,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
    (SELECT sum(source_size) FROM sources) AS total
  FROM sources),
shared AS (
  SELECT coalesce(max((total - capped)::DOUBLE / open_weight::DOUBLE), 0) AS share FROM ordered),
rated AS (
  SELECT source, source_size, CASE WHEN cap <= share * weight THEN cap::DOUBLE ELSE share * weight END AS target FROM ordered, shared),
drawn AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM drawn
"""
