"""Grouped statistics with exact quantiles at any group size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.bounds import attach, checked_small, quoted
from larkspur.operators.ranks import running_totals

DISTINCT_LIMIT = 1_000_000

#: the plain statistics of a numeric column; ``x`` is the unpivoted value
STATS: dict[str, Callable[[Column], Column]] = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def tall(df: DataFrame, keys: list[str], columns: list[str], name: str = "column", value: str = "x") -> DataFrame:
    """Unpivot ``columns`` to (keys, name, value) rows; missing values stay in."""
    return df.select(*[quoted(k) for k in keys], *[quoted(c) for c in columns]).unpivot(
        [quoted(k) for k in keys], [quoted(c) for c in columns], name, value
    )


def summarize(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    stats: list[str],
    quantiles: dict[str, float] | None = None,
    distinct_limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """One row per (keys, column) with the named statistics and exact quantiles.

    Missing values are skipped and rows with a missing key are dropped. Quantiles are
    interpolated linearly. The built-in ``percentile`` holds all distinct values of a
    group in one task, so it is used only where their number is measured to be small;
    beyond that, distinct values are counted, put in order across partitions, and the
    two neighbours of each quantile are picked by their position.
    """
    quantiles = quantiles or {}
    values = tall(df.dropna("any", subset=keys) if keys else df, keys, [c for c in columns])
    values = values.withColumn("x", F.col("x").cast("double"))
    group = [*keys, "column"]
    group_columns = [quoted(k) for k in group]
    plain = [STATS[s]("x").alias(s) for s in stats]
    if not quantiles:
        return values.groupBy(*group_columns).agg(*plain)

    distinct = values.groupBy(*group_columns).agg(F.approx_count_distinct("x").alias("d"))
    if (distinct.agg(F.max("d")).first()[0] or 0) <= distinct_limit:
        wanted = F.percentile("x", F.array(*[F.lit(p) for p in quantiles.values()])).alias("_q")
        out = values.groupBy(*group_columns).agg(*plain, wanted)
        picks = [F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(quantiles)]
        return out.select(*group_columns, *stats, *picks)

    counts = values.where("x is not null").groupBy(*group_columns, "x").agg(F.count(F.lit(1)).alias("_n"))
    ordered = running_totals(counts, group, [F.col("x")], {"_upto": F.col("_n")}, max_rows=0)
    known = checked_small(values.groupBy(*group_columns).agg(F.count("x").alias("_total"), *plain))
    placed = attach(ordered, known.select(*group_columns, "_total"), group)
    picks, results = [], []
    for name, p in quantiles.items():
        at = F.lit(p) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(inside, F.col("x"))).alias(f"_{side}_{name}"))
        weight = at - F.floor(at)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((low * (1 - weight) + high * weight).alias(name))
    found = placed.groupBy(*group_columns).agg(F.max("_total").alias("_total"), *picks)
    found = found.select(*group_columns, *results)
    return attach(known.drop("_total"), found, group)
