"""Column profiles, rates and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.bounds import attach, checked_small, quoted
from larkspur.operators.clean import numeric_columns
from larkspur.operators.ranks import running_totals
from larkspur.operators.summaries import summarize, tall


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a given order."""
    return df.orderBy(*[quoted(c) for c in order]).limit(rows)


def quality_report(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, data_type, missing_values, unique_values); missing is no value.

    One pass to (column, value) pairs, counted before the shuffle, so columns with few
    values move few rows. ``approximate`` counts distinct values with bounded sketches.
    """
    kinds = dict(df.dtypes)
    named = F.create_map(*[F.lit(v) for pair in kinds.items() for v in pair])
    if approximate:
        wide = df.agg(
            *[F.count_if(quoted(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
            *[F.approx_count_distinct(quoted(c)).alias(f"u{i}") for i, c in enumerate(df.columns)],
        )
        rows = [
            F.struct(
                F.lit(c).alias("column"), F.lit(kinds[c]).alias("data_type"),
                F.col(f"m{i}").alias("missing_values"), F.col(f"u{i}").alias("unique_values"),
            )
            for i, c in enumerate(df.columns)
        ]
        return wide.select(F.inline(F.array(*rows)))
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in df.columns])
    pairs = tall(texts, [], df.columns).groupBy("column", "x").agg(F.count(F.lit(1)).alias("_n"))
    report = pairs.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("_n"))), F.lit(0)).alias("missing_values"),
        F.count("x").alias("unique_values"),
    )
    return report.select("column", named[F.col("column")].alias("data_type"), "missing_values", "unique_values")


def constant_features(df: DataFrame, candidates: list[str]) -> DataFrame:
    """(feature, is_constant) of the candidates present: at most one distinct value.

    Minimum equal to maximum says the same as a distinct count of at most one, and needs
    no shuffle of the values.
    """
    present = [c for c in candidates if c in df.columns]
    wide = df.agg(
        *[F.min(quoted(c)).eqNullSafe(F.max(quoted(c))).alias(f"k{i}") for i, c in enumerate(present)]
    )
    rows = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("feature"), F.col(f"k{i}").alias("is_constant"))
        for i, c in enumerate(present)
    ]
    return wide.select(F.inline(F.array(*rows)))


def select_features(
    df: DataFrame, categorical: list[str], numeric: list[str], leakage: list[str]
) -> tuple[list[str], list[str], list[str]]:
    """(categorical, numeric, constant) features in candidate order; leaks are refused."""
    leaks = [c for c in [*categorical, *numeric] if c in leakage]
    if leaks:
        raise ValueError("features that leak the outcome: " + ", ".join(leaks))
    rows = constant_features(df, [*categorical, *numeric]).collect()
    constant = {r["feature"] for r in rows if r["is_constant"]}
    varying = {r["feature"] for r in rows if not r["is_constant"]}
    return (
        [c for c in categorical if c in varying],
        [c for c in numeric if c in varying],
        [r["feature"] for r in rows if r["feature"] in constant],
    )


def describe(df: DataFrame, columns: list[str], digits: int | None = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    out = summarize(
        df, [], columns, ["count", "mean", "std", "min", "max"], {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    return out if digits is None else _rounded(out, ["mean", "std", "min", "q25", "q50", "q75", "max"], digits)


def _rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return df.select(*[F.bround(quoted(c), digits).alias(c) if c in columns else quoted(c) for c in df.columns])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) without missing values, largest first within a column."""
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    counts = tall(texts, [], columns, "column", "value").where("value is not null")
    return counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")).orderBy(
        "column", F.desc("count"), "value"
    )


def group_stats(df: DataFrame, key: str, column: str, digits: int = 2, by_mean: bool = False) -> DataFrame:
    """Count, mean and median of a column per group.

    With ``by_mean`` the groups get their ``position`` by the mean before it is rounded.
    """
    out = summarize(df, [key], [column], ["count", "mean"], {"median": 0.5}).drop("column")
    if by_mean:
        out = running_totals(out, [], [F.desc("mean"), quoted(key)], {"position": F.lit(1)})
    return _rounded(out, ["mean", "median"], digits)


def group_means(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(dimension, level, mean) for several dimensions in one job."""
    return rates(df, keys, column).select("dimension", "level", F.col("rate").alias("mean"))


def rates(df: DataFrame, dimensions: list[str], target: str) -> DataFrame:
    """(dimension, level, rate, count) of a 0/1 or numeric target, all dimensions at once.

    Missing levels are dropped, ``count`` counts present targets. The rows are unpivoted
    and averaged before the shuffle, which then carries one row per level and task.
    """
    texts = df.select(quoted(target).alias("_target"), *[quoted(c).cast("string").alias(c) for c in dimensions])
    levels = tall(texts, ["_target"], dimensions, "dimension", "level").where("level is not null")
    return levels.groupBy("dimension", "level").agg(
        F.avg("_target").alias("rate"), F.count("_target").alias("count")
    )


def ranked_rates(rated: DataFrame) -> DataFrame:
    """Give each level its place by rate, highest first."""
    order = [F.desc("rate"), F.col("level")]
    return running_totals(rated, ["dimension"], order, {"place": F.lit(1)})


def rate_extremes(rated: DataFrame, pair_dimension: str | None = None, pair: tuple[str, str] = ("Yes", "No")) -> DataFrame:
    """Highest and lowest level per dimension with the kind of statement it supports.

    ``limited`` where only one level occurs, ``extremes`` otherwise. ``pair_dimension``
    needs both named levels and is reported as ``pair`` with their two rates.
    """
    high = F.max_by("level", F.struct(F.col("rate"), F.col("level")))
    low = F.min_by("level", F.struct(F.col("rate"), F.col("level")))
    out = rated.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("levels"),
        high.alias("highest"),
        F.max("rate").alias("highest_rate"),
        low.alias("lowest"),
        F.min("rate").alias("lowest_rate"),
        F.max(F.when(F.col("level") == pair[0], F.col("rate"))).alias("first_rate"),
        F.max(F.when(F.col("level") == pair[1], F.col("rate"))).alias("second_rate"),
    )
    both = F.col("first_rate").isNotNull() & F.col("second_rate").isNotNull()
    is_pair = F.col("dimension") == F.lit(pair_dimension)
    kind = (
        F.when(F.col("levels") == 1, "limited")
        .when(is_pair & both, "pair")
        .when(is_pair, "limited")
        .otherwise("extremes")
    )
    return out.select(
        "dimension", "levels", kind.alias("kind"), "highest", "highest_rate", "lowest", "lowest_rate",
        F.when(is_pair, F.col("first_rate")).alias("first_rate"),
        F.when(is_pair, F.col("second_rate")).alias("second_rate"),
    )


def column_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean) of several columns."""
    return summarize(df, [], columns, ["mean"])


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] with the last bin closed; empty bins are kept."""
    x = quoted(column).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    bucket = F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins))
    number = F.when(bucket > bins, F.lit(bins).cast("long")).otherwise(bucket)  # the maximum is in the last bin
    counts = dict(df.groupBy(number.alias("bin")).count().collect())  # at most one row per bin, and one for NULL
    width = (high - low) / bins
    rows = [(b, low + (b - 1) * width, low + b * width, counts.get(b, 0)) for b in range(1, bins + 1)]
    return df.sparkSession.createDataFrame(rows, "bin bigint, low double, high double, count bigint")


def boxplot(df: DataFrame, key: str, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outliers per group."""
    values = df.select(quoted(key), quoted(column).cast("double").alias("x")).dropna()
    boxes = summarize(values, [key], ["x"], ["count"], {"q1": 0.25, "median": 0.5, "q3": 0.75}).drop("column")
    span = F.col("q3") - F.col("q1")
    boxes = boxes.withColumn("_low", F.col("q1") - reach * span).withColumn("_high", F.col("q3") + reach * span)
    boxes = checked_small(boxes)
    inside = F.col("x").between(F.col("_low"), F.col("_high"))
    ends = attach(values, boxes.select(quoted(key), "_low", "_high"), [key]).groupBy(quoted(key)).agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return attach(boxes.drop("_low", "_high"), ends, [key])


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, min, max, median)."""
    out = summarize(df, [], columns, ["min", "max"], {"median": 0.5})
    return out.withColumnRenamed("column", "feature")


def level_profile(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """(feature, position, value): the distinct values of each column as first seen."""
    kept = df.select(quoted(order).alias("_order"), *[quoted(c).cast("string").alias(c) for c in columns])
    levels = tall(kept, ["_order"], columns, "feature", "value").where("value is not null")
    first = levels.groupBy("feature", "value").agg(F.min("_order").alias("_first"))
    placed = running_totals(first, ["feature"], [F.col("_first"), F.col("value")], {"position": F.lit(1)})
    return placed.select("feature", "position", "value")


def feature_profile(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """One frame with the numeric ranges and the categorical levels of all features."""
    numbers = [c for c in columns if c in numeric_columns(df)]
    texts = [c for c in columns if c not in numbers]
    empty = F.lit(None)
    numeric = numeric_profile(df, numbers).select(
        "feature", F.lit("numeric").alias("type"), F.lit(0).cast("long").alias("position"),
        empty.cast("string").alias("value"), "min", "max", "median",
    )
    levels = level_profile(df, texts, order).select(
        "feature", F.lit("categorical").alias("type"), F.col("position").cast("long").alias("position"), "value",
        *[empty.cast("double").alias(n) for n in ("min", "max", "median")],
    )
    return numeric.unionByName(levels)


def majority_baseline(df: DataFrame, target: str) -> DataFrame:
    """Accuracy of always predicting the more frequent class."""
    share = F.avg(quoted(target))
    return df.agg(share.alias("positive_rate"), F.greatest(share, 1 - share).alias("baseline_accuracy"))
