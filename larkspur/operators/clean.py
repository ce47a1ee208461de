"""Cleaning and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import tabular as ft
from larkspur.functions.text import strip, to_number
from larkspur.operators.bounds import quoted

_NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)


def require_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Raise if a required column is absent; return the columns that are not in the list."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError("missing required columns: " + ", ".join(absent))
    return [c for c in df.columns if c not in required]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC)]


def replace_columns(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace existing columns in one projection, keeping the column order."""
    return df.select(*[changes[c].alias(c) if c in changes else quoted(c) for c in df.columns])


def trim_strings(df: DataFrame, null_literal: str | None = None) -> DataFrame:
    """Strip all text columns. ``null_literal`` writes a text in place of missing ones."""
    changes = {}
    for name in text_columns(df):
        value = strip(quoted(name))
        changes[name] = F.coalesce(value, F.lit(null_literal)) if null_literal is not None else value
    return replace_columns(df, changes)


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn the named columns, where present, into doubles; unreadable values into NULL."""
    kinds = {f.name: f.dataType for f in df.schema}
    changes = {}
    for name in columns:
        if name in kinds:
            is_number = isinstance(kinds[name], _NUMERIC)
            changes[name] = ft.without_nan(quoted(name)) if is_number else to_number(quoted(name))
    return replace_columns(df, changes)


def guard_range(df: DataFrame, columns: list[str], low: float = 0, high: float = 100) -> DataFrame:
    return replace_columns(df, {c: ft.in_range(quoted(c), low, high) for c in columns})


def invalid_counts(df: DataFrame, columns: list[str], low: float = 0, high: float = 100) -> DataFrame:
    """(column, invalid) with the number of values outside the range."""
    return _one_row_per_column(
        df, columns, "invalid", lambda c: F.count_if((quoted(c) < low) | (quoted(c) > high))
    )


def missing_counts(df: DataFrame, columns: list[str] | None = None, only_missing: bool = False) -> DataFrame:
    """(column, missing) in one pass; optionally only columns with missing values, sorted."""
    columns = columns or df.columns
    out = _one_row_per_column(df, columns, "missing", lambda c: F.count_if(quoted(c).isNull()))
    return out.where("missing > 0").orderBy(F.desc("missing"), "column") if only_missing else out


def column_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min_value, max_value)."""
    wide = df.agg(
        *[F.min(quoted(c)).cast("double").alias(f"min{i}") for i, c in enumerate(columns)],
        *[F.max(quoted(c)).cast("double").alias(f"max{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _one_row_per_column(df: DataFrame, columns: list[str], value: str, make) -> DataFrame:
    wide = df.agg(*[make(c).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias(value)) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def drop_all_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the rows in which every listed column is missing."""
    return df.dropna("all", subset=columns)


def duplicate_counts(df: DataFrame) -> DataFrame:
    """(total_rows, duplicate_rows): rows beyond the first of each set of equal rows."""
    copies = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; NULL keys are one group.

    The minimum is taken before the shuffle as well, so one key may have most rows.
    """
    position = F.struct(*[quoted(c) for c in order])
    first = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.min_by(F.struct(*[quoted(c) for c in df.columns]), position).alias("_row")
    )
    return first.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def keep_labels(df: DataFrame, label: str, positive: str = "Yes", negative: str = "No", target: str = "Churn") -> DataFrame:
    """Keep the rows with one of the two labels and add the 0/1 target."""
    kept = df.where(quoted(label).isin(positive, negative))
    return kept.withColumn(target, F.when(quoted(label) == positive, 1).otherwise(0))


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; absent ones are NULL."""
    return df.select(
        *[
            (quoted(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
