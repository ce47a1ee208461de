"""Size checks that stand in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 20_000


def local_copy(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """``df`` as a local relation if it has at most ``max_rows`` rows, else None.

    Meant for narrow tables of results. Reads at most ``max_rows + 1`` rows; a table that
    passes is not computed again by what is built on it.
    """
    rows = df.limit(max_rows + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= max_rows else None


def checked_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Return ``df`` broadcast if it is measured to be small, else as it is."""
    copy = local_copy(df, max_rows)
    return df if copy is None else F.broadcast(copy)


def attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``small`` on NULL-safe ``keys`` and keep one copy of the keys."""
    renamed = small
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"`{key}`").eqNullSafe(F.col(f"`_right_{key}`"))
    return df.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def quoted(name: str) -> Column:
    """Column by exact name, also with spaces, dots or slashes in it."""
    return F.col(f"`{name}`")
