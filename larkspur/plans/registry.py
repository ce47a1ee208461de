"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def keep(build: Build) -> Build:
        BUILDERS[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return keep


def r(column: str | Column, digits: int = 6) -> Column:
    """Half-even rounding under the same name, for results compared across engines."""
    if isinstance(column, str):
        return F.bround(F.col(f"`{column}`").cast("double"), digits).alias(column)
    return F.bround(column, digits)
