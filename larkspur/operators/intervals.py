"""Join of intervals that overlap, by bins.

Every interval is listed in the bins it touches, sides meet per (key, bin), and of the bins that
a pair shares only the first one keeps it. A bin holds what starts in or crosses one stretch of
a key, so one key with most of the intervals is spread over its bins. The width of a bin is
given, or the mean length of the longer side's intervals, which bounds how often a row is
listed on average; an interval far longer than that is listed along its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.bounds import quoted


def bin_width(*sides: DataFrame, start: str = "start", end: str = "end") -> int:
    """The largest mean length of the sides' intervals, at least 1."""
    lengths = [side.agg(F.avg(F.col(end) - F.col(start))).first()[0] or 0 for side in sides]
    return max(1, round(max(lengths)))


def overlapping(
    left: DataFrame, right: DataFrame, keys: list[str], width: int | None = None, start: str = "start", end: str = "end",
) -> DataFrame:
    """Pairs of rows with equal keys whose half-open intervals [start, end) share a point.

    Columns other than the keys come as the structs ``left`` and ``right``, and ``shared`` is the
    length in common. Empty intervals, missing ends and missing keys join nothing.
    """
    width = width or bin_width(left, right, start=start, end=end)

    def listed(side: DataFrame, name: str) -> DataFrame:
        whole = side.where(F.col(start) < F.col(end))
        first, last = (F.floor(c / F.lit(width)) for c in (F.col(start), F.col(end) - 1))
        others = F.struct(*[quoted(c) for c in side.columns if c not in keys]).alias(name)
        return whole.select(*[quoted(k) for k in keys], F.explode(F.sequence(first, last)).alias("_bin"), others)

    def of(name: str, column: str) -> Column:
        return F.col(name)[column]

    met = listed(left, "left").join(listed(right, "right"), [*keys, "_bin"])
    begins = F.greatest(of("left", start), of("right", start))
    ends = F.least(of("left", end), of("right", end))
    kept = met.where((begins < ends) & (F.floor(begins / F.lit(width)) == F.col("_bin")))
    return kept.select(*[quoted(k) for k in keys], "left", "right", (ends - begins).alias("shared"))
