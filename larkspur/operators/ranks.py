"""Running totals and positions that hold when one group has most of the rows.

A plain window puts a whole group into one task. The two forms here split a group:

* ``block_running_totals`` for integer positions: blocks of the position, totals per
  block, a window over the few block totals and a window inside each block.
* ``running_totals`` for any order: a plain window where the frame or its largest group
  is measured to be small, otherwise a range partitioning written to the checkpoint
  folder, with totals per partition in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.bounds import SMALL_ROWS, attach, checked_small, local_copy, quoted
from larkspur.session import durable

WINDOW_ROWS = 1_000_000
BLOCK = 4096


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group; counted with map-side partial aggregation."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    totals: dict[str, Column],
    max_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add, per group of ``keys``, inclusive running sums in the given order.

    The order must be total inside a group. Groups of any size are handled; those above
    ``max_rows`` never meet in one task. Meant for narrow frames, such as counts.
    """
    key_columns = [quoted(k) for k in keys]
    small = local_copy(df, min(max_rows, SMALL_ROWS)) if max_rows else None
    df = small if small is not None else durable(df)  # several reads follow
    if small is not None or largest_group(df, keys) <= max_rows:
        window = (Window.partitionBy(*key_columns) if keys else Window.partitionBy(F.lit(0))).orderBy(*order)
        window = window.rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(window).alias(n) for n, c in totals.items()])

    # Written out, so that each row stays in its partition whatever is run again.
    parts = durable(
        df.repartitionByRange(*key_columns, *order).withColumn("_part", F.spark_partition_id())
    )
    sums = parts.groupBy(*key_columns, "_part").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    before = (Window.partitionBy(*key_columns) if keys else Window.partitionBy(F.lit(0))).orderBy("_part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        *key_columns,
        "_part",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in totals],
    )
    local = Window.partitionBy(*key_columns, "_part").orderBy(*order)
    local = local.rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.select("*", *[F.sum(c).over(local).alias(f"_local_{n}") for n, c in totals.items()])
    joined = attach(summed, checked_small(base), [*keys, "_part"])
    return joined.select(
        *[quoted(c) for c in df.columns],
        *[(F.col(f"_local_{n}") + F.col(f"_base_{n}")).alias(n) for n in totals],
    )


def block_running_totals(
    df: DataFrame,
    keys: list[str],
    position: str,
    totals: dict[str, Column],
    block: int = BLOCK,
) -> DataFrame:
    """Running sums per group in the order of a unique non-negative integer column.

    One task sees at most ``block`` rows of a group, and the window over block totals
    sees one row per ``block`` positions. No action, no checkpoint.
    """
    # Keys without NULL, so that the window and the join below share one partitioning.
    plain_keys = [f"_key_{i}" for i in range(len(keys))] + [f"_null_{i}" for i in range(len(keys))]
    values = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in keys] + [quoted(k).isNull() for k in keys]
    blocked = df.select("*", *[value.alias(name) for value, name in zip(values, plain_keys)])
    blocked = blocked.withColumn("_block", quoted(position) - quoted(position) % F.lit(block))
    sums = blocked.groupBy(*plain_keys, "_block").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    before = Window.partitionBy(*plain_keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        *plain_keys,
        "_block",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in totals],
    )
    local = Window.partitionBy(*plain_keys, "_block").orderBy(quoted(position))
    local = local.rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.select("*", *[F.sum(c).over(local).alias(f"_local_{n}") for n, c in totals.items()])
    return summed.join(base, [*plain_keys, "_block"]).select(
        *[quoted(c) for c in df.columns],
        *[(F.col(f"_local_{n}") + F.col(f"_base_{n}")).alias(n) for n in totals],
    )
