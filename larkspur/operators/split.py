"""Exact train/test splits by hashed id, without moving the rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.bounds import attach, checked_small, quoted
from larkspur.operators.ranks import running_totals

STEP = 3  # hex digits per narrowing step: 4096 counts per class
COUNT_ROWS = 200_000  # counts read by the driver in one step
FINAL_ROWS = 10_000  # hashes of one class read in the last step
HASH_LENGTH = 32


def _shares(sizes: dict, fraction: float) -> dict:
    """Test rows per class: floor of the share, the rest to the largest remainders."""
    total = sum(sizes.values())
    wanted = math.ceil(fraction * total)
    quotas = {k: n * wanted // total for k, n in sizes.items()}
    rests = {k: n * wanted % total for k, n in sizes.items()}
    short = wanted - sum(quotas.values())
    order = sorted(sizes, key=lambda k: (-rests[k], -sizes[k], (k is not None, k)))
    for k in order[:short]:
        quotas[k] += 1
    return quotas


def _cutoffs(keys: DataFrame, fraction: float) -> dict | None:
    """Per class the hash of its last test row, or None if there are too many classes.

    Counts per hash prefix show in which prefix the quota is reached; the next step looks
    only into that prefix, until few enough hashes are left to pick the last one.
    """
    rows = keys.groupBy("_class", F.substring("_hash", 1, STEP).alias("_prefix")).count().limit(COUNT_ROWS + 1).collect()
    if len(rows) > COUNT_ROWS:
        return None
    sizes: dict = {}
    for r in rows:
        sizes[r["_class"]] = sizes.get(r["_class"], 0) + r["count"]
    needed = {k: q for k, q in _shares(sizes, fraction).items() if q > 0}
    length = STEP
    while needed:
        prefixes = {}
        for kind in needed:
            for r in sorted((r for r in rows if r["_class"] == kind), key=lambda r: r["_prefix"]):
                if needed[kind] <= r["count"]:
                    prefixes[kind] = (r["_prefix"], r["count"])
                    break
                needed[kind] -= r["count"]
        cut = reduce(
            lambda a, b: a | b,
            [F.col("_class").eqNullSafe(F.lit(k)) & F.col("_hash").startswith(p) for k, (p, _) in prefixes.items()],
        )
        if length >= HASH_LENGTH:  # only equal ids are left together
            return {k: p for k, (p, _) in prefixes.items()}
        inside = keys.where(cut)
        if max(n for _, n in prefixes.values()) <= FINAL_ROWS:
            hashes: dict = {}
            for r in inside.collect():
                hashes.setdefault(r["_class"], []).append(r["_hash"])
            return {k: sorted(h)[needed[k] - 1] for k, h in hashes.items()}
        length += STEP
        rows = inside.groupBy("_class", F.substring("_hash", 1, length).alias("_prefix")).count().collect()
    return {}


def _cutoff_table(keys: DataFrame, fraction: float) -> DataFrame:
    """(_class, _cutoff) for any number of classes, without reading them on the driver."""
    prefixed = keys.withColumn("_prefix", F.substring("_hash", 1, STEP + 2))
    counts = prefixed.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy("_class").agg(F.sum("_n").alias("_n"))
    total = sizes.agg(F.sum("_n")).first()[0]
    wanted = math.ceil(fraction * total)
    product = f"cast(_n as decimal(19, 0)) * cast({wanted} as decimal(19, 0))"  # beyond 64 bits
    shares = sizes.withColumns(
        {"_floor": F.expr(f"{product} div cast({total} as decimal(19, 0))"), "_rest": F.expr(f"{product} % cast({total} as decimal(19, 0))")}
    )
    short = wanted - shares.agg(F.sum("_floor")).first()[0]
    ranked = running_totals(shares, [], [F.desc("_rest"), F.desc("_n"), F.col("_class")], {"_place": F.lit(1)})
    extra = F.when(F.col("_place") <= short, 1).otherwise(0)
    quotas = checked_small(ranked.select("_class", (F.col("_floor") + extra).alias("_quota")))
    upto = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    reached = attach(counts.withColumn("_upto", F.sum("_n").over(upto)), quotas, ["_class"])
    cut = reached.where("_upto >= _quota and _upto - _n < _quota").select(
        "_class", "_prefix", (F.col("_quota") - (F.col("_upto") - F.col("_n"))).alias("_need")
    )
    inside = attach(prefixed, checked_small(cut), ["_class", "_prefix"], "inner")
    place = Window.partitionBy("_class").orderBy("_hash")
    last = inside.withColumn("_place", F.row_number().over(place)).where("_place = _need")
    return checked_small(last.select("_class", F.col("_hash").alias("_cutoff")))


def hash_split(
    df: DataFrame,
    id_column: str,
    fraction: float = 0.2,
    seed: int = 42,
    stratify: str | None = None,
    name: str = "is_test",
) -> DataFrame:
    """Add a boolean column that marks exactly ``ceil(fraction * n)`` rows as test rows.

    Rows are taken in the order of ``md5(seed:id)``; ids must be unique, and rows with equal or
    missing ids fall on one side, which may then exceed the share. The result is a
    comparison of each row with the cut-off hash of its class, so the data itself is not
    shuffled, and the split is the same on every run and in every partitioning. Finding
    the cut-offs reads only ids and classes: two passes for up to some ten million rows
    per class, one more per factor of 4096. With ``stratify`` the class shares follow the
    largest-remainder rule; a NULL class is a class of its own.
    """
    named = F.coalesce(quoted(id_column).cast("string"), F.lit("\x00"))  # rows without an id stay together
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), named))
    kind = quoted(stratify) if stratify else F.lit(0)
    keys = df.select(kind.alias("_class"), hashed.alias("_hash"))
    cutoffs = _cutoffs(keys, fraction)
    if cutoffs is not None and not stratify:
        return df.withColumn(name, hashed <= F.lit(cutoffs[0]) if cutoffs else F.lit(False))
    if cutoffs is None:
        table = _cutoff_table(keys, fraction)
    else:
        schema = f"_class {keys.schema['_class'].dataType.simpleString()}, _cutoff string"
        table = F.broadcast(df.sparkSession.createDataFrame(list(cutoffs.items()), schema))
    marked = attach(df.withColumn("_class", kind).withColumn("_hash", hashed), table, ["_class"])
    flag = F.coalesce(F.col("_hash") <= F.col("_cutoff"), F.lit(False))
    return marked.select(*[quoted(c) for c in df.columns], flag.alias(name))
