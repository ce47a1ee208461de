"""Shards as runs of a Hilbert curve over quantised metadata, for multidimensional file pruning.

Each dimension (here lang, source and size) is cut into cells of about equal rows. The cells'
position on a Hilbert curve orders the rows, and runs of that order are the shards, so that a
shard spans a narrow range of every dimension and a reader can skip files by all of them.

Only columns and SQL functions are used. The text is read once for its length and checksum;
what is counted, sorted and shuffled afterwards is narrow. Cell borders are literals (at most
``2 ** BITS`` per dimension), so a row finds its cell without a join. Positions come from a
range partitioning on the whole order key (curve, checksum, size, id) with totals per
partition; rows that agree in all of it are counted before they are sorted. So neither a hot
cell nor a group of copies meets in one task.

Laws: ``rows`` cuts the order into counts at most one apart; ``bytes`` cuts it where the
running bytes pass a multiple of their share, a row going to where its middle lies.

Defined cases: a missing text has no bytes (size 1) and checksum 0; missing metadata sorts
before all other values; rows that repeat take a slot each; fewer rows than shards leave shards
empty; an empty table gives no rows. Extra columns are ignored by ``assign`` and kept by
``write``, whatever their names. In ``write`` rows that agree in the whole order key stay in one shard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ranks import running_totals
from larkspur.session import durable

#: Cells of a dimension are ``2 ** BITS``.
BITS = 4
SHARDS = 8
LAW = "rows"
#: Metadata that the curve runs through.
DIMENSIONS = ("lang", "source", "size")
KEY = ("curve", "text_crc32", "size", "doc_id")


def _turned(bits: int, by: int, width: int) -> int:
    """Bits rotated to the left; a negative ``by`` rotates to the right."""
    by %= width
    return (bits << by | bits >> width - by) & (1 << width) - 1


def steps(width: int) -> list[int]:
    """Next state and place of every (state, corner), as ``state << width | place``.

    A state is the corner where the curve enters a cube and the axis along which it leaves.
    Corners are met in the order of the Gray code, turned into that frame.
    """
    corners = 1 << width
    place = {w ^ w >> 1: w for w in range(corners)}
    entry = [0] + [(w - 1) // 2 * 2 for w in range(1, corners)]

    def axis(w: int) -> int:
        odd = w if w % 2 else w - 1
        return (~odd & odd + 1).bit_length() - 1 if w else 0

    table = []
    for state in range(corners * width):
        start, along = divmod(state, width)
        for corner in range(corners):
            w = place[_turned(corner ^ start, -(along + 1), width)]
            enters = start ^ _turned(entry[w] ^ entry[w] >> 1, along + 1, width)
            leaves = (along + axis(w) + 1) % width
            table.append((enters * width + leaves) << width | w)
    return table


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a point with ``bits`` bits in each dimension."""
    width = len(cells)
    table = F.array(*[F.lit(v) for v in steps(width)])
    corners = F.array(*[
        reduce(lambda a, b: a + b, [F.shiftleft(F.shiftright(c.cast("int"), level).bitwiseAND(F.lit(1)), j) for j, c in enumerate(cells)])
        for level in range(bits - 1, -1, -1)
    ])

    def step(done: Column, corner: Column) -> Column:
        found = F.element_at(table, done["state"] * (1 << width) + corner + 1)
        return F.struct(
            F.shiftright(found, width).alias("state"),
            (F.shiftleft(done["index"], width) + found.bitwiseAND(F.lit((1 << width) - 1))).alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(corners, start, step, lambda done: done["index"])


def cell_of(rows: DataFrame, name: str, total: int, bits: int = BITS) -> Column:
    """Cell of a column's value: its rows before, in shares of ``2 ** bits`` of all rows.

    Borders are the first value of each cell, at most ``2 ** bits`` literals.
    """
    value = F.col(f"`{name}`")
    counts = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    summed = running_totals(counts, [], [F.col("value").asc_nulls_first()], {"upto": F.col("n")}, max_rows=0)
    cell = F.expr(f"(upto - n) * {1 << bits} div {max(total, 1)}").cast("int")
    borders = summed.where(F.col("value").isNotNull()).groupBy(cell.alias("cell")).agg(F.min("value").alias("first"))
    found = F.lit(0)
    for row in sorted(borders.collect(), key=lambda r: r["cell"]):
        found = F.when(value >= F.lit(row["first"]), F.lit(row["cell"])).otherwise(found)
    return found


def _sized() -> list[Column]:
    """The narrow columns that everything but the final writing works on."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = (F.octet_length(raw) + 1).cast("long")
    return [F.col("doc_id"), F.col("lang"), F.col("source"), size.alias("size"), F.crc32(raw).alias("text_crc32")]


def _curve(narrow: DataFrame, total: int, bits: int) -> Column:
    return curve_index([cell_of(narrow, name, total, bits) for name in DIMENSIONS], bits)


def _assigned(narrow: DataFrame, curve: Column, total: int, size: int, shards: int, law: str) -> DataFrame:
    keyed = narrow.select("doc_id", "size", "text_crc32", curve.alias("curve"))
    counted = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    totals = {"rows_upto": F.col("n"), "bytes_upto": F.col("n") * F.col("size")}
    summed = running_totals(counted, [], [F.col(c).asc_nulls_first() for c in KEY], totals, max_rows=0)
    placed = summed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(
        *KEY,
        (F.col("rows_upto") - F.col("n") + F.col("copy")).alias("place"),
        (F.col("bytes_upto") - (F.col("n") - F.col("copy")) * F.col("size")).alias("start"),
    )
    if law == "rows":
        cut = placed.withColumn("shard", F.expr(f"place * {shards} div {max(total, 1)}").cast("int"))
        return cut.withColumn("slot", F.expr(f"place - (shard * {total}L + {shards - 1}) div {shards}"))
    if law != "bytes":
        raise ValueError(f"unknown law {law!r}")
    cut = placed.withColumn("shard", F.expr(f"(2 * start + size) * {shards} div {max(2 * size, 1)}").cast("int"))
    firsts = cut.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return cut.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("place") - F.col("first")).drop("first")


def _measured(docs: DataFrame) -> tuple[DataFrame, int, int]:
    narrow = durable(docs.select(*_sized()))
    row = narrow.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).first()
    return narrow, row["rows"], row["bytes"] or 0


def assign(docs: DataFrame, shards: int = SHARDS, law: str = LAW, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, place, start, shard and slot of every row."""
    narrow, rows, size = _measured(docs)
    return _assigned(narrow, _curve(narrow, rows, bits), rows, size, shards, law)


def write(docs: DataFrame, path: str, shards: int = SHARDS, law: str = LAW, bits: int = BITS) -> DataFrame:
    """Write the whole rows as Parquet, a folder per shard in curve order; returns the shards' manifest.

    The text moves once: shards begin at measured order keys, so a row finds its own by
    comparison, and a range partitioning of the key splits shards over tasks. The manifest
    holds rows, bytes, and the least and greatest value of each dimension per shard.
    """
    narrow, rows, size = _measured(docs)
    curve = _curve(narrow, rows, bits)
    firsts = _assigned(narrow, curve, rows, size, shards, law).where("slot = 0").select("shard", *KEY).collect()  # a row per shard
    types = {"curve": "long", "text_crc32": "long", "size": "long", "doc_id": docs.schema["doc_id"].dataType}

    full = docs.select(F.struct("*").alias("row"), *_sized())
    key = F.struct(*[F.col(c) for c in KEY])
    shard = F.lit(0)
    for row in sorted(firsts, key=lambda r: r["shard"]):
        first = F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in KEY])
        shard = F.when(key >= first, F.lit(row["shard"])).otherwise(shard)
    name = "shard"
    while name in docs.columns:
        name += "_"
    laid = full.withColumn("curve", curve).withColumn("part", shard).repartitionByRange(*KEY).sortWithinPartitions("part", *KEY)
    laid.select("row.*", F.col("part").alias(name)).write.partitionBy(name).parquet(path)
    return manifest(narrow.withColumn("curve", curve).withColumn("shard", shard))


def manifest(rows: DataFrame) -> DataFrame:
    """Per shard: rows, bytes, and the range of every dimension, by which readers skip shards."""
    ranges = [f(F.col(c)).alias(f"{c}_{n}") for c in DIMENSIONS for n, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``assign`` under the law ``rows``."""
    return assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _cells_sql(name: str) -> str:
    return f"""{name}_cell AS (
  SELECT {name} AS v, coalesce(sum(count(*)) OVER (ORDER BY {name} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    * {1 << BITS} // (SELECT count(*) FROM sized) AS cell FROM sized GROUP BY {name})"""


ORACLE = f"""
WITH RECURSIVE poly AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
  FROM range(256) r(b)),
raw AS (
  SELECT doc_id, lang, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::INTEGER) AS b
  FROM documents),
sized AS MATERIALIZED (
  SELECT doc_id, lang, source, len(b)::BIGINT + 1 AS size,
    xor(list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM raw, poly),
{", ".join(_cells_sql(name) for name in DIMENSIONS)},
turns AS (SELECT {steps(len(DIMENSIONS))} AS next),
walk AS (
  SELECT DISTINCT x.cell::INT AS x, y.cell::INT AS y, z.cell::INT AS z, {BITS - 1} AS level, 0 AS state, 0 AS curve
  FROM lang_cell x, source_cell y, size_cell z
  UNION ALL
  SELECT x, y, z, level - 1, found >> 3, curve * 8 + (found & 7) FROM (
    SELECT walk.*, next[state * 8 + ((x >> level) & 1) + 2 * ((y >> level) & 1) + 4 * ((z >> level) & 1) + 1] AS found FROM walk, turns)
  WHERE level >= 0),
placed AS (
  SELECT doc_id, size, text_crc32,
    row_number() OVER (ORDER BY curve, text_crc32, size, doc_id NULLS FIRST) - 1 AS place, (SELECT count(*) FROM sized) AS n
  FROM sized JOIN lang_cell ON lang IS NOT DISTINCT FROM lang_cell.v JOIN source_cell ON source IS NOT DISTINCT FROM source_cell.v
  JOIN size_cell ON size = size_cell.v
  JOIN walk ON walk.level = -1 AND walk.x = lang_cell.cell AND walk.y = source_cell.cell AND walk.z = size_cell.cell)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, (place * {SHARDS} // n)::INTEGER AS shard,
  (place - (place * {SHARDS} // n * n + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""
