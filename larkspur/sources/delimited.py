"""Delimited files: dirty ones with a buried header, plain ones, and the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import BOM, MISSING_TEXTS, strip
from larkspur.operators.bounds import checked_small, local_copy
from larkspur.session import durable
from larkspur.sources import records

# Texts that mark the header line, and separators in order of preference.
HEADER_MARKS = ["CustomerID", "Tenure Months", "Churn Label"]
SEPARATORS = ["\t", ",", ";"]


def separator_of(header: Column) -> Column:
    """The first of the known separators that the header holds, else NULL."""
    return F.coalesce(*[F.when(header.contains(s), s) for s in SEPARATORS])


def split_record(value: Column, separator: Column, width: int) -> Column:
    """The fields of a record as a struct of texts c0, c1, ..., quoted ones unquoted."""
    schema = ", ".join(f"`c{i}` STRING" for i in range(width))
    options = {"escape": '"', "mode": "PERMISSIVE"}
    return F.coalesce(*[F.when(separator == s, F.from_csv(value, schema, options | {"sep": s})) for s in SEPARATORS])


def read_dirty(
    spark: SparkSession,
    path: str,
    marks: list[str] = HEADER_MARKS,
    null_literal: str | None = None,
    row_id: str = "row_id",
) -> DataFrame:
    """Read delimited text files whose header comes after junk lines, all columns as text.

    In each file the header is the first line with all ``marks``; lines before it are
    dropped, a written-out ``\\t`` becomes a TAB, the separator is found in the header,
    blank records are skipped, values are stripped. ``row_id`` holds (file, block, line),
    which orders rows as in the files. Files are read in splits; the header of a file
    reaches its other splits through a small table. A record goes on over line breaks inside
    quotes (see ``records``), also from one split to the next; the header is one line.
    """
    raw = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    text = F.replace(F.regexp_replace("value", f"^{BOM}+", ""), F.lit("\\t"), F.lit("\t"))
    lines = raw.select("file", F.struct("file", "block", "line").alias(row_id), text.alias("value"))

    marked = lines
    for mark in marks:
        marked = marked.where(F.col("value").contains(mark))
    headers = marked.groupBy("file").agg(
        F.min_by("value", row_id).alias("header"), F.min(row_id).alias("header_at")
    )
    headers = headers.withColumn("separator", separator_of(F.col("header")))
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))  # lists, reads nothing
    headers = durable(headers)
    without = files.join(headers, "file", "left_anti").limit(1).collect()
    if without:
        raise ValueError(f"no header line with {', '.join(marks)} in {without[0]['file']}")
    unknown = headers.where("separator is null").limit(1).collect()
    if unknown:
        raise ValueError(f"no known separator in the header line: {unknown[0]['header'][:80]!r}")

    # Files differ in their separator and in the place of a name; both come with the file's header.
    parts = F.size(F.split("header", F.concat(F.lit("["), F.col("separator"), F.lit("]"))))
    width = headers.agg(F.max(parts)).first()[0]
    if width is None:
        raise ValueError("no header line with " + ", ".join(marks))
    every = [F.col(f"r.c{i}") for i in range(width)]
    read = headers.withColumn("r", split_record(F.rtrim("header", F.lit("\r\n")), F.col("separator"), width))
    names = F.array(*[strip(F.replace(F.coalesce(c, F.lit("")), F.lit(BOM), F.lit(""))) for c in every])
    headers = durable(read.select("file", "header", "header_at", "separator", names.alias("names")))
    places = headers.select("header", F.posexplode("names").alias("place", "name"))
    named = places.where("name <> ''").groupBy("name").agg(F.min(F.struct("header", "place")).alias("first")).orderBy("first").collect()  # the columns

    body = lines.join(checked_small(headers), "file").where(F.col(row_id) > F.col("header_at"))
    body = _with_records(body, headers, row_id)
    split = body.select(row_id, "names", "value", "separator", split_record(F.col("value"), F.col("separator"), width).alias("r"))
    blank = ~F.col("value").contains(F.col("separator")) & (strip(F.coalesce("r.c0", F.lit(""))) == "")
    split = split.where(~blank).select(row_id, "names", F.array(*every).alias("fields"))
    values = []
    for name in [r["name"] for r in named]:
        place = F.array_position("names", F.lit(name))
        value = F.when(place > 0, F.get("fields", (place - 1).cast("int")))
        missing = F.when(place > 0, F.lit(null_literal)) if null_literal is not None else F.lit(None)
        values.append(F.when(value.isNull() | value.isin(MISSING_TEXTS), missing).otherwise(strip(value)).cast("string").alias(name))
    return split.select(row_id, *values)


def _with_records(body: DataFrame, headers: DataFrame, row_id: str) -> DataFrame:
    """``body`` with whole records in place of lines, if any record has several."""
    scanned = body.withColumn("block", F.col(row_id)["block"]).select("file", "block", row_id, "value", "separator")
    if local_copy(headers) is None:  # the header came by a shuffle, which loses the order
        scanned = scanned.repartition("file", "block").sortWithinPartitions("file", "block", row_id)
    found = records.whole_records(scanned, row_id)
    return body if found is None else found.join(checked_small(headers), "file")


def read_plain(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Comma-separated files with a header line, in a given schema.

    With ``multi_line`` a record may hold line breaks inside quotes. Other than with Spark's
    option of that name a file is still read in splits.
    """
    if not multi_line:
        return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    heads = durable(lines.where("block = 0").groupBy("file").agg(F.min("line").alias("head")))
    small = local_copy(heads)
    lines = lines.join(heads if small is None else F.broadcast(small), "file").where("block > 0 or line > head")
    lines = lines.select("file", "block", F.struct("block", "line").alias("row_id"), "value", F.lit(",").alias("separator"))
    if small is None:
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "row_id")
    found = records.whole_records(lines, "row_id")
    rows = (lines if found is None else found).where("value <> ''")
    if not isinstance(schema, str):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv("value", schema, {"escape": '"'}).alias("r")).select("r.*")


def write_plain(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header line in each."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
