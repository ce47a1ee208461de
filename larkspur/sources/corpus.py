"""Document sources and sinks: page tables, nested corpus files, question lists, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import clean_text, strip
from larkspur.sources import json_document

CORPUS_SCHEMA = (
    "project STRING, domain STRING, document_count INT, documents ARRAY<STRUCT<source: STRING, page_count: INT, "
    "total_character_count: BIGINT, pages: ARRAY<STRUCT<page_number: INT, text: STRING, character_count: INT>>>>"
)
CORPUS_LEVELS = [
    "project STRING, domain STRING, document_count INT",
    "source STRING, page_count INT, total_character_count BIGINT",
    "page_number INT, text STRING, character_count INT",
]
CHUNK_LEVELS = [
    "project STRING, domain STRING, source_document_count INT, chunk_size INT, chunk_overlap INT, chunk_count INT",
    "source STRING, page_numbers ARRAY<INT>, text STRING, character_count INT, chunk_id BIGINT",
]
CHUNK_SCHEMA = (
    "source_document_count INT, chunk_size INT, chunk_overlap INT, chunk_count INT, chunks ARRAY<STRUCT<"
    "source: STRING, page_numbers: ARRAY<INT>, text: STRING, character_count: INT, chunk_id: BIGINT>>"
)
PAGE_SCHEMA = "source STRING, page_number BIGINT, text STRING"


def read_pages(spark: SparkSession, path: str, pattern: str = "*.json", bad_rows: str = "fail") -> DataFrame:
    """Page rows from JSON lines, with the file they came from; no pages at all is an error.

    ``bad_rows``: ``fail`` stops at a damaged line; ``quarantine`` keeps it in the column
    ``_corrupt_record`` (see ``split_quarantine``).
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(path).where("trim(value) <> ''")
    if lines.isEmpty():
        raise FileNotFoundError(f"no pages in files like {pattern} below {path}")
    if bad_rows == "fail":
        page = F.from_json("value", PAGE_SCHEMA, {"mode": "FAILFAST"})
    else:
        page = F.from_json("value", PAGE_SCHEMA + ", _corrupt_record STRING", {"mode": "PERMISSIVE"})
    return lines.select(F.col("_metadata.file_name").alias("file_name"), page.alias("page")).select("page.*", "file_name")


def split_quarantine(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good pages, damaged lines with their file)."""
    good = pages.where("_corrupt_record is null").drop("_corrupt_record")
    return good, pages.where("_corrupt_record is not null").select("file_name", "_corrupt_record")


def ingest_pages(pages: DataFrame, clean: bool = True, keep_empty: bool = True) -> DataFrame:
    """(source, page_number, text, character_count) of raw page texts.

    ``clean`` normalises white space, otherwise texts are only stripped. Without
    ``keep_empty`` blank pages go, and with them documents that have no other page.
    """
    text = clean_text(F.col("text")) if clean else strip(F.coalesce("text", F.lit("")))
    out = pages.select("source", "page_number", text.alias("text"))
    out = out.select("*", F.length("text").alias("character_count"))
    return out if keep_empty else out.where("character_count > 0")


def read_corpus(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Page rows of nested corpus files; each file may be one JSON object."""
    nested = spark.read.schema(CORPUS_SCHEMA).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    documents = nested.select(F.inline("documents"))
    return documents.select("source", F.inline("pages"))


def read_chunks(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Chunk rows of nested chunk files."""
    nested = spark.read.schema(CHUNK_SCHEMA).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    return nested.select(F.inline("chunks"))


def write_corpus_document(pages: DataFrame, path: str, project: str, domain: str) -> None:
    """All pages (source, page_number, text) as one JSON document with counts per source and in the envelope.

    ``path`` is a folder of parts, which are one JSON text in the order of their names.
    """
    rows = pages.select("source", "page_number", "text", F.length("text").alias("character_count"))
    counts = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("page_count"), F.coalesce(F.sum("character_count"), F.lit(0)).cast("long").alias("total_character_count")
    )
    envelope = [F.lit(project).alias("project"), F.lit(domain).alias("domain"), F.lit(counts.count()).alias("document_count")]
    json_document.write_document(rows, path, ["documents", "pages"], envelope, ["source", "page_number"], ["source"], counts)


def read_corpus_document(spark: SparkSession, path: str, in_parts: bool = False) -> DataFrame:
    """project, domain, document_count, and the pages with the counts of their source; a file is read by many tasks."""
    found = json_document.read_document(spark, path, ["documents", "pages"], CORPUS_LEVELS, in_parts)
    return found.select("r0.*", "r1.*", "r2.*")


def write_chunk_document(cut: DataFrame, path: str, project: str, domain: str, size: int, overlap: int) -> None:
    """Numbered chunks as one JSON document with the settings and counts in the envelope, in parts."""
    counts = cut.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("source").alias("sources")).first()
    values = {
        "project": project, "domain": domain, "source_document_count": counts["sources"], "chunk_size": size, "chunk_overlap": overlap,
        "chunk_count": counts["chunks"],
    }
    rows = cut.select("source", "page_numbers", "text", "character_count", "chunk_id")
    json_document.write_document(rows, path, ["chunks"], [F.lit(v).alias(k) for k, v in values.items()], ["chunk_id"])


def read_chunk_document(spark: SparkSession, path: str, in_parts: bool = False) -> DataFrame:
    """The chunks with the fields of the envelope; a file is read by many tasks."""
    return json_document.read_document(spark, path, ["chunks"], CHUNK_LEVELS, in_parts).select("r0.*", "r1.*")


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row; missing fields are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_object(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stripped text lines without blank ones."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("line"))
    return lines.where("line <> ''")


def write_vectors(df: DataFrame, path: str, *partitions: str) -> None:
    """Vectors with their metadata as one Parquet table; only the partitions at hand are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
