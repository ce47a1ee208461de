"""A knowledge base: build, publish as versions, load, ask.

``build`` replaces one partition of a table. ``publish`` writes every build to a folder of its
own and then one row of a manifest, which makes it the current version. A build that fails, or
whose vectors do not agree, leaves no row, so the version before stays current; who has loaded
a version goes on reading its folder until ``clean`` removes it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import answers, chunks
from larkspur.operators.embed import Embedder, vector_check
from larkspur.operators.search import MIN_SIMILARITY, TOP_K, search
from larkspur.session import stored
from larkspur.sources import corpus

COLUMNS = ["chunk_id", "source", "chunk_number", "page_numbers", "text", "character_count", "embedding"]
MANIFEST = "name string, version long, folder string, chunks long, dimension int, chunk_size int, chunk_overlap int"


def _built(pages: DataFrame, embedder: Embedder, size: int, overlap: int, first_id: int) -> DataFrame:
    cut = chunks.chunk_documents(corpus.ingest_pages(pages, clean=False, keep_empty=False), size, overlap, True)
    return embedder.embed(chunks.number_chunks(cut, first_id), "text", "embedding")


def checked(rows: DataFrame) -> dict:
    """Number and width of the vectors; refused if there are none, if one is missing, or if widths differ."""
    found = vector_check(rows).drop("norm_error").first().asDict() | {"chunks": rows.count()}
    if not found["chunks"]:
        raise ValueError("no chunks were made")
    if found["vectors"] != found["chunks"] or not found["uniform"]:
        raise ValueError(
            f"{found['chunks']} chunks with {found['vectors']} vectors of {found['min_dimension']} to {found['max_dimension']} dimensions"
        )
    return {"chunks": found["chunks"], "dimension": found["max_dimension"]}


def build(
    pages: DataFrame, path: str, name: str, embedder: Embedder,
    size: int = chunks.DEFAULT_SIZE, overlap: int = chunks.DEFAULT_OVERLAP, first_id: int = 1,
) -> None:
    """Chunk, number and embed all pages and write them as the version ``name`` of the table.

    Only the partition of this name is replaced, and only by vectors that pass ``checked``.
    """
    rows = stored(_built(pages, embedder, size, overlap, first_id), "knowledge")
    checked(rows)
    corpus.write_vectors(rows.withColumn("kb_name", F.lit(name)), path, "kb_name")


def publish(
    pages: DataFrame, path: str, name: str, embedder: Embedder, size: int = chunks.DEFAULT_SIZE, overlap: int = chunks.DEFAULT_OVERLAP,
) -> int:
    """Build a new version of a knowledge base and make it current; returns its number."""
    spark = pages.sparkSession
    folder = f"data/{name}-{uuid.uuid4().hex}"
    _built(pages, embedder, size, overlap, 1).write.parquet(f"{path}/{folder}")
    found = checked(spark.read.parquet(f"{path}/{folder}"))
    known = versions(spark, path)
    last = known.where(F.col("name") == name).agg(F.max("version")).first()[0] if known is not None else None
    version = (last or 0) + 1
    row = [(name, version, folder, found["chunks"], found["dimension"], size, overlap)]
    # One row, so one file, which the committer puts in place by a rename.
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest: a row per published version; None before the first."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_version(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """The rows of one version, or of the current one. What is loaded stays the same when another is published."""
    known = versions(spark, path)
    own = known.where(F.col("name") == name) if known is not None else None
    if own is not None and version is not None:
        own = own.where(F.col("version") == version)
    row = own.orderBy(F.desc("version"), F.desc("folder")).first() if own is not None else None
    if row is None:
        raise ValueError(f"no version {version or ''} of {name!r} below {path}")
    return spark.read.parquet(f"{path}/{row['folder']}")


def clean(spark: SparkSession, path: str, name: str, keep: int = 2) -> list[str]:
    """Remove the folders of a knowledge base that none of its last ``keep`` versions has; returns their names.

    That takes old versions and what failed builds have left, and must not run beside a build.
    """
    known = versions(spark, path)
    if known is None:
        return []
    kept = known.where(F.col("name") == name).orderBy(F.desc("version")).limit(keep).collect()
    names = {row["folder"].split("/")[-1] for row in kept}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(root):
        folder = status.getPath().getName()
        if folder.rpartition("-")[0] == name and folder not in names:
            files.delete(status.getPath(), True)
            gone.append(folder)
    return gone


def load(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of one version; other partitions are not read."""
    return corpus.read_vectors(spark, path).where(F.col("kb_name") == name)


def ask(
    questions: DataFrame, stored: DataFrame, embedder: Embedder, k: int = TOP_K, floor: float = MIN_SIMILARITY
) -> DataFrame:
    """Per question: status, prompt for the answerable ones, and citations as text."""
    asked = embedder.embed(questions.select("query_id", "question"), "question", "embedding")
    hits = answers.with_chunks(search(asked, stored.select("chunk_id", "embedding"), k, floor), stored)
    gated = answers.evidence_gate(questions.select("query_id", "question"), hits)
    prompts = answers.grounded_prompts(questions, hits).select("query_id", "prompt")
    cited = answers.citations(hits).groupBy("query_id").agg(
        F.array_join(
            F.array_sort(F.collect_list(F.concat(F.col("source"), F.lit(" | Pages: "), F.col("page_ranges")))), "; "
        ).alias("citations")
    )
    return gated.join(prompts, "query_id", "left").join(cited, "query_id", "left")
