"""A knowledge base that grows by pages: any page of any source may come in any micro-batch.

Three tables below one folder, each with a partition per knowledge base and micro-batch:

* ``pages``: every page as it came, with its length. The newest one of a (source, page_number)
  counts, a blank one takes the page away.
* ``chunks``: the chunks that a batch cut anew, with their vectors.
* ``cuts``: per source of the batch the first chunk number that it cut anew. Chunks of earlier
  batches from there on no longer count. Written last, so a batch without it is not there yet.

When a batch has ended, batches of which less than half still counts are taken off the disk
(``compact``): what counts of them goes to ``carried``, and a row of ``moves`` says so.

A batch touches only its own sources, and of these only what lies behind the first page that
changed: lengths give the places of all pages, the texts of the tail alone are read. A source
that grows at its end costs what comes new, however long it is. A batch that runs again replaces
its own partitions and reads none of them before it has written them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators import chunks
from larkspur.operators.bounds import checked_small
from larkspur.operators.embed import Embedder
from larkspur.operators.ranks import block_running_totals
from larkspur.session import durable
from larkspur.sources import corpus

PAGE = ["source", "page_number"]
MOVE = "of long, gone string, place string, kept long, kb_name string"
# Files of a shuffle that has ended are removed at once, not when the driver next collects garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _table(spark: SparkSession, path: str, part: str, name: str, before: int | None = None) -> DataFrame | None:
    """The rows of one table of the knowledge base, of the batches before one; None if nothing is stored."""
    try:
        rows = corpus.read_vectors(spark, f"{path}/{part}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    rows = rows.where(F.col("kb_name") == name)
    return rows if before is None else rows.where(F.col("batch") < before)


def _write(rows: DataFrame, path: str, part: str, name: str, batch: int) -> None:
    stored = rows.withColumn("kb_name", F.lit(name)).withColumn("batch", F.lit(batch).cast("long"))
    corpus.write_vectors(stored, f"{path}/{part}", "kb_name", "batch")


def newest_pages(log: DataFrame) -> DataFrame:
    """source, page_number, batch and length of the newest version of every page."""
    return log.groupBy(*PAGE).agg(F.max_by("length", "batch").alias("length"), F.max("batch").alias("batch"))


def _first_chunk(offset: Column, size: int, overlap: int) -> Column:
    """The first chunk whose characters change if the text does from the separator before ``offset`` on."""
    return F.greatest(F.lit(0).cast("long"), F.floor((offset - chunks.GAP - size) / F.lit(size - overlap)) + 1)


def place_changes(log: DataFrame, batch: int, size: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(cuts, tail) of the sources with pages of this batch.

    ``cuts`` has source, from_chunk and the number of chunks from there on; ``tail`` the places (start, end) of the pages, with the
    batch that holds their text, that lie in chunks from there on. Both come from lengths alone.
    """
    touched = log.where(F.col("batch") == batch).select("source").distinct()
    pages = newest_pages(log.select(*PAGE, "batch", "length").join(touched, "source", "left_semi"))
    taken = F.when(F.col("length") > 0, F.col("length") + chunks.GAP).otherwise(0).cast("long")
    placed = durable(block_running_totals(pages, ["source"], "page_number", {"_upto": taken}).withColumn("start", F.col("_upto") - taken))
    changed = placed.groupBy("source").agg(
        F.min(F.when(F.col("batch") == batch, F.col("start"))).alias("offset"),
        F.coalesce(F.max(F.when(F.col("length") > 0, F.col("start") + F.col("length"))), F.lit(0)).alias("total"),
    )
    count = F.greatest(F.ceil((F.col("total") - overlap) / F.lit(size - overlap)), F.signum("total")).cast("long")  # blank ones included
    cuts = changed.select("source", _first_chunk(F.col("offset"), size, overlap).alias("from_chunk"), count.alias("chunks"))
    cuts = cuts.withColumn("chunks", F.greatest(F.col("chunks") - F.col("from_chunk"), F.lit(0).cast("long")))
    borders = checked_small(cuts.select("source", "from_chunk"))
    tail = placed.where("length > 0").withColumn("end", F.col("start") + F.col("length")).join(borders, "source")
    tail = tail.where(F.col("end") > F.col("from_chunk") * (size - overlap))
    return cuts, tail.select(*PAGE, "batch", "start", "end", "from_chunk")


def add_pages(
    batch: DataFrame, number: int, path: str, name: str, embedder: Embedder,
    size: int = chunks.DEFAULT_SIZE, overlap: int = chunks.DEFAULT_OVERLAP,
) -> None:
    """Store one batch of pages (source, page_number, text) and cut anew what they change."""
    spark = batch.sparkSession
    chunks.check_window(size, overlap)
    clean = corpus.ingest_pages(batch, clean=False).select(*PAGE, "text", F.col("character_count").alias("length"))
    _write(clean.groupBy(*PAGE).agg(F.max("text").alias("text"), F.max_by("length", "text").alias("length")), path, "pages", name, number)
    log = _table(spark, path, "pages", name, number + 1)
    if log is None:
        return  # an empty first batch
    cuts, tail = place_changes(log, number, size, overlap)
    texts = log.select(*PAGE, "batch", "text")
    placed = tail.join(texts, [*PAGE, "batch"])
    cut = chunks.cut_placed(placed, [(size, overlap)], True).drop("chunk_size", "chunk_overlap")
    cut = cut.join(checked_small(cuts.select("source", "from_chunk")), "source").where(F.col("chunk_number") >= F.col("from_chunk")).drop("from_chunk")
    _write(embedder.embed(cut, "text", "embedding"), path, "chunks", name, number)
    _write(cuts, path, "cuts", name, number)
    compact(spark, path, name, number)


def _until(cuts: DataFrame) -> DataFrame:
    """The cuts with ``until``, the first chunk of the source that a later batch cut anew."""
    later = Window.partitionBy("source").orderBy("batch").rowsBetween(1, Window.unboundedFollowing)
    return cuts.withColumn("until", F.min("from_chunk").over(later))  # a row per source and batch


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """All chunks of all batches, from where they lie now."""
    chunks, carried, moves = (_table(spark, path, part, name) for part in ("chunks", "carried", "moves"))
    if moves is None:
        return chunks
    moved, found = moves.withColumnRenamed("of", "batch"), []
    if chunks is not None:
        found.append(chunks.join(checked_small(moved.select("batch").distinct()), "batch", "left_anti"))
    if carried is not None:
        gone = moved.select("batch", F.col("gone").alias("place"))
        valid = moved.select("batch", "place").join(gone, ["batch", "place"], "left_anti")
        found.append(carried.join(checked_small(valid), ["batch", "place"], "left_semi").drop("place"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def live_chunks(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """The chunks that count, of all batches that have ended; None before the first one."""
    live = _live(spark, path, name)
    return None if live is None else live.drop("batch")


def _live(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    stored, cuts = _stored(spark, path, name), _table(spark, path, "cuts", name)
    if stored is None or cuts is None:
        return None
    until = _until(cuts).select("source", "batch", "until")
    kept = stored.drop("kb_name").join(checked_small(until), ["source", "batch"])
    return kept.where(F.col("until").isNull() | (F.col("chunk_number") < F.col("until"))).drop("until")


def compact(spark: SparkSession, path: str, name: str, number: int) -> None:
    """Take batches before ``number`` off the disk of which less than half counts; must not run beside a ``publish``.

    Which ones comes from the cuts alone. What counts of them is written to a place of its own, then a row
    per batch to ``moves``, which makes that place count and the old one not, then the old files go. A run
    that fails in between leaves chunks as they were or files that nothing reads.
    """
    cuts, moves = _table(spark, path, "cuts", name), _table(spark, path, "moves", name)
    if cuts is None or "chunks" not in cuts.columns:
        return
    alive = F.greatest(F.least("chunks", F.col("until") - F.col("from_chunk")), F.lit(0))  # least() skips NULL
    sizes = _until(cuts).groupBy("batch").agg(F.sum("chunks").alias("rows"), F.sum(alive).alias("live"))
    places = {r["of"]: r for r in sorted(moves.collect(), key=lambda r: -r["kept"])} if moves is not None else {}
    sizes = sizes.collect()  # a row per batch
    rows = {r["batch"]: places[r["batch"]]["kept"] if r["batch"] in places else r["rows"] for r in sizes}
    victims = {r["batch"]: r["live"] for r in sizes if r["batch"] < number and 2 * r["live"] < rows[r["batch"]]}
    if not victims or not any(r["live"] for r in sizes):
        return
    place = f"m-{uuid.uuid4().hex}"
    own = F.col("batch").isin([*victims])
    kept = _live(spark, path, name).where(own).withColumn("kb_name", F.lit(name)).withColumn("place", F.lit(place))
    corpus.write_vectors(kept, f"{path}/carried", "kb_name", "batch", "place")
    moved = [(batch, places[batch]["place"] if batch in places else "", place, live, name) for batch, live in victims.items()]
    # One file, which the committer puts in place by a rename.
    spark.createDataFrame(moved, MOVE).coalesce(1).write.mode("append").partitionBy("kb_name").parquet(f"{path}/moves")
    again = [(F.col("batch") == batch) & (F.col("place") == gone) for batch, gone, *_ in moved]
    old = {"chunks": own, "carried": reduce(Column.__or__, again)}
    for part, gone in old.items():
        table = _table(spark, path, part, name)
        files = table.where(gone).select("_metadata.file_path").distinct().collect() if table is not None else []
        for row in files:
            file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["file_path"]))
            file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)


def stream_knowledge(
    pages: DataFrame, path: str, name: str, embedder: Embedder, checkpoint: str,
    size: int = chunks.DEFAULT_SIZE, overlap: int = chunks.DEFAULT_OVERLAP,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Add the pages of every micro-batch to the tables below ``path``; see ``publish``.

    Pages of a source may be spread over batches in any order, come again, or be replaced.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.sparkSession.conf.set(TIDY, "true")  # the session of the stream, not the caller's
        add_pages(prepare(batch), number, path, name, embedder, size, overlap)

    return pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def publish(spark: SparkSession, path: str, name: str, out: str, first_id: int = 1) -> None:
    """Write the live chunks with dense ids as a version that ``knowledge.load`` reads, the same as a build of all pages at once."""
    live = live_chunks(spark, path, name)
    if live is None:
        raise ValueError(f"no batch of {name!r} has been stored below {path}")
    corpus.write_vectors(chunks.number_chunks(live, first_id, on_disk=True).withColumn("kb_name", F.lit(name)), out, "kb_name")
