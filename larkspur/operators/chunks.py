"""Pages to overlapping chunks with page lineage, without collecting a document.

A document is never put together in one row or task: each page gets its character range
in the document, cuts itself at the chunk borders, and the pieces meet again per chunk,
which holds at most ``size`` characters. One source may hold most of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import strip
from larkspur.operators.bounds import attach, checked_small
from larkspur.operators.ranks import block_running_totals, running_totals
from larkspur.session import stored

SEPARATOR = "\n\n"
GAP = len(SEPARATOR)
DEFAULT_SIZE = 1000
DEFAULT_OVERLAP = 200
# The (size, overlap) settings of the chunk-size comparison.
SWEEP = [(500, 100), (1000, 200), (1500, 300)]


def check_window(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("chunk size must be greater than zero")
    if overlap < 0:
        raise ValueError("chunk overlap must not be negative")
    if overlap >= size:
        raise ValueError("chunk overlap must be smaller than the chunk size")


def page_offsets(pages: DataFrame) -> DataFrame:
    """Stripped, non-empty pages with their range [start, end) in the document text.

    Pages follow each other by number with a two-character separator between them.
    """
    texts = pages.select("source", "page_number", strip(F.col("text")).alias("text")).where("text <> ''")
    taken = (F.length("text") + GAP).cast("long")
    placed = block_running_totals(texts, ["source"], "page_number", {"_upto": taken})
    end = F.col("_upto") - GAP
    return placed.select("source", "page_number", "text", (end - F.length("text")).alias("start"), end.alias("end"))


def _pieces(size: int, overlap: int) -> Column:
    """Array of the parts of a page (with the separator before it), one per chunk touched."""
    step = size - overlap
    begin = F.when(F.col("start") > 0, F.col("start") - GAP).otherwise(F.lit(0).cast("long"))
    content = F.when(F.col("start") > 0, F.concat(F.lit(SEPARATOR), F.col("text"))).otherwise(F.col("text"))
    first = F.greatest(F.lit(0).cast("long"), F.floor((begin - size) / F.lit(step)) + 1)
    last = F.floor((F.col("end") - 1) / F.lit(step))

    def piece(k: Column) -> Column:
        at = F.greatest(k * step, begin)
        length = F.least(k * step + size, F.col("end")) - at
        covers = (F.col("end") > k * step) & (F.col("start") < k * step + size)
        return F.struct(
            F.lit(size).alias("chunk_size"),
            F.lit(overlap).alias("chunk_overlap"),
            k.alias("chunk_number"),
            at.alias("at"),
            F.substring(content, (at - begin + 1).cast("int"), length.cast("int")).alias("text"),
            F.when(covers, F.col("page_number")).alias("page"),
        )

    return F.transform(F.sequence(first, last), piece)


def chunk_pages(
    pages: DataFrame, configs: list[tuple[int, int]], sorted_pages: bool = False
) -> DataFrame:
    """Chunks of every (size, overlap) setting in one job.

    Chunk *k* covers [k*step, k*step+size) with step = size - overlap. A chunk after the
    first exists only if its raw text is longer than the overlap, since otherwise the
    chunk before has reached the end. Blank chunks are skipped. ``page_numbers`` lists
    the pages that overlap the chunk, a page's separator belonging to no page;
    ``sorted_pages`` makes it a sorted set.
    """
    return cut_placed(page_offsets(pages), configs, sorted_pages)


def cut_placed(placed: DataFrame, configs: list[tuple[int, int]], sorted_pages: bool = False) -> DataFrame:
    """The chunks that the pages of ``page_offsets``, or some of them, take part in (see ``chunk_pages``)."""
    for size, overlap in configs:
        check_window(size, overlap)
    arrays = [_pieces(size, overlap) for size, overlap in configs]
    pieces = placed.select("source", F.inline(F.flatten(F.array(*arrays))))
    keys = ["source", "chunk_size", "chunk_overlap", "chunk_number"]
    whole = pieces.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("at", "text", "page"))).alias("parts")
    )
    whole = whole.select(
        *keys,
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("raw"),
        F.filter(F.transform("parts", lambda p: p["page"]), lambda p: p.isNotNull()).alias("page_numbers"),
    )
    kept = whole.where((F.col("chunk_number") == 0) | (F.length("raw") > F.col("chunk_overlap")))
    numbers = F.array_sort(F.array_distinct("page_numbers")) if sorted_pages else F.col("page_numbers")
    out = kept.select(*keys, numbers.alias("page_numbers"), strip(F.col("raw")).alias("text"))
    return out.where("text <> ''").withColumn("character_count", F.length("text"))


def chunk_documents(
    pages: DataFrame, size: int = DEFAULT_SIZE, overlap: int = DEFAULT_OVERLAP, sorted_pages: bool = False
) -> DataFrame:
    """(source, chunk_number, page_numbers, text, character_count) of one setting."""
    return chunk_pages(pages, [(size, overlap)], sorted_pages).drop("chunk_size", "chunk_overlap")


def number_chunks(chunks: DataFrame, first_id: int = 1, on_disk: bool = False) -> DataFrame:
    """Dense ``chunk_id`` over all sources, in order of source and chunk.

    The place inside a source comes from block totals, the offset of a source from the
    running total of the chunk counts per source; no window sees all chunks. The chunks
    are written to the shared folder first, unless they are ``on_disk``; two of the three reads of
    them take two columns.
    """
    chunks = chunks if on_disk else stored(chunks, "chunks")
    placed = block_running_totals(chunks, ["source"], "chunk_number", {"_place": F.lit(1).cast("long")})
    counts = chunks.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_totals(counts, [], [F.col("source")], {"_upto": F.col("_n")})
    offsets = checked_small(offsets.select("source", (F.col("_upto") - F.col("_n")).alias("_offset")))
    numbered = attach(placed, offsets, ["source"])
    chunk_id = F.col("_offset") + F.col("_place") - 1 + first_id
    return numbered.select(chunk_id.alias("chunk_id"), *chunks.columns)


def document_stats(pages: DataFrame) -> DataFrame:
    """Pages, pages with text and characters per source, and in total (source NULL)."""
    counts = pages.groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.length("text") > 0).alias("pages_with_text"),
        F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("characters"),
    )
    total = counts.rollup("source").agg(
        F.grouping("source").alias("is_total"),
        F.count(F.lit(1)).alias("documents"),
        *[F.sum(c).alias(c) for c in ("pages", "pages_with_text", "characters")],
    )
    return total.select("source", (F.col("is_total") == 1).alias("is_total"), "documents", "pages", "pages_with_text", "characters")
