"""From retrieved chunks to prompt rows and citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import page_list, page_ranges, strip

INSUFFICIENT = "insufficient information"

#: A neutral default; callers pass their own wording as ``template``.
PROMPT = """Question: {question}

Answer from the numbered sources and cite them by number.

{context}"""

# The labels of a source block.
SOURCE, DOCUMENT, PAGES, TEXT = "SOURCE ", "Document: ", "Pages: ", "Text:"


def with_chunks(hits: DataFrame, chunks: DataFrame, chunk_id: str = "chunk_id") -> DataFrame:
    """Add source, pages and text to ranked hits by chunk id."""
    return hits.join(chunks.select(chunk_id, "source", "page_numbers", "text"), chunk_id)


def prompt_context(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """(query_id, hits, context): the excerpts of a query in order of rank (at most k)."""
    block = F.concat(
        F.lit(SOURCE), F.col("rank").cast("string"), F.lit(f"\n{DOCUMENT}"), F.col("source").cast("string"),
        F.lit(f"\n{PAGES}"), page_list(F.col("page_numbers")), F.lit(f"\n{TEXT}\n"), F.col("text"), F.lit("\n"),
    )
    gathered = hits.groupBy(query_id).agg(
        F.count(F.lit(1)).alias("hits"), F.array_sort(F.collect_list(F.struct("rank", block.alias("block")))).alias("b")
    )
    return gathered.select(
        query_id, "hits", F.array_join(F.transform("b", lambda x: x["block"]), "\n\n").alias("context")
    )


def evidence_gate(queries: DataFrame, hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """All queries with their number of hits; those without any are not to be generated."""
    counts = hits.groupBy(query_id).agg(F.count(F.lit(1)).alias("hits"))
    out = queries.join(counts, query_id, "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    return out.withColumn("answerable", F.col("hits") > 0).withColumn(
        "status", F.when(F.col("hits") > 0, "answerable").otherwise(INSUFFICIENT)
    )


def grounded_prompts(
    queries: DataFrame, hits: DataFrame, query_id: str = "query_id", question: str = "question", template: str = PROMPT
) -> DataFrame:
    """(query_id, hits, prompt) of the answerable queries only."""
    context = prompt_context(hits, query_id)
    head, rest = template.split("{question}")
    middle, tail = rest.split("{context}")
    prompt = strip(F.concat(F.lit(head), F.col(question), F.lit(middle), F.col("context"), F.lit(tail)))
    return queries.join(context, query_id).select(query_id, "hits", prompt.alias("prompt"))


def citations(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Pages per query and source over the query's hits, as a list and as ranges."""
    united = hits.groupBy(query_id, "source").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("page_numbers")))).alias("pages")
    )
    return united.select(
        query_id, "source", page_list(F.col("pages")).alias("page_list"), page_ranges(F.col("pages")).alias("page_ranges")
    )
