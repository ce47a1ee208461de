"""Page, chunk, search and evaluation queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import page_list
from larkspur.functions.vectors import norm
from larkspur.operators import answers, chunks, clusters, embed, intervals, rag_eval, svd, windows
from larkspur.operators.search import search
from larkspur.plans import knowledge
from larkspur.plans import views as v
from larkspur.plans.registry import query, r
from larkspur.plans.tabular_queries import _CLEAN_SQL
from larkspur.session import scratch_path, stored
from larkspur.sources import corpus

c = F.col
FLOOR = 0.35
GATE_FLOOR = 0.41  # high enough that some topics have no evidence
K = 5


# ---- pages and chunks -----------------------------------------------------------------


@query(f"""WITH {v.TURN_PAGES_SQL}, cleaned AS (SELECT source, page_number, {_CLEAN_SQL} AS text FROM raw_pages)
SELECT *, length(text) AS character_count FROM cleaned""")
def page_ingest(spark, sf_dir):
    return corpus.ingest_pages(v.turn_pages(spark, sf_dir))


@query(f"""WITH {v.TURN_PAGES_SQL}, stripped AS (SELECT source, page_number, trim(coalesce(text, ''), {v.STRIP_SET}) AS text FROM raw_pages)
SELECT *, length(text) AS character_count FROM stripped WHERE text <> ''""")
def page_ingest_stripped(spark, sf_dir):
    return corpus.ingest_pages(v.turn_pages(spark, sf_dir), clean=False, keep_empty=False)


@query(f"""WITH {v.TURN_PAGES_SQL}, cleaned AS (SELECT source, page_number, {_CLEAN_SQL} AS text FROM raw_pages),
counted AS (SELECT source, count(*) AS pages, count(*) FILTER (text <> '') AS pages_with_text, sum(length(text)) AS characters
  FROM cleaned GROUP BY source)
SELECT source, false AS is_total, 1 AS documents, pages, pages_with_text, characters::BIGINT AS characters FROM counted
UNION ALL SELECT NULL, true, count(*), sum(pages)::BIGINT, sum(pages_with_text)::BIGINT, sum(characters)::BIGINT FROM counted""")
def corpus_stats(spark, sf_dir):
    return chunks.document_stats(corpus.ingest_pages(v.turn_pages(spark, sf_dir)))


@query(f"""WITH {v.LIBRARY_SQL} SELECT source, page_number, "start"::BIGINT AS "start", "end"::BIGINT AS "end" FROM offsets""")
def page_offsets(spark, sf_dir):
    return chunks.page_offsets(v.library_pages(spark, sf_dir)).select("source", "page_number", "start", "end")


@query(f"""WITH {v.LIBRARY_SQL} SELECT source, chunk_number, array_to_string(page_numbers, ', ') AS pages, text,
  length(text) AS character_count FROM chunks""")
def chunk_documents(spark, sf_dir):
    cut = chunks.chunk_documents(v.library_pages(spark, sf_dir), 1000, 200)
    return cut.select("source", "chunk_number", page_list(c("page_numbers")).alias("pages"), "text", "character_count")


@query(f"""WITH {v.LIBRARY_SQL} SELECT row_number() OVER (ORDER BY source, chunk_number) AS chunk_id, source, chunk_number,
  length(text) AS character_count FROM chunks""")
def chunk_ids(spark, sf_dir):
    numbered = chunks.number_chunks(chunks.chunk_documents(v.library_pages(spark, sf_dir), 1000, 200))
    return numbered.select("chunk_id", "source", "chunk_number", "character_count")


# ---- search and answers ---------------------------------------------------------------


def _hits_sql(floor: float) -> str:
    return f"""WITH {v.CENTROIDS_SQL}, hits AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity_score DESC, chunk_id) AS rank
  FROM scored WHERE similarity_score >= {floor} QUALIFY rank <= {K})"""


def _hits(spark, sf_dir, floor):
    """Hits with their passage: the search reads ids and vectors only."""
    stored = v.passages(spark, sf_dir)
    hits = search(v.topics(spark, sf_dir), stored.select("chunk_id", "embedding"), K, floor)
    return answers.with_chunks(hits, stored)


_TOPK_SQL = f"""WITH {v.CENTROIDS_SQL} SELECT query_id, vec_id AS chunk_id, round_even(score, 6) AS similarity_score, rank FROM (
  SELECT query_id, vec_id, list_dot_product(v, embedding::DOUBLE[]) / n AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM topics, embeddings)
WHERE rank <= {K} AND score >= 0.1"""


@query(_TOPK_SQL)
def retrieve_topk(spark, sf_dir):
    stored = v.table(spark, sf_dir, "embeddings").select(c("vec_id").alias("chunk_id"), "embedding")
    hits = search(v.topics(spark, sf_dir), stored, K, 0.1)
    return hits.select("query_id", "chunk_id", r("similarity_score"), "rank")


@query(_TOPK_SQL)
def pruned_topk(spark, sf_dir):
    """The same hits from a clustered table, of which only the clusters that can hold them are read."""
    stored = v.table(spark, sf_dir, "embeddings").select(c("vec_id").alias("chunk_id"), "embedding")
    path = scratch_path(spark, "clustered")
    clusters.build(stored, path)
    hits = clusters.search(v.topics(spark, sf_dir), path, K, 0.1).hits
    return hits.select("query_id", "chunk_id", r("similarity_score"), "rank")


@query(f"""{_hits_sql(FLOOR)} SELECT query_id, chunk_id, source, array_to_string(page_numbers, ', ') AS pages,
  round_even(similarity_score, 6) AS similarity_score FROM hits WHERE rank = 1""")
def top_hit(spark, sf_dir):
    best = rag_eval.top_hit(_hits(spark, sf_dir, FLOOR))
    return best.select("query_id", "chunk_id", "source", page_list(c("page_numbers")).alias("pages"), r("similarity_score"))


@query("""SELECT count(embedding) AS vectors, min(len(embedding)) AS min_dimension, max(len(embedding)) AS max_dimension,
  round_even(max(abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1)), 5) AS norm_error,
  min(len(embedding)) = max(len(embedding)) AS uniform FROM embeddings""")
def vector_check(spark, sf_dir):
    out = embed.vector_check(v.table(spark, sf_dir, "embeddings"))
    return out.select("vectors", "min_dimension", "max_dimension", r("norm_error", 5), "uniform")


_HEAD, _REST = answers.PROMPT.replace("'", "''").split("{question}")
_MIDDLE = _REST.split("{context}")[0]


@query(f"""{_hits_sql(FLOOR)} SELECT query_id, count(*) AS hits, trim('{_HEAD}' || question || '{_MIDDLE}' || string_agg(
  '{answers.SOURCE}' || rank || chr(10) || '{answers.DOCUMENT}' || source || chr(10) || '{answers.PAGES}' || array_to_string(page_numbers, ', ') ||
  chr(10) || '{answers.TEXT}' || chr(10) || text || chr(10), chr(10) || chr(10) ORDER BY rank), {v.STRIP_SET}) AS prompt
FROM hits JOIN topics USING (query_id) GROUP BY query_id, question""")
def grounded_prompt(spark, sf_dir):
    asked = v.topics(spark, sf_dir).select("query_id", "question")
    return answers.grounded_prompts(asked, _hits(spark, sf_dir, FLOOR))


@query(f"""{_hits_sql(GATE_FLOOR)} SELECT query_id, question, count(chunk_id) AS hits, count(chunk_id) > 0 AS answerable,
  CASE WHEN count(chunk_id) > 0 THEN 'answerable' ELSE '{answers.INSUFFICIENT}' END AS status
FROM topics LEFT JOIN hits USING (query_id) GROUP BY query_id, question""")
def evidence_gate(spark, sf_dir):
    asked = v.topics(spark, sf_dir).select("query_id", "question")
    return answers.evidence_gate(asked, _hits(spark, sf_dir, GATE_FLOOR))


_UNITED_SQL = ", united AS (SELECT DISTINCT query_id, source, unnest(page_numbers) AS page FROM hits)"


@query(f"""{_hits_sql(FLOOR)} {_UNITED_SQL} SELECT query_id, source, string_agg(page, ', ' ORDER BY page) AS page_list
FROM united GROUP BY query_id, source""")
def source_pages(spark, sf_dir):
    return answers.citations(_hits(spark, sf_dir, FLOOR)).select("query_id", "source", "page_list")


@query(f"""{_hits_sql(FLOOR)} {_UNITED_SQL}, islands AS (
  SELECT query_id, source, page, page - row_number() OVER (PARTITION BY query_id, source ORDER BY page) AS island FROM united),
spans AS (SELECT query_id, source, min(page) AS first, max(page) AS last FROM islands GROUP BY query_id, source, island)
SELECT query_id, source, string_agg(CASE WHEN first = last THEN first::VARCHAR ELSE first || '-' || last END, ', ' ORDER BY first)
  AS page_ranges FROM spans GROUP BY query_id, source""")
def page_ranges(spark, sf_dir):
    return answers.citations(_hits(spark, sf_dir, FLOOR)).select("query_id", "source", "page_ranges")


# ---- evaluation -----------------------------------------------------------------------

_JUDGED_SQL = f"""{_hits_sql(FLOOR)}, {v.EXPECTED_SQL.strip()}, judged AS (
  SELECT t.query_id, count(h.chunk_id) AS hits,
    CASE WHEN count(e.query_id) = 0 THEN 'undefined question'
      WHEN max(e.expected_source) IS NULL AND count(h.chunk_id) = 0 THEN 'no hits, as expected'
      WHEN max(e.expected_source) IS NULL THEN 'hits for an unanswerable question'
      WHEN bool_or(coalesce(h.source = e.expected_source, false)) THEN 'expected source found'
      ELSE 'expected source not found' END AS reason
  FROM topics t LEFT JOIN hits h USING (query_id) LEFT JOIN expected e USING (query_id) GROUP BY t.query_id),
verdicts AS (SELECT *, reason IN ('no hits, as expected', 'expected source found') AS passed FROM judged)"""


def _judged(spark, sf_dir):
    return rag_eval.judge(
        v.topics(spark, sf_dir), _hits(spark, sf_dir, FLOOR), v.expected_sources(spark, sf_dir)
    )


@query(f"{_JUDGED_SQL} SELECT query_id, hits, reason, passed FROM verdicts")
def retrieval_eval(spark, sf_dir):
    return _judged(spark, sf_dir)


@query(f"""{_JUDGED_SQL} SELECT count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  round_even(100.0 * count(*) FILTER (passed) / count(*), 4) AS pass_rate FROM verdicts""")
def retrieval_summary(spark, sf_dir):
    return rag_eval.pass_summary(_judged(spark, sf_dir)).select("total", "passed", "failed", r("pass_rate", 4))


# ---- text to vectors, whole builds ----------------------------------------------------


@query(f"""WITH {v.LIBRARY_SQL}, {v.slots_sql("slotted", "chunks", "source, chunk_number", "text")}
SELECT source, chunk_number, slot, round_even((n / norm)::FLOAT::DOUBLE, 5) AS weight FROM slotted""")
def hash_embed(spark, sf_dir):
    """The entries of the chunks' vectors that are not zero."""
    cut = chunks.chunk_documents(v.library_pages(spark, sf_dir), 1000, 200)
    vectors = embed.HashedTokens().embed(cut.select("source", "chunk_number", "text"), "text")
    # The plain form would first test the size of every vector, and make it twice for that.
    entries = vectors.select("source", "chunk_number", F.posexplode_outer("embedding").alias("slot", "weight")).where("weight <> 0")
    return entries.select("source", "chunk_number", "slot", r("weight", 5))


def _sweep_sql() -> str:
    """Verdicts of every setting and question, from exact sums of products of counts."""
    parts = [v.library_sql()]
    for size, overlap in chunks.SWEEP:
        parts.append(v.library_sql(size, overlap, f"_{size}").lstrip())
    united = " UNION ALL ".join(
        f"SELECT {size} AS chunk_size, {overlap} AS chunk_overlap, source, chunk_number, text FROM chunks_{size}" for size, overlap in chunks.SWEEP
    )
    keys = "chunk_size, chunk_overlap, source, chunk_number"
    return f"""WITH {", ".join(parts)}, united AS ({united}), {v.slots_sql("stored", "united", keys, "text")},
{v.slots_sql("asked", "benchmark", "item_id", "text")},
lines AS (SELECT DISTINCT item_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM benchmark),
held AS (SELECT DISTINCT source, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents),
wanted AS (SELECT DISTINCT item_id, source FROM lines JOIN held USING (line) WHERE line <> ''),
scored AS (
  SELECT item_id, {keys}, sum(a.n * s.n) / (any_value(a.norm) * any_value(s.norm)) AS score
  FROM asked a JOIN stored s USING (slot) GROUP BY item_id, {keys}),
hit AS (
  SELECT * FROM scored WHERE score >= {FLOOR}
  QUALIFY row_number() OVER (PARTITION BY item_id, chunk_size, chunk_overlap ORDER BY round_even(score, 9) DESC, source, chunk_number) <= {K}),
found AS (
  SELECT item_id, chunk_size, chunk_overlap, count(*) AS hits, max(score) AS top_score,
    bool_or((hit.item_id, hit.source) IN (SELECT (item_id, source) FROM wanted)) AS matched FROM hit GROUP BY ALL),
counted AS (SELECT chunk_size, chunk_overlap, count(*) AS chunks FROM united GROUP BY ALL),
swept AS (
  SELECT chunk_size, chunk_overlap, chunks, item_id AS query_id, coalesce(hits, 0) AS hits,
    CASE WHEN item_id IN (SELECT item_id FROM wanted) THEN coalesce(matched, false) ELSE hits IS NULL END AS passed,
    round_even(top_score, 4) AS top_score
  FROM counted CROSS JOIN benchmark LEFT JOIN found USING (item_id, chunk_size, chunk_overlap))"""


@query(f"{_sweep_sql()} SELECT * FROM swept")
def chunk_size_sweep(spark, sf_dir):
    questions, expected = v.asked_passages(spark, sf_dir)
    swept = rag_eval.chunk_size_sweep(v.library_pages(spark, sf_dir), questions, expected, embed.HashedTokens())
    return swept.select("chunk_size", "chunk_overlap", "chunks", "query_id", "hits", "passed", r("top_score", 4))


@query(f"""{_sweep_sql()} SELECT chunk_size, chunk_overlap, chunks, count(*) AS total, count(*) FILTER (passed) AS passed,
  count(*) FILTER (NOT passed) AS failed, count(*) FILTER (passed) * 100.0::DOUBLE / count(*) AS pass_rate FROM swept GROUP BY ALL""")
def chunk_size_summary(spark, sf_dir):
    questions, expected = v.asked_passages(spark, sf_dir)
    swept = rag_eval.chunk_size_sweep(v.library_pages(spark, sf_dir), questions, expected, embed.HashedTokens())
    return rag_eval.sweep_summary(swept)


@query(f"""WITH {v.LIBRARY_SQL} SELECT row_number() OVER (ORDER BY source, chunk_number) AS chunk_id, 'library' AS kb_name, source,
  array_to_string(page_numbers, ', ') AS pages, text, 384 AS dimension FROM chunks""")
def kb_build(spark, sf_dir):
    path = scratch_path(spark, "kb")
    knowledge.build(v.library_pages(spark, sf_dir), path, "library", embed.HashedTokens())
    stored = knowledge.load(spark, path, "library")
    return stored.select(
        "chunk_id", "kb_name", "source", page_list(c("page_numbers")).alias("pages"), "text",
        F.size("embedding").alias("dimension"),
    )


@query()
def ask_knowledge_base(spark, sf_dir):
    path = scratch_path(spark, "kb")
    embedder = embed.HashedTokens()
    knowledge.build(v.library_pages(spark, sf_dir), path, "library", embedder)
    questions, _ = v.asked_passages(spark, sf_dir)
    return knowledge.ask(questions, knowledge.load(spark, path, "library"), embedder)


# ---- chunks as a table function, and stored intervals -------------------------------------


@query(f"""WITH {v.LIBRARY_SQL} SELECT source, chunk_number, array_to_string(page_numbers, ', ') AS pages, text,
  length(text) AS character_count FROM chunks""")
def chunk_udtf(spark, sf_dir):
    """The chunks of all documents from a table function called in SQL."""
    windows.register(spark)
    v.library_pages(spark, sf_dir).createOrReplaceTempView("pages_to_chunk")
    cut = spark.sql("SELECT * FROM chunk_pages(TABLE(pages_to_chunk) PARTITION BY source ORDER BY (page_number), 1000, 200)")
    return cut.select("source", "chunk_number", page_list(c("page_numbers")).alias("pages"), "text", "character_count")


@query(f"""WITH {v.LIBRARY_SQL}, passage AS (
  SELECT source, page_number AS n, "start" + length(text) // 3 AS s, "end" - length(text) // 3 AS e FROM offsets WHERE length(text) > 2),
span AS (SELECT source, chunk_number, s, e FROM raw_chunks)
SELECT passage.source, n::BIGINT AS page_number, chunk_number, (least(passage.e, span.e) - greatest(passage.s, span.s))::BIGINT AS shared
FROM passage JOIN span ON passage.source = span.source AND passage.s < span.e AND span.s < passage.e""")
def passage_chunks(spark, sf_dir):
    """The chunks that hold a part of the middle third of every page, by two stored tables of ranges."""
    placed = chunks.page_offsets(v.library_pages(spark, sf_dir))
    size = F.length("text")
    passages = placed.where(size > 2).select(
        "source", "page_number", (c("start") + F.floor(size / 3)).alias("start"), (c("end") - F.floor(size / 3)).alias("end"))
    path = scratch_path(spark, "passages")
    passages.write.parquet(path)
    ends = placed.groupBy("source").agg(F.max("end").alias("total"))
    last = F.when(c("total") <= 1000, 0).otherwise(F.ceil((c("total") - 1000) / 800))
    spans = ends.select("source", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk_number"))
    spans = spans.select("source", "chunk_number", (c("chunk_number") * 800).alias("start"),
                         F.least(c("chunk_number") * 800 + 1000, c("total")).alias("end"))
    stored = scratch_path(spark, "spans")
    spans.write.parquet(stored)
    met = intervals.overlapping(spark.read.parquet(path), spark.read.parquet(stored), ["source"])
    return met.select("source", "left.page_number", "right.chunk_number", "shared")


@query(f"""WITH {v.LIBRARY_SQL}, numbered AS (
  SELECT row_number() OVER (ORDER BY source, chunk_number) AS chunk_id, source, chunk_number, length(text) AS character_count FROM chunks)
SELECT 2::BIGINT AS version, * FROM numbered""")
def kb_versions(spark, sf_dir):
    """A second version published after a first one and a refused build: what a reader gets as current."""
    path = scratch_path(spark, "versions")
    pages = v.library_pages(spark, sf_dir)
    knowledge.publish(pages.where("page_number % 2 = 0"), path, "library", embed.HashedTokens())
    knowledge.publish(pages, path, "library", embed.HashedTokens())
    try:
        knowledge.publish(pages.where("false"), path, "library", embed.HashedTokens())
        raise AssertionError("an empty build was published")
    except ValueError:
        pass
    current = knowledge.versions(spark, path).agg(F.max("version").alias("version"))
    rows = knowledge.load_version(spark, path, "library").select("chunk_id", "source", "chunk_number", "character_count")
    return rows.withColumn("version", F.lit(current.first()["version"]))


@query(f"""WITH {v.LIBRARY_SQL} SELECT source, chunk_number, 32 AS dimension,
  regexp_matches(text, '[\\p{{L}}\\p{{N}}]')::INT::DOUBLE AS length FROM chunks""")
def trained_embed(spark, sf_dir):
    """Width and length of the chunks' vectors from an encoder that was trained on all chunks, saved and loaded."""
    cut = stored(chunks.chunk_documents(v.library_pages(spark, sf_dir), 1000, 200), "chunks")
    path = scratch_path(spark, "encoder")
    svd.fit(cut, rank=32, slots=4096, rounds=3).save(spark, path)
    vectors = svd.load(spark, path).encoder().embed(cut.select("source", "chunk_number", "text"), "text")
    return vectors.select("source", "chunk_number", F.size("embedding").alias("dimension"), r(norm(c("embedding")), 4).alias("length"))
