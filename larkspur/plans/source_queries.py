"""Readers and sinks as queries: tables are written in a source's format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import BOM, page_list, preview
from larkspur.operators import chunks, profile
from larkspur.operators.bounds import quoted
from larkspur.plans import exams
from larkspur.plans import views as v
from larkspur.plans.registry import query, r
from larkspur.session import scratch_path
from larkspur.sources import corpus, delimited

c = F.col
FILE_RECORDS = 1_000_000


@query("""SELECT o_orderkey::VARCHAR AS "CustomerID", o_custkey::VARCHAR AS "Tenure Months", o_orderpriority AS "City",
  CASE WHEN o_orderkey % 43 <> 0 THEN o_orderstatus END AS "Churn Label" FROM orders""")
def dirty_csv_read(spark, sf_dir):
    """Orders as files with junk, a byte-order mark, a late header, blank lines and written-out tabs."""
    label = F.when(c("o_orderkey") % 43 != 0, c("o_orderstatus")).otherwise("NA")
    tab = F.when(c("o_orderkey") % 5 == 0, "\\t").otherwise("\t")
    record = F.concat(
        c("o_orderkey").cast("string"), F.lit("\t "), c("o_custkey").cast("string"), tab, c("o_orderpriority"), F.lit(" \t"), label
    )
    record = F.when(c("o_orderkey") % 11 == 0, F.concat(record, F.lit("\n  "))).otherwise(record)
    file = F.floor(c("o_orderkey") / FILE_RECORDS).alias("file")
    rows = v.table(spark, sf_dir, "orders").select(file, F.lit(1).alias("part"), record.alias("value"))
    top = f"{BOM}exported table\n\n" + "CustomerID\\tTenure Months \tCity\tChurn Label"
    heads = rows.select("file").distinct().select("file", F.lit(0).alias("part"), F.lit(top).alias("value"))
    path = scratch_path(spark, "dirty")
    lines = heads.unionByName(rows).repartition("file").sortWithinPartitions("file", "part")
    lines.drop("part").write.partitionBy("file").text(path)
    out = delimited.read_dirty(spark, path)
    return out.select(*[quoted(x) for x in ("CustomerID", "Tenure Months", "City", "Churn Label")])


_BROKEN_SQL = "replace(text, '. ', '.' || chr(10) || chr(10) || '\"quoted\", and; on ')"


@query(f"""SELECT conv_id::VARCHAR AS "CustomerID", turn::VARCHAR AS "Tenure Months", role AS "Churn Label",
  nullif(trim({_BROKEN_SQL}, {v.STRIP_SET}), '') AS note FROM conversations""")
def dirty_multiline_read(spark, sf_dir):
    """Conversations as dirty files whose texts hold line breaks, blank lines, quotes and separators."""
    broken = F.replace(c("text"), F.lit(". "), F.lit('.\n\n"quoted", and; on '))
    note = F.concat(F.lit('"'), F.replace(broken, F.lit('"'), F.lit('""')), F.lit('"'))
    record = F.concat_ws(",", c("conv_id").cast("string"), note, c("turn").cast("string"), c("role"))
    file = F.floor(c("conv_id") / FILE_RECORDS).alias("file")
    rows = v.table(spark, sf_dir, "conversations").select(file, F.lit(1).alias("part"), record.alias("value"))
    top = '5" of junk, "never closed\nCustomerID,note,Tenure Months,Churn Label'
    heads = rows.select("file").distinct().select("file", F.lit(0).alias("part"), F.lit(top).alias("value"))
    path = scratch_path(spark, "dirty")
    lines = heads.unionByName(rows).repartition("file").sortWithinPartitions("file", "part")
    lines.drop("part").write.partitionBy("file").text(path)
    return delimited.read_dirty(spark, path).select(*[quoted(x) for x in ("CustomerID", "Tenure Months", "Churn Label", "note")])


@query(f"""SELECT conv_id, turn::BIGINT AS turn, {_BROKEN_SQL} AS text FROM conversations""")
def csv_multiline_roundtrip(spark, sf_dir):
    """Texts with line breaks written as plain files and read back in splits."""
    broken = F.replace(c("text"), F.lit(". "), F.lit('.\n\n"quoted", and; on '))
    path = scratch_path(spark, "csv")
    delimited.write_plain(v.table(spark, sf_dir, "conversations").select("conv_id", c("turn").cast("long"), broken.alias("text")), path)
    return delimited.read_plain(spark, path, "conv_id BIGINT, turn BIGINT, text STRING", multi_line=True)


@query(f"""WITH {v.ACCOUNTS_SQL} SELECT "CustomerID", "Gender", "Payment Method", "Tenure Months" AS months, "Total Charges" AS total
FROM accounts""")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = v.accounts(spark, sf_dir).select("CustomerID", "Gender", "Payment Method", "Tenure Months", "Total Charges")
    delimited.write_plain(rows, path)
    schema = "`CustomerID` BIGINT, `Gender` STRING, `Payment Method` STRING, months DOUBLE, total DOUBLE"
    return delimited.read_plain(spark, path, schema)


@query("""SELECT conv_id::VARCHAR AS source, (turn + 1)::INT AS page_number, text, length(text)::INT AS character_count FROM conversations""")
def corpus_json_read(spark, sf_dir):
    """Conversations as nested corpus objects, one page each, written and read back."""
    size = F.length("text")
    pages = F.array(F.struct((c("turn") + 1).cast("int").alias("page_number"), "text", size.alias("character_count")))
    document = F.struct(
        c("conv_id").cast("string").alias("source"), F.lit(1).alias("page_count"),
        size.cast("long").alias("total_character_count"), pages.alias("pages"),
    )
    rows = v.table(spark, sf_dir, "conversations").select(
        F.lit("library").alias("project"), F.lit("talk").alias("domain"), F.lit(1).alias("document_count"),
        F.array(document).alias("documents"),
    )
    path = scratch_path(spark, "corpus")
    corpus.write_json_rows(rows, path)
    return corpus.read_corpus(spark, path, multi_line=False)


@query(f"""SELECT trim(line, {v.STRIP_SET}) AS line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
WHERE trim(line, {v.STRIP_SET}) <> ''""")
def text_lines_read(spark, sf_dir):
    path = scratch_path(spark, "lines")
    padded = F.concat(F.lit("  "), c("text"), F.lit(" \n\n"))
    v.table(spark, sf_dir, "benchmark").select(padded.alias("value")).write.text(path)
    return corpus.read_lines(spark, path)


@query("""SELECT conv_id::VARCHAR AS source, turn + 1 AS page_number, text FROM conversations""")
def page_quarantine(spark, sf_dir):
    """Page lines among damaged ones: the good pages, with the damaged lines set aside."""
    page = F.to_json(F.struct(c("conv_id").cast("string").alias("source"), (c("turn") + 1).alias("page_number"), "text"))
    line = F.when(c("turn") == 0, F.concat(page, F.lit('\n{"source": "broken'))).otherwise(page)
    path = scratch_path(spark, "pages")
    v.table(spark, sf_dir, "conversations").select(line.alias("value")).write.text(path)
    good, _ = corpus.split_quarantine(corpus.read_pages(spark, path, "*.txt", bad_rows="quarantine"))
    return good.select("source", "page_number", "text")


@query("SELECT vec_id AS chunk_id, label, len(embedding) AS dimension FROM embeddings")
def vector_table(spark, sf_dir):
    path = scratch_path(spark, "vectors")
    rows = v.table(spark, sf_dir, "embeddings").select(c("vec_id").alias("chunk_id"), "embedding", "label")
    corpus.write_vectors(rows, path, "label")
    return corpus.read_vectors(spark, path).select("chunk_id", "label", F.size("embedding").alias("dimension"))


@query("""SELECT conv_id::VARCHAR AS source, (turn + 1)::VARCHAR AS pages, text, length(text)::INT AS character_count,
  turn::BIGINT AS chunk_id FROM conversations""")
def chunk_json_read(spark, sf_dir):
    """Chunk files, one JSON object per conversation, written as text and read back."""
    chunk = F.struct(
        c("conv_id").cast("string").alias("source"), F.array((c("turn") + 1).cast("int")).alias("page_numbers"), "text",
        F.length("text").alias("character_count"), c("turn").cast("long").alias("chunk_id"),
    )
    objects = v.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(chunk).alias("chunks")).select("chunks")
    path = scratch_path(spark, "chunks")
    corpus.as_object(objects, "value").write.text(path)
    out = corpus.read_chunks(spark, path, multi_line=False)
    return out.select("source", page_list(c("page_numbers")).alias("pages"), "text", "character_count", "chunk_id")


@query(f"""WITH paged AS (SELECT source, doc_id::INT AS page_number, text FROM documents),
counted AS (SELECT source, count(*)::INT AS page_count, sum(length(text))::BIGINT AS total_character_count FROM paged GROUP BY source)
SELECT 'library' AS project, 'prose' AS domain, (SELECT count(*) FROM counted)::INT AS document_count, source, page_count,
  total_character_count, page_number, text, length(text)::INT AS character_count FROM paged JOIN counted USING (source)""")
def json_document_roundtrip(spark, sf_dir):
    """All documents as one JSON document, a source with its pages each, written in parts and read back."""
    pages = v.library_pages(spark, sf_dir).select("source", c("page_number").cast("int").alias("page_number"), "text")
    path = scratch_path(spark, "document")
    corpus.write_corpus_document(pages, path, "library", "prose")
    return corpus.read_corpus_document(spark, path, in_parts=True)


@query(f"""WITH {v.LIBRARY_SQL}, numbered AS (
  SELECT row_number() OVER (ORDER BY source, chunk_number) AS chunk_id, source, array_to_string(page_numbers, ', ') AS pages, text FROM chunks)
SELECT (SELECT count(DISTINCT source) FROM numbered)::INT AS source_document_count, 1000 AS chunk_size, 200 AS chunk_overlap,
  (SELECT count(*) FROM numbered)::INT AS chunk_count, source, pages, text, length(text)::INT AS character_count, chunk_id FROM numbered""")
def chunk_document_roundtrip(spark, sf_dir):
    """All chunks as one JSON document with its settings and counts, written in parts and read back."""
    cut = chunks.number_chunks(chunks.chunk_documents(v.library_pages(spark, sf_dir), 1000, 200, True))
    path = scratch_path(spark, "document")
    corpus.write_chunk_document(cut, path, "library", "prose", 1000, 200)
    out = corpus.read_chunk_document(spark, path, in_parts=True)
    return out.select("source_document_count", "chunk_size", "chunk_overlap", "chunk_count", "source",
                      page_list(c("page_numbers")).alias("pages"), "text", "character_count", "chunk_id")


@query("""SELECT '{"source": "broken' AS line, count(*) AS lines FROM conversations WHERE turn = 0 HAVING count(*) > 0""")
def quarantined_lines(spark, sf_dir):
    """The damaged lines that ``page_quarantine`` sets aside, counted by their text."""
    page = F.to_json(F.struct(c("conv_id").cast("string").alias("source"), (c("turn") + 1).alias("page_number"), "text"))
    line = F.when(c("turn") == 0, F.concat(page, F.lit('\n{"source": "broken'))).otherwise(page)
    path = scratch_path(spark, "pages")
    v.table(spark, sf_dir, "conversations").select(line.alias("value")).write.text(path)
    _, bad = corpus.split_quarantine(corpus.read_pages(spark, path, "*.txt", bad_rows="quarantine"))
    return bad.groupBy(c("_corrupt_record").alias("line")).agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT doc_id, substr(text, 1, 500) AS preview FROM documents")
def text_preview(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", preview(c("text")).alias("preview"))


@query("""SELECT count(*) AS rows, (SELECT count(*) FROM (DESCRIBE customer))::INT AS columns FROM customer""")
def table_shape(spark, sf_dir):
    return profile.shape(v.table(spark, sf_dir, "customer"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5")
def table_preview(spark, sf_dir):
    rows = v.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return profile.preview(rows, ["c_acctbal", "c_custkey"])


_DISTINCT_SCORES_SQL = v.CLEAN_SCORES_SQL.replace("FROM scores)", "FROM (SELECT DISTINCT * EXCLUDE (row_key) FROM scores))")


@query(f"""WITH {_DISTINCT_SCORES_SQL} SELECT * EXCLUDE (overall_score), round_even(overall_score, 6) AS overall_score FROM banded""")
def exam_pipeline_clean(spark, sf_dir):
    """Exam rows written as a plain file without ids, read with their places as ids, deduplicated and cleaned."""
    path = scratch_path(spark, "exams")
    delimited.write_plain(v.scores(spark, sf_dir).drop("row_key"), path)
    rows = exams.clean_scores(exams.load(spark, path), id_column="row_id")
    return rows.withColumn("overall_score", r("overall_score")).drop("row_id")
