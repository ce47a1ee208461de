"""Streaming jobs as queries: the given table is the stream, what they wrote is the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import page_list
from larkspur.operators import embed
from larkspur.plans import knowledge
from larkspur.plans import views as v
from larkspur.plans.learning_queries import GROUP_LEVEL, GROUP_SCORES_SQL, _churn_sets, _logistic, group_model
from larkspur.plans.registry import query, r
from larkspur.session import scratch_path
from larkspur.streaming import jobs, pages


@query()
def stream_score(spark, sf_dir):
    training, _, categorical, numeric = _churn_sets(spark, sf_dir)
    model = _logistic(training, categorical, numeric)
    schema = v.table(spark, sf_dir, "orders").schema
    orders = jobs.file_stream(spark, f"{sf_dir}/orders.parquet", schema)
    records = v.account_columns(orders, v.table(spark, sf_dir, "customer")).drop("Churn Label")
    out, state = scratch_path(spark, "scores"), scratch_path(spark, "state")
    jobs.stream_scores(records, model, "CustomerID", categorical, numeric, out, state).awaitTermination()
    return spark.read.parquet(out)


@query(GROUP_SCORES_SQL)
def group_stream_score(spark, sf_dir):
    """Raw accounts scored as a stream, by a model that SQL can compute."""
    orders = jobs.file_stream(spark, f"{sf_dir}/orders.parquet", v.table(spark, sf_dir, "orders").schema)
    records = v.account_columns(orders, v.table(spark, sf_dir, "customer")).drop("Churn Label")
    out, state = scratch_path(spark, "scores"), scratch_path(spark, "state")
    jobs.stream_scores(records, group_model(spark, sf_dir), "CustomerID", [GROUP_LEVEL], [], out, state).awaitTermination()
    scored = spark.read.parquet(out)
    return scored.withColumn("probability", r("probability", 4))


_STREAMED_SQL = f"""WITH {v.LIBRARY_SQL} SELECT row_number() OVER (ORDER BY source, chunk_number) AS chunk_id, source,
  array_to_string(page_numbers, ', ') AS pages, text FROM chunks"""


def _published(spark, state):
    out = scratch_path(spark, "kb")
    pages.publish(spark, state, "library", out)
    stored = knowledge.load(spark, out, "library")
    return stored.select("chunk_id", "source", page_list(F.col("page_numbers")).alias("pages"), "text")


@query(_STREAMED_SQL)
def stream_kb(spark, sf_dir):
    schema = v.table(spark, sf_dir, "documents").schema
    documents = jobs.file_stream(spark, f"{sf_dir}/documents.parquet", schema)
    came = documents.select("source", F.col("doc_id").alias("page_number"), "text")
    state, checkpoint = scratch_path(spark, "pages"), scratch_path(spark, "state")
    pages.stream_knowledge(came, state, "library", embed.HashedTokens(), checkpoint).awaitTermination()
    return _published(spark, state)


@query(_STREAMED_SQL)
def stream_kb_batches(spark, sf_dir):
    """The pages of every source dealt over four micro-batches, the stream started again for each.

    One page in seven comes with another text first and is replaced by a later batch.
    """
    came = v.library_pages(spark, sf_dir).withColumn("deal", F.pmod(F.xxhash64("source", "page_number"), F.lit(4)))
    early = came.where("page_number % 7 = 0 and deal > 0").withColumn("deal", F.lit(0).cast("long")).withColumn("text", F.lit("a first draft"))
    came = came.unionByName(early)
    landing, state, checkpoint = (scratch_path(spark, n) for n in ("landing", "pages", "state"))
    for number in range(4):
        came.where(F.col("deal") == number).drop("deal").write.mode("append").option("compression", "zstd").parquet(landing)
        arrived = jobs.file_stream(spark, landing, came.drop("deal").schema)
        pages.stream_knowledge(arrived, state, "library", embed.HashedTokens(), checkpoint).awaitTermination()
    return _published(spark, state)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def stream_first_orders(spark, sf_dir):
    """Orders that are delivered twice, the second time in the next micro-batch: each is kept once."""
    orders = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("at"))
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "orders", "state"))
    for batch in range(3):
        now = orders.where((F.col("o_orderkey") % 2 == batch) | (F.col("o_orderkey") % 2 == batch - 1))
        now.write.mode("append").parquet(landing)
        arrived = jobs.file_stream(spark, landing, orders.schema)
        jobs.stream_first_records(arrived, "o_orderkey", "at", "10000 days", out, state).awaitTermination()
    return spark.read.parquet(out).drop("at")
