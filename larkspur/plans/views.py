"""Views of the given tables in the schemas the pipelines expect.

Every view covers whole tables. Missing, padded and out-of-range values are written in by
``CASE`` on key columns. Each view has an SQL twin under the same name in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import WHITESPACE
from larkspur.plans.churn import RATE_DIMENSIONS, SERVICES  # noqa: F401

SCORE_COLUMNS = ["math score", "reading score", "writing score"]
SCORE_FEATURES = ["gender", "race/ethnicity", "parental level of education", "lunch", "test preparation course"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SCORES_SQL = """
scores AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key,
    l_returnflag AS gender,
    'group ' || l_linenumber AS "race/ethnicity",
    'level ' || quarter(l_shipdate) AS "parental level of education",
    CASE WHEN l_orderkey % 103 <> 0 THEN l_linestatus END AS lunch,
    CASE WHEN l_quantity > 25 THEN 'completed' ELSE 'none' END AS "test preparation course",
    CASE WHEN l_orderkey % 101 = 0 OR l_orderkey % 89 = 0 THEN NULL
         WHEN l_orderkey % 97 = 0 THEN 120.0 ELSE l_quantity * 2 END AS "math score",
    CASE WHEN l_orderkey % 101 = 0 OR l_partkey % 79 = 0 THEN NULL
         WHEN l_partkey % 83 = 0 THEN -1.0 ELSE round(l_discount * 1000) END AS "reading score",
    CASE WHEN l_orderkey % 101 = 0 OR l_suppkey % 31 = 0 THEN NULL
         ELSE round(l_tax * 1000) END AS "writing score"
  FROM lineitem)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as exam scores: five categories and three scores with invalid ones."""
    c = F.col
    nothing = F.lit(None)
    gone = c("l_orderkey") % 101 == 0
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        c("l_returnflag").alias("gender"),
        F.concat(F.lit("group "), c("l_linenumber").cast("string")).alias("race/ethnicity"),
        F.concat(F.lit("level "), F.quarter("l_shipdate").cast("string")).alias("parental level of education"),
        F.when(c("l_orderkey") % 103 != 0, c("l_linestatus")).alias("lunch"),
        F.when(c("l_quantity") > 25, "completed").otherwise("none").alias("test preparation course"),
        F.when(gone | (c("l_orderkey") % 89 == 0), nothing)
        .when(c("l_orderkey") % 97 == 0, 120.0)
        .otherwise(c("l_quantity") * 2)
        .alias("math score"),
        F.when(gone | (c("l_partkey") % 79 == 0), nothing)
        .when(c("l_partkey") % 83 == 0, -1.0)
        .otherwise(F.rint(c("l_discount") * 1000))
        .alias("reading score"),
        F.when(gone | (c("l_suppkey") % 31 == 0), nothing).otherwise(F.rint(c("l_tax") * 1000)).alias("writing score"),
    )


CLEAN_SCORES_SQL = (
    SCORES_SQL
    + """,
guarded AS (
  SELECT * REPLACE (
    CASE WHEN "math score" BETWEEN 0 AND 100 THEN "math score" END AS "math score",
    CASE WHEN "reading score" BETWEEN 0 AND 100 THEN "reading score" END AS "reading score",
    CASE WHEN "writing score" BETWEEN 0 AND 100 THEN "writing score" END AS "writing score")
  FROM scores),
clean_scores AS (
  SELECT *, (coalesce("math score", 0) + coalesce("reading score", 0) + coalesce("writing score", 0))
    / (("math score" IS NOT NULL)::INT + ("reading score" IS NOT NULL)::INT + ("writing score" IS NOT NULL)::INT)
    AS overall_score
  FROM guarded
  WHERE "math score" IS NOT NULL OR "reading score" IS NOT NULL OR "writing score" IS NOT NULL),
banded AS (
  SELECT *, CASE WHEN overall_score IS NULL THEN 'Unknown' WHEN overall_score >= 70 THEN 'High'
    WHEN overall_score >= 50 THEN 'Medium' ELSE 'Low' END AS performance_category
  FROM clean_scores)"""
)


ACCOUNTS_SQL = """
accounts AS (
  SELECT o_orderkey AS "CustomerID",
    CASE WHEN o_custkey % 2 = 1 THEN 'Male' ELSE 'Female' END AS "Gender",
    CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS "Senior Citizen",
    CASE WHEN (o_orderkey >> 1) % 2 = 1 THEN 'Yes' ELSE 'No' END AS "Partner",
    CASE WHEN (o_orderkey >> 2) % 2 = 1 THEN 'Yes' ELSE 'No' END AS "Dependents",
    CASE WHEN o_orderkey % 71 <> 0 THEN months END AS "Tenure Months",
    'Yes' AS "Phone Service",
    CASE o_custkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'No phone service' ELSE ' yes ' END
      AS "Multiple Lines",
    c_mktsegment AS "Internet Service",
    CASE WHEN (o_orderkey >> 3) % 2 = 1 THEN ' Yes ' ELSE 'no' END AS "Online Security",
    CASE WHEN (o_orderkey >> 4) % 2 = 1 THEN ' Yes ' ELSE 'no' END AS "Online Backup",
    CASE WHEN (o_orderkey >> 5) % 2 = 1 THEN ' Yes ' ELSE 'no' END AS "Device Protection",
    CASE WHEN (o_orderkey >> 6) % 2 = 1 THEN ' Yes ' ELSE 'no' END AS "Tech Support",
    CASE WHEN (o_orderkey >> 7) % 2 = 1 THEN ' Yes ' ELSE 'no' END AS "Streaming TV",
    CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN (o_orderkey >> 8) % 2 = 1 THEN ' Yes ' ELSE 'no' END
      AS "Streaming Movies",
    o_orderpriority AS "Contract",
    CASE WHEN (o_orderkey >> 9) % 2 = 1 THEN 'Yes' ELSE 'No' END AS "Paperless Billing",
    CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check'
      WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END END
      AS "Payment Method",
    o_totalprice / greatest(months, 1) AS "Monthly Charges",
    CASE WHEN o_orderkey % 59 <> 0 THEN o_totalprice END AS "Total Charges",
    CASE WHEN o_orderkey % 113 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'Pending'
      WHEN months < CASE WHEN o_orderstatus = 'F' THEN 48 ELSE 16 END THEN 'Yes' ELSE 'No' END AS "Churn Label"
  FROM (SELECT *, floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') / 30)::DOUBLE AS months
        FROM orders) JOIN customer ON o_custkey = c_custkey)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers as accounts with the 21 columns of the churn pipeline."""
    return account_columns(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def account_columns(orders: DataFrame, customer: DataFrame) -> DataFrame:
    c = F.col

    def bit(i: int, yes: str, no: str):
        return F.when(F.shiftright("o_orderkey", i) % 2 == 1, yes).otherwise(no)

    months = F.floor(F.date_diff(F.lit("2001-08-02").cast("date"), c("o_orderdate").cast("date")) / 30).cast("double")
    payment = (
        F.when(c("c_nationkey") % 4 == 0, "Electronic check")
        .when(c("c_nationkey") % 4 == 1, "Mailed check")
        .when(c("c_nationkey") % 4 == 2, "Bank transfer (automatic)")
        .otherwise("Credit card (automatic)")
    )
    lines = (
        F.when(c("o_custkey") % 4 == 0, "Yes")
        .when(c("o_custkey") % 4 == 1, "No")
        .when(c("o_custkey") % 4 == 2, "No phone service")
        .otherwise(" yes ")
    )
    limit = F.when(c("o_orderstatus") == "F", 48).otherwise(16)
    return orders.withColumn("months", months).join(customer, c("o_custkey") == c("c_custkey")).select(
        c("o_orderkey").alias("CustomerID"),
        F.when(c("o_custkey") % 2 == 1, "Male").otherwise("Female").alias("Gender"),
        F.when(c("c_acctbal") > 5000, "Yes").otherwise("No").alias("Senior Citizen"),
        bit(1, "Yes", "No").alias("Partner"),
        bit(2, "Yes", "No").alias("Dependents"),
        F.when(c("o_orderkey") % 71 != 0, c("months")).alias("Tenure Months"),
        F.lit("Yes").alias("Phone Service"),
        lines.alias("Multiple Lines"),
        c("c_mktsegment").alias("Internet Service"),
        bit(3, " Yes ", "no").alias("Online Security"),
        bit(4, " Yes ", "no").alias("Online Backup"),
        bit(5, " Yes ", "no").alias("Device Protection"),
        bit(6, " Yes ", "no").alias("Tech Support"),
        bit(7, " Yes ", "no").alias("Streaming TV"),
        F.when(c("o_orderkey") % 61 != 0, bit(8, " Yes ", "no")).alias("Streaming Movies"),
        c("o_orderpriority").alias("Contract"),
        bit(9, "Yes", "No").alias("Paperless Billing"),
        F.when(c("o_orderkey") % 67 != 0, payment).alias("Payment Method"),
        (c("o_totalprice") / F.greatest(c("months"), F.lit(1.0))).alias("Monthly Charges"),
        F.when(c("o_orderkey") % 59 != 0, c("o_totalprice")).alias("Total Charges"),
        F.when(c("o_orderkey") % 113 == 0, None)
        .when(c("o_orderstatus") == "P", "Pending")
        .when(c("months") < limit, "Yes")
        .otherwise("No")
        .alias("Churn Label"),
    )


LABELLED_SQL = (
    ACCOUNTS_SQL
    + """,
labelled AS (
  SELECT *, CASE WHEN "Churn Label" = 'Yes' THEN 1 ELSE 0 END AS "Churn" FROM accounts
  WHERE "Churn Label" IN ('Yes', 'No')),
featured AS (
  SELECT *,
    CASE WHEN "Tenure Months" > 0 THEN "Total Charges" / "Tenure Months" ELSE "Monthly Charges" END AS "AvgMonthlySpend",
    CASE WHEN "Tenure Months" <= -1 THEN NULL WHEN "Tenure Months" <= 6 THEN '0-6 months'
      WHEN "Tenure Months" <= 12 THEN '7-12 months' WHEN "Tenure Months" <= 24 THEN '13-24 months'
      WHEN "Tenure Months" <= 48 THEN '25-48 months' WHEN "Tenure Months" > 48 THEN '49+ months' END AS "TenureGroup",
    CASE WHEN "Tenure Months" <= 6 THEN 'Yes' ELSE 'No' END AS "IsNewCustomer",
    """
    + " + ".join(f"""coalesce((lower(trim("{s}")) = 'yes')::INT, 0)""" for s in SERVICES)
    + """ AS "TotalServices"
  FROM labelled)"""
)


PREDICTIONS_SQL = """
predictions AS (
  SELECT o_orderkey AS id, o_orderstatus AS status,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS actual,
    ((o_orderkey * 37) % 1000 + CASE WHEN o_orderstatus = 'F' THEN 200 ELSE 0 END) / 1200.0::DOUBLE AS probability,
    ((o_custkey * 53) % 1000) / 1000.0::DOUBLE AS other_probability,
    o_totalprice AS amount,
    o_totalprice * 0.9::DOUBLE + (o_custkey % 100) * 100 AS estimate,
    o_totalprice * 0.8::DOUBLE + 40000 AS other_estimate
  FROM orders)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two probabilities for a 0/1 outcome and two estimates of an amount."""
    c = F.col
    hit = c("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("id"),
        c("o_orderstatus").alias("status"),
        F.when(hit, 1).otherwise(0).alias("actual"),
        (((c("o_orderkey") * 37) % 1000 + F.when(hit, 200).otherwise(0)) / F.lit(1200.0)).alias("probability"),
        (((c("o_custkey") * 53) % 1000) / F.lit(1000.0)).alias("other_probability"),
        c("o_totalprice").alias("amount"),
        (c("o_totalprice") * F.lit(0.9) + (c("o_custkey") % 100) * 100).alias("estimate"),
        (c("o_totalprice") * F.lit(0.8) + 40000).alias("other_estimate"),
    )


TURN_PAGES_SQL = """
raw_pages AS (
  SELECT conv_id::VARCHAR AS source, turn + 1 AS page_number,
    CASE WHEN conv_id % 29 = 0 AND turn = 1 THEN NULL
      ELSE chr(9) || replace(replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10)),
                             ', ', ',' || chr(9) || '  ') || ' ' END AS text
  FROM conversations)"""


def turn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents, one page per turn, with untidy white space."""
    text = F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n\r\n\r\n"))
    text = F.concat(F.lit("\t"), F.replace(text, F.lit(", "), F.lit(",\t  ")), F.lit(" "))
    blank = (F.col("conv_id") % 29 == 0) & (F.col("turn") == 1)
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("source"),
        (F.col("turn") + 1).alias("page_number"),
        F.when(~blank, text).alias("text"),
    )


def library_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: each source is one long document with a page per document."""
    return table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("page_number"), "text")


# Python's strip() set, for SQL: chr() codes joined to one text.
STRIP_SET = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

def library_sql(size: int = 1000, overlap: int = 200, suffix: str = "") -> str:
    """The pages, offsets and chunks of all documents; the names of what depends on the setting end in ``suffix``."""
    step = size - overlap
    pages = f"""
library AS (SELECT source, doc_id AS page_number, trim(text, {STRIP_SET}) AS text FROM documents),
offsets AS (
  SELECT source, page_number, text, upto - length(text) AS "start", upto AS "end"
  FROM (SELECT *, sum(length(text) + 2) OVER (PARTITION BY source ORDER BY page_number
                 ROWS UNBOUNDED PRECEDING) - 2 AS upto FROM library WHERE text <> '')),
whole AS (SELECT source, string_agg(text, chr(10) || chr(10) ORDER BY page_number) AS full_text,
            max("end") AS total FROM offsets GROUP BY source),"""
    return ("" if suffix else pages) + f"""
raw_chunks{suffix} AS (
  SELECT source, k AS chunk_number, k * {step} AS s, least(k * {step} + {size}, total) AS e,
    trim(substring(full_text, (k * {step} + 1)::BIGINT, {size}), {STRIP_SET}) AS text
  FROM whole, LATERAL unnest(range(0, CASE WHEN total <= {size} THEN 1
    ELSE CAST(ceil((total - {size}) / {step}.0) AS BIGINT) + 1 END)) t(k)),
chunks{suffix} AS (
  SELECT c.source, chunk_number, s, c.text, list(page_number ORDER BY page_number) AS page_numbers
  FROM raw_chunks{suffix} c JOIN offsets o ON o.source = c.source AND o."end" > c.s AND o."start" < c.e
  WHERE c.text <> '' GROUP BY ALL)"""


LIBRARY_SQL = library_sql()


def slots_sql(name: str, table: str, keys: str, text: str, dimension: int = 384) -> str:
    """``name``: keys, slot, its count n, and the norm, of the hashed tokens of a table's texts."""
    return f"""
{name} AS (
  SELECT *, sqrt(sum(n * n) OVER (PARTITION BY {keys})) AS norm FROM (
    SELECT {keys}, slot, count(*)::DOUBLE AS n FROM (
      SELECT {keys}, unnest(list_transform(list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''),
        lambda w: ('0x' || substr(md5(w), 1, 7))::INT % {dimension})) AS slot FROM {table}) GROUP BY ALL))"""


CENTROIDS_SQL = """
means AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY label, i),
topics AS (
  SELECT label AS query_id, 'Which passages are closest to topic ' || label || '?' AS question,
    list(m ORDER BY i) AS v, sqrt(sum(m * m)) AS n FROM means GROUP BY label),
passages AS (
  SELECT vec_id AS chunk_id, 'doc-' || label AS source, [vec_id % 7 + 1, vec_id % 7 + 2, vec_id % 5 + 8] AS page_numbers,
    coalesce(text, '') AS text, embedding FROM embeddings LEFT JOIN documents ON vec_id = doc_id),
scored AS (
  SELECT query_id, chunk_id, source, page_numbers, text,
    list_dot_product(v, embedding::DOUBLE[]) / n AS similarity_score
  FROM topics, passages)"""


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per label of the vectors: the unit mean vector of the label."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("v"),
        F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("n"),
    )
    question = F.concat(F.lit("Which passages are closest to topic "), F.col("label").cast("string"), F.lit("?"))
    return vectors.select(
        F.col("label").alias("query_id"), question.alias("question"),
        F.transform("v", lambda x: x / F.col("n")).alias("embedding"),
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with the text of the document of the same number, empty without one."""
    c = F.col
    vectors = table(spark, sf_dir, "embeddings")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return vectors.join(texts, c("vec_id") == c("doc_id"), "left").select(
        c("vec_id").alias("chunk_id"),
        F.concat(F.lit("doc-"), c("label").cast("string")).alias("source"),
        F.array(c("vec_id") % 7 + 1, c("vec_id") % 7 + 2, c("vec_id") % 5 + 8).alias("page_numbers"),
        F.coalesce("text", F.lit("")).alias("text"),
        "embedding",
    )


EXPECTED_SQL = """
expected AS (
  SELECT DISTINCT label AS query_id, CASE WHEN label <> 8 THEN 'doc-' || label END AS expected_source
  FROM embeddings WHERE label <> 9)"""


def expected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic 8 expects nothing, topic 9 is not defined, each other one expects its document."""
    labels = table(spark, sf_dir, "embeddings").select("label").distinct().where("label <> 9")
    own = F.array(F.concat(F.lit("doc-"), F.col("label").cast("string")))
    return labels.select(
        F.col("label").alias("query_id"),
        F.when(F.col("label") == 8, F.array().cast("array<string>")).otherwise(own).alias("expected_sources"),
    )


def asked_passages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(questions, expected sources): benchmark passages and the sources that hold a line of them."""
    items = table(spark, sf_dir, "benchmark")
    line = F.explode(F.transform(F.split("text", "\n"), lambda part: F.trim(part))).alias("line")
    asked = items.select("item_id", line).where("line <> ''").distinct()
    held = table(spark, sf_dir, "documents").select("source", line).where("line <> ''").distinct()
    found = asked.join(held, "line").groupBy("item_id").agg(F.collect_set("source").alias("found"))
    questions = items.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    expected = items.join(found, "item_id", "left").select(
        F.col("item_id").alias("query_id"), F.coalesce("found", F.array().cast("array<string>")).alias("expected_sources")
    )
    return questions, expected
