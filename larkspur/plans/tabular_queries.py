"""Cleaning, row functions and profiles as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import tabular as ft
from larkspur.functions.text import NUMBER_SHAPE, clean_text as clean_expr, flatten_blocks as flatten_expr
from larkspur.operators import clean, models, profile, rag_eval, sketches
from larkspur.operators.bounds import quoted
from larkspur.operators.metrics import extents
from larkspur.operators.summaries import summarize
from larkspur.plans import churn, exams
from larkspur.plans import views as v
from larkspur.plans.registry import query, r
from larkspur.session import scratch_path

c = F.col


def labelled(spark, sf_dir):
    return clean.keep_labels(v.accounts(spark, sf_dir), "Churn Label")


def featured(spark, sf_dir):
    return churn.add_features(labelled(spark, sf_dir))


def clean_scores(spark, sf_dir):
    return exams.clean_scores(v.scores(spark, sf_dir), dedupe=False)


# ---- cleaning -------------------------------------------------------------------------


@query(f"""
SELECT c_custkey, trim(chr(9) || '  ' || c_name || ' ' || chr(10) || chr(160), {v.STRIP_SET}) AS c_name,
  CASE WHEN c_custkey % 10 <> 0 THEN trim(' ' || c_mktsegment || chr(8195), {v.STRIP_SET}) END AS c_mktsegment
FROM customer""")
def string_trim(spark, sf_dir):
    padded = v.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("\t  "), c("c_name"), F.lit(" \n\xa0")).alias("c_name"),
        F.when(c("c_custkey") % 10 != 0, F.concat(F.lit(" "), c("c_mktsegment"), F.lit(" "))).alias("c_mktsegment"),
    )
    return clean.trim_strings(padded)


@query(f"""
WITH texts AS (
  SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN ' ' || o_orderkey || ' ' WHEN 1 THEN '' WHEN 2 THEN 'x' || o_orderkey
    WHEN 3 THEN o_orderkey || 'd' WHEN 4 THEN 'NaN' WHEN 5 THEN 'inf' WHEN 6 THEN NULL
    ELSE '-' || o_orderkey || '.5e1' END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(trim(raw), '{NUMBER_SHAPE}') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS value
FROM texts""")
def numeric_coerce(spark, sf_dir):
    key = c("o_orderkey").cast("string")
    kind = c("o_orderkey") % 8
    raw = (
        F.when(kind == 0, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(kind == 1, "")
        .when(kind == 2, F.concat(F.lit("x"), key))
        .when(kind == 3, F.concat(key, F.lit("d")))
        .when(kind == 4, "NaN")
        .when(kind == 5, "inf")
        .when(kind == 6, None)
        .otherwise(F.concat(F.lit("-"), key, F.lit(".5e1")))
    )
    texts = v.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("value"))
    return clean.coerce_numeric(texts, ["value"])


def _per_score(value: str) -> str:
    return " UNION ALL ".join(value.replace("@", column) for column in v.SCORE_COLUMNS)


@query(f"""WITH {v.CLEAN_SCORES_SQL}
SELECT g.*, i.invalid FROM ({_per_score('''SELECT '@' AS "column", count("@") AS valid, sum("@") AS total FROM guarded''')}) g
JOIN ({_per_score('''SELECT '@' AS "column", count(*) FILTER ("@" < 0 OR "@" > 100) AS invalid FROM scores''')}) i
USING ("column")""")
def range_guard(spark, sf_dir):
    raw = v.scores(spark, sf_dir)
    guarded = clean.guard_range(raw, v.SCORE_COLUMNS)
    kept = guarded.select(*[quoted(s) for s in v.SCORE_COLUMNS]).unpivot(
        [], [quoted(s) for s in v.SCORE_COLUMNS], "column", "x"
    )
    totals = kept.groupBy("column").agg(F.count("x").alias("valid"), F.sum("x").alias("total"))
    return totals.join(clean.invalid_counts(raw, v.SCORE_COLUMNS), "column")


@query(f"""WITH {v.CLEAN_SCORES_SQL}
SELECT row_key, "math score" AS math, "reading score" AS reading, "writing score" AS writing FROM clean_scores""")
def drop_all_null(spark, sf_dir):
    kept = clean.drop_all_missing(clean.guard_range(v.scores(spark, sf_dir), v.SCORE_COLUMNS), v.SCORE_COLUMNS)
    return kept.select(
        "row_key", quoted("math score").alias("math"), quoted("reading score").alias("reading"),
        quoted("writing score").alias("writing"),
    )


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", "Churn Label", "Churn" FROM labelled""")
def target_filter(spark, sf_dir):
    return labelled(spark, sf_dir).select("CustomerID", "Churn Label", "Churn")


_SLIM = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def dedupe_rows(spark, sf_dir):
    return clean.drop_duplicate_rows(v.table(spark, sf_dir, "lineitem").select(*_SLIM))


@query("""
SELECT count(*) AS total_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem))
    AS duplicate_rows FROM lineitem""")
def duplicate_count(spark, sf_dir):
    return clean.duplicate_counts(v.table(spark, sf_dir, "lineitem").select(*_SLIM))


@query("""
WITH keyed AS (SELECT CASE WHEN o_custkey % 97 <> 0 THEN o_custkey END AS customer, o_orderdate, o_orderkey,
                 o_orderstatus, o_totalprice FROM orders)
SELECT customer, o_orderkey, o_orderstatus, o_totalprice FROM keyed
QUALIFY row_number() OVER (PARTITION BY customer ORDER BY o_orderdate, o_orderkey) = 1""")
def dedupe_by_key(spark, sf_dir):
    keyed = v.table(spark, sf_dir, "orders").select(
        F.when(c("o_custkey") % 97 != 0, c("o_custkey")).alias("customer"),
        "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice",
    )
    first = clean.first_by_key(keyed, ["customer"], ["o_orderdate", "o_orderkey"])
    return first.select("customer", "o_orderkey", "o_orderstatus", "o_totalprice")


_ACCOUNT_COLUMNS = [
    "CustomerID", *[x for x in churn.CATEGORICAL if x not in ("TenureGroup", "IsNewCustomer")],
    "Tenure Months", "Monthly Charges", "Total Charges", "Churn Label",
]


def _per_column(columns, select: str) -> str:
    return " UNION ALL ".join(select.replace("@", column) for column in columns)


@query(f"""WITH {v.ACCOUNTS_SQL}
SELECT * FROM ({_per_column(_ACCOUNT_COLUMNS, '''SELECT '@' AS "column", count(*) - count("@") AS missing FROM accounts''')})
WHERE missing > 0""")
def missing_counts(spark, sf_dir):
    return clean.missing_counts(v.accounts(spark, sf_dir), _ACCOUNT_COLUMNS, only_missing=True)


@query(f"""WITH {v.SCORES_SQL} {_per_score(
    '''SELECT '@' AS "column", min("@") AS min_value, max("@") AS max_value FROM scores''')}""")
def column_ranges(spark, sf_dir):
    return clean.column_ranges(v.scores(spark, sf_dir), v.SCORE_COLUMNS)


_TYPES = {"CustomerID": "bigint", "Tenure Months": "double", "Monthly Charges": "double", "Total Charges": "double"}


@query(f"WITH {v.ACCOUNTS_SQL} " + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", '{_TYPES.get(x, "string")}' AS data_type, count(*) - count("{x}") AS missing_values,
    count(DISTINCT "{x}") AS unique_values FROM accounts""" for x in _ACCOUNT_COLUMNS))
def quality_report(spark, sf_dir):
    return profile.quality_report(v.accounts(spark, sf_dir).select(*[quoted(x) for x in _ACCOUNT_COLUMNS]))


_CANDIDATES = [*churn.CATEGORICAL, *churn.NUMERICAL]


@query(f"WITH {v.LABELLED_SQL} " + " UNION ALL ".join(
    f"""SELECT {i + 1} AS position, '{x}' AS feature, count(DISTINCT "{x}") <= 1 AS is_constant FROM featured"""
    for i, x in enumerate(_CANDIDATES)))
def constant_features(spark, sf_dir):
    return profile.constant_features(featured(spark, sf_dir), _CANDIDATES)


# ---- row functions --------------------------------------------------------------------


@query(f"WITH {v.CLEAN_SCORES_SQL} SELECT row_key, round_even(overall_score, 6) AS overall_score FROM clean_scores")
def row_mean(spark, sf_dir):
    return clean_scores(spark, sf_dir).select("row_key", r("overall_score"))


@query(f"WITH {v.CLEAN_SCORES_SQL} SELECT row_key, performance_category FROM banded")
def performance_category(spark, sf_dir):
    return clean_scores(spark, sf_dir).select("row_key", "performance_category")


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", "AvgMonthlySpend" AS avg_monthly_spend FROM featured""")
def avg_monthly_spend(spark, sf_dir):
    return featured(spark, sf_dir).select("CustomerID", c("AvgMonthlySpend").alias("avg_monthly_spend"))


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", "Tenure Months" AS months, "TenureGroup" AS tenure_group,
  CASE "TenureGroup" WHEN '0-6 months' THEN 1 WHEN '7-12 months' THEN 2 WHEN '13-24 months' THEN 3
    WHEN '25-48 months' THEN 4 WHEN '49+ months' THEN 5 END AS ordinal FROM featured""")
def tenure_group(spark, sf_dir):
    return featured(spark, sf_dir).select(
        "CustomerID", quoted("Tenure Months").alias("months"), c("TenureGroup").alias("tenure_group"),
        ft.tenure_ordinal(c("TenureGroup")).alias("ordinal"),
    )


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", "IsNewCustomer" AS is_new FROM featured""")
def is_new_customer(spark, sf_dir):
    return featured(spark, sf_dir).select("CustomerID", c("IsNewCustomer").alias("is_new"))


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", "TotalServices" AS services FROM featured""")
def total_services(spark, sf_dir):
    return featured(spark, sf_dir).select("CustomerID", c("TotalServices").alias("services"))


_BAND_SQL = """CASE WHEN probability < 0.30 THEN 'Low' WHEN probability < 0.60 THEN 'Medium' ELSE 'High' END"""


@query(f"WITH {v.PREDICTIONS_SQL} SELECT id, actual, round_even(probability, 6) AS probability, {_BAND_SQL} AS risk_band FROM predictions")
def risk_band(spark, sf_dir):
    return v.predictions(spark, sf_dir).select("id", "actual", r("probability"), ft.risk_band(c("probability")).alias("risk_band"))


@query(f"""WITH {v.PREDICTIONS_SQL}, bands AS (SELECT id, CASE WHEN id % 50 = 0 THEN 'Unrated' ELSE {_BAND_SQL} END AS risk_band
  FROM predictions)
SELECT id, risk_band, CASE risk_band {" ".join(f"WHEN '{k}' THEN '{t}'" for k, t in ft.RISK_ACTIONS.items())}
  ELSE '{ft.DEFAULT_ACTION}' END AS action FROM bands""")
def risk_actions(spark, sf_dir):
    band = F.when(c("id") % 50 == 0, "Unrated").otherwise(ft.risk_band(c("probability")))
    bands = v.predictions(spark, sf_dir).select("id", band.alias("risk_band"))
    return models.with_actions(bands, models.action_table(spark)).select("id", "risk_band", "action")


_CLEAN_SQL = f"""trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'),
  '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {v.STRIP_SET})"""


@query(f"WITH {v.TURN_PAGES_SQL} SELECT source, page_number, {_CLEAN_SQL} AS text FROM raw_pages")
def clean_text(spark, sf_dir):
    return v.turn_pages(spark, sf_dir).select("source", "page_number", clean_expr(c("text")).alias("text"))


@query(f"""
WITH answers AS (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN ' ' || text || ' ' WHEN turn % 3 = 1 THEN role || chr(10) || text
    ELSE '  ' END AS answer FROM conversations)
SELECT conv_id, turn, nullif(trim(answer, {v.STRIP_SET}), '') AS answer FROM answers""")
def flatten_blocks(spark, sf_dir):
    def block(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    blocks = F.when(
        c("turn") % 3 == 1,
        F.array(block("text", c("role")), block("image", F.lit("skipped")), block("text", F.lit("")), block("text", c("text"))),
    ).when(c("turn") % 3 == 2, F.array(block("text", F.lit("  ")), block("image", c("text"))))
    plain = F.when(c("turn") % 3 == 0, F.concat(F.lit(" "), c("text"), F.lit(" ")))
    rows = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", plain.alias("plain"), blocks.alias("blocks"))
    return rows.select("conv_id", "turn", flatten_expr(c("plain"), c("blocks")).alias("answer"))


# ---- profiles -------------------------------------------------------------------------

_DESCRIBED = [*v.SCORE_COLUMNS, "overall_score"]


@query(f"WITH {v.CLEAN_SCORES_SQL} " + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", count("{x}") AS count, round_even(avg("{x}"), 4) AS mean,
    round_even(stddev_samp("{x}"), 4) AS std, round_even(min("{x}"), 4) AS min, round_even(quantile_cont("{x}", 0.25), 4) AS q25,
    round_even(quantile_cont("{x}", 0.5), 4) AS q50, round_even(quantile_cont("{x}", 0.75), 4) AS q75,
    round_even(max("{x}"), 4) AS max FROM clean_scores""" for x in _DESCRIBED))
def describe_scores(spark, sf_dir):
    return profile.describe(clean_scores(spark, sf_dir), _DESCRIBED, digits=4)


_COUNTED = [*v.SCORE_FEATURES, "performance_category"]


@query(f"WITH {v.CLEAN_SCORES_SQL} " + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", "{x}" AS value, count(*) AS count FROM banded WHERE "{x}" IS NOT NULL GROUP BY "{x}" """
    for x in _COUNTED))
def value_counts(spark, sf_dir):
    return profile.value_counts(clean_scores(spark, sf_dir), _COUNTED)


def _group_sql(key: str, extra: str = "") -> str:
    return f"""WITH {v.CLEAN_SCORES_SQL}
SELECT "{key}", count(overall_score) AS count, round_even(avg(overall_score), 4) AS mean,
  round_even(median(overall_score), 4) AS median{extra}
FROM clean_scores WHERE "{key}" IS NOT NULL GROUP BY "{key}" """


@query(_group_sql("lunch"))
def group_stats_by_flag(spark, sf_dir):
    return profile.group_stats(clean_scores(spark, sf_dir), "lunch", "overall_score", 4)


@query(_group_sql("race/ethnicity", """,
  row_number() OVER (ORDER BY avg(overall_score) DESC, "race/ethnicity") AS position"""))
def group_stats_sorted(spark, sf_dir):
    return profile.group_stats(clean_scores(spark, sf_dir), "race/ethnicity", "overall_score", 4, by_mean=True)


@query(f"WITH {v.CLEAN_SCORES_SQL} " + " UNION ALL ".join(
    f"""SELECT '{x}' AS dimension, "{x}" AS level, round_even(avg(overall_score), 4) AS mean FROM clean_scores
    WHERE "{x}" IS NOT NULL GROUP BY "{x}" """ for x in v.SCORE_FEATURES))
def group_means(spark, sf_dir):
    means = profile.group_means(clean_scores(spark, sf_dir), v.SCORE_FEATURES, "overall_score")
    return means.select("dimension", "level", r("mean", 4))


_RATES_SQL = f"WITH {v.LABELLED_SQL}, rated AS (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS dimension, "{x}" AS level, avg("Churn") AS rate, count("Churn") AS count FROM featured
    WHERE "{x}" IS NOT NULL GROUP BY "{x}" """ for x in v.RATE_DIMENSIONS) + ")"


def _rates(spark, sf_dir):
    return profile.rates(featured(spark, sf_dir), v.RATE_DIMENSIONS, "Churn")


@query(f"""{_RATES_SQL} SELECT dimension, level, round_even(rate, 6) AS rate, round_even(rate * 100, 4) AS percent, count,
  row_number() OVER (PARTITION BY dimension ORDER BY rate DESC, level) AS place FROM rated""")
def churn_rates(spark, sf_dir):
    ranked = profile.ranked_rates(_rates(spark, sf_dir))
    return ranked.select("dimension", "level", r("rate"), r(c("rate") * 100, 4).alias("percent"), "count", "place")


@query(f"WITH {v.CLEAN_SCORES_SQL} " + _per_score(
    '''SELECT '@' AS "column", round_even(avg("@"), 6) AS mean FROM clean_scores'''))
def subject_means(spark, sf_dir):
    return profile.column_means(clean_scores(spark, sf_dir), v.SCORE_COLUMNS).select("column", r("mean"))


@query(f"""WITH {v.CLEAN_SCORES_SQL}, {v.PREDICTIONS_SQL.strip()}
SELECT round_even(avg(overall_score), 6) AS mean, round_even(median(overall_score), 6) AS median,
  round_even(max(overall_score), 6) AS max, round_even(min(overall_score), 6) AS min,
  (SELECT round_even(least(min(amount), min(estimate)), 4) FROM predictions) AS axis_min,
  (SELECT round_even(greatest(max(amount), max(estimate)), 4) FROM predictions) AS axis_max
FROM clean_scores""")
def overall_summary(spark, sf_dir):
    one = summarize(clean_scores(spark, sf_dir), [], ["overall_score"], ["mean", "max", "min"], {"median": 0.5})
    axis = extents(v.predictions(spark, sf_dir), "amount", "estimate").first()
    return one.select(
        r("mean"), r("median"), r("max"), r("min"),
        F.bround(F.lit(axis["min_value"]), 4).alias("axis_min"), F.bround(F.lit(axis["max_value"]), 4).alias("axis_max"),
    )


@query(f"""{_RATES_SQL}, sides AS (
  SELECT dimension, count(*) AS levels, arg_max(level, (rate, level)) AS highest, max(rate) AS highest_rate,
    arg_min(level, (rate, level)) AS lowest, min(rate) AS lowest_rate,
    max(CASE WHEN level = 'Yes' THEN rate END) AS yes_rate, max(CASE WHEN level = 'No' THEN rate END) AS no_rate
  FROM rated GROUP BY dimension)
SELECT dimension, levels, CASE WHEN levels = 1 THEN 'limited'
    WHEN dimension = 'Senior Citizen' AND yes_rate IS NOT NULL AND no_rate IS NOT NULL THEN 'pair'
    WHEN dimension = 'Senior Citizen' THEN 'limited' ELSE 'extremes' END AS kind,
  highest, round_even(highest_rate, 6) AS highest_rate, lowest, round_even(lowest_rate, 6) AS lowest_rate,
  CASE WHEN dimension = 'Senior Citizen' THEN round_even(yes_rate, 6) END AS first_rate,
  CASE WHEN dimension = 'Senior Citizen' THEN round_even(no_rate, 6) END AS second_rate
FROM sides""")
def rate_extremes(spark, sf_dir):
    out = profile.rate_extremes(_rates(spark, sf_dir), "Senior Citizen")
    return out.select(
        "dimension", "levels", "kind", "highest", r("highest_rate"), "lowest", r("lowest_rate"), r("first_rate"), r("second_rate")
    )


@query(f"""WITH {v.CLEAN_SCORES_SQL}, edges AS (SELECT min(overall_score) AS lo, max(overall_score) AS hi FROM clean_scores),
counted AS (SELECT least(floor(20 * (overall_score - lo) / (hi - lo))::BIGINT + 1, 20) AS bin, count(*) AS count
  FROM clean_scores, edges GROUP BY 1)
SELECT b.bin, round_even(lo + (b.bin - 1) * ((hi - lo) / 20), 6) AS low, round_even(lo + b.bin * ((hi - lo) / 20), 6) AS high,
  coalesce(count, 0) AS count
FROM range(1, 21) b(bin) CROSS JOIN edges LEFT JOIN counted USING (bin)""")
def histogram(spark, sf_dir):
    return profile.histogram(clean_scores(spark, sf_dir), "overall_score", 20).select("bin", r("low"), r("high"), "count")


@query(f"""WITH {v.LABELLED_SQL}, boxes AS (
  SELECT "Churn Label" AS label, count(*) AS count, quantile_cont("Monthly Charges", 0.25) AS q1,
    quantile_cont("Monthly Charges", 0.5) AS median, quantile_cont("Monthly Charges", 0.75) AS q3
  FROM featured WHERE "Monthly Charges" IS NOT NULL GROUP BY 1),
marked AS (SELECT b.*, "Monthly Charges" AS x, "Monthly Charges" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM featured JOIN boxes b ON "Churn Label" = label)
SELECT label, count, round_even(q1, 4) AS q1, round_even(median, 4) AS median, round_even(q3, 4) AS q3,
  round_even(min(x) FILTER (inside), 4) AS whisker_low, round_even(max(x) FILTER (inside), 4) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM marked GROUP BY ALL""")
def boxplot_stats(spark, sf_dir):
    out = profile.boxplot(featured(spark, sf_dir), "Churn Label", "Monthly Charges")
    return out.select(
        quoted("Churn Label").alias("label"), "count", r("q1", 4), r("median", 4), r("q3", 4), r("whisker_low", 4),
        r("whisker_high", 4), "outliers",
    )


@query(f"""{_RATES_SQL} SELECT CASE level WHEN '0-6 months' THEN 1 WHEN '7-12 months' THEN 2 WHEN '13-24 months' THEN 3
    WHEN '25-48 months' THEN 4 WHEN '49+ months' THEN 5 END AS ordinal, level, round_even(rate, 6) AS rate, count
FROM rated WHERE dimension = 'TenureGroup' ORDER BY 1""")
def tenure_rates_ordered(spark, sf_dir):
    rated = profile.rates(featured(spark, sf_dir), ["TenureGroup"], "Churn")
    return rated.select(ft.tenure_ordinal(c("level")).alias("ordinal"), "level", r("rate"), "count").orderBy("ordinal")


@query(f"WITH {v.LABELLED_SQL}, firsts AS (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS feature, "{x}" AS value, min("CustomerID") AS first FROM featured WHERE "{x}" IS NOT NULL GROUP BY "{x}" """
    for x in churn.CATEGORICAL) + ") " + " UNION ALL ".join(
    f"""SELECT '{x}' AS feature, 'numeric' AS type, 0 AS position, NULL AS value, round_even(min("{x}"), 4) AS min,
    round_even(max("{x}"), 4) AS max, round_even(median("{x}"), 4) AS median FROM featured""" for x in churn.NUMERICAL)
    + """ UNION ALL SELECT feature, 'categorical', row_number() OVER (PARTITION BY feature ORDER BY first, value), value,
    NULL, NULL, NULL FROM firsts""")
def feature_profile(spark, sf_dir):
    rows = featured(spark, sf_dir)
    out = profile.feature_profile(rows, [*churn.CATEGORICAL, *churn.NUMERICAL], "CustomerID")
    return out.select("feature", "type", "position", "value", r("min", 4), r("max", 4), r("median", 4))


@query(f"""WITH {v.LABELLED_SQL} SELECT round_even(avg("Churn"), 6) AS positive_rate,
  round_even(greatest(avg("Churn"), 1 - avg("Churn")), 6) AS baseline_accuracy FROM featured""")
def majority_baseline(spark, sf_dir):
    return profile.majority_baseline(featured(spark, sf_dir), "Churn").select(r("positive_rate"), r("baseline_accuracy"))


_POINTS = {
    "relevance": "quality * 2",
    "grounding": "quality + 1 - toxic",
    "correctness": "quality",
    "completeness": "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 1 END",
    "hallucination avoidance": "(1 - toxic) * 2",
    "source references": "CASE WHEN doc_id % 11 = 0 THEN 3 ELSE quality + toxic END",
}
_RUBRIC_SQL = "WITH marks AS (" + " UNION ALL ".join(
    f"SELECT doc_id AS question, '{name}' AS criterion, {points} AS score FROM labels" for name, points in _POINTS.items()
) + """), totals AS (
  SELECT question, coalesce(sum(score) FILTER (score BETWEEN 0 AND 2), 0)::BIGINT AS points, 12 AS max_points,
    count(*) FILTER (NOT score BETWEEN 0 AND 2) AS invalid,
    count(DISTINCT criterion) FILTER (score BETWEEN 0 AND 2) = 6 AS complete FROM marks GROUP BY question)"""


def _rubric(spark, sf_dir):
    marks = F.array(*[
        F.struct(F.lit(name).alias("criterion"), F.expr(points).cast("int").alias("score")) for name, points in _POINTS.items()
    ])
    rows = v.table(spark, sf_dir, "labels").select(c("doc_id").alias("question"), F.inline(marks))
    return rag_eval.rubric_scores(rows)


@query(_RUBRIC_SQL + " SELECT * FROM totals")
def rubric_scores(spark, sf_dir):
    return _rubric(spark, sf_dir)


@query(_RUBRIC_SQL + """ SELECT count(*) AS questions, sum(points)::BIGINT AS points, sum(max_points)::BIGINT AS max_points,
  round_even(avg(complete::INT), 6) AS completion FROM totals""")
def rubric_summary(spark, sf_dir):
    return rag_eval.rubric_summary(_rubric(spark, sf_dir)).select("questions", "points", "max_points", r("completion"))


_PROFILED = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(" UNION ALL ".join(
    f"""SELECT '{x}' AS "column", count(*) AS rows, count(*) FILTER ("{x}" IS NULL) AS missing, count(DISTINCT "{x}") AS distinct_values,
  {f'min("{x}")::DOUBLE' if x == "l_linenumber" else 'NULL'} AS min, {f'max("{x}")::DOUBLE' if x == "l_linenumber" else 'NULL'} AS max,
  (SELECT string_agg(v || ':' || n, ',' ORDER BY n DESC, v) FROM (SELECT "{x}"::VARCHAR AS v, count(*) AS n FROM lineitem GROUP BY 1) t) AS frequent FROM lineitem"""
    for x in _PROFILED))
def merged_profile(spark, sf_dir):
    """Line items profiled year by year, and the years' rows merged; these columns' sketches are exact at their few values."""
    path = scratch_path(spark, "profiles")
    lines = v.table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    sketches.add_parts(lines, path, "year", _PROFILED)
    out = sketches.merged(spark, path)
    listed = F.array_join(F.transform("frequent", lambda x: F.concat(x["value"], F.lit(":"), x["n"].cast("string"))), ",")
    return out.select("column", "rows", "missing", c("distinct").alias("distinct_values"), "min", "max", listed.alias("frequent"))
