"""Splits, preprocessing, metrics and models as queries over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.functions import tabular as ft
from larkspur.operators import metrics, models, prep, profile
from larkspur.operators.bounds import quoted
from larkspur.operators.split import hash_split
from larkspur.plans import churn, exams
from larkspur.plans import views as v
from larkspur.plans.registry import query, r
from larkspur.plans.tabular_queries import clean_scores, featured
from larkspur.session import scratch_path, stored

c = F.col

# ---- splits ---------------------------------------------------------------------------


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) <= ceil(0.2 * count(*) OVER ()) AS is_test
FROM orders""")
def train_test_split(spark, sf_dir):
    return hash_split(v.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


_STRATIFIED_SQL = f"""WITH {v.LABELLED_SQL}, shares AS (
  SELECT "Churn" AS k, count(*) AS n, count(*) * ceil(0.2 * (SELECT count(*) FROM featured)) / (SELECT count(*) FROM featured) AS share
  FROM featured GROUP BY 1),
quotas AS (SELECT k, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, n DESC, k)
    <= ceil(0.2 * (SELECT count(*) FROM featured)) - (SELECT sum(floor(share)) FROM shares) THEN 1 ELSE 0 END AS quota FROM shares),
divided AS (SELECT f.*, row_number() OVER (PARTITION BY "Churn" ORDER BY md5('42:' || "CustomerID")) <= quota AS is_test
  FROM featured f JOIN quotas ON k = "Churn")"""


@query(f"""{_STRATIFIED_SQL} SELECT "CustomerID", "Churn", is_test FROM divided""")
def stratified_split(spark, sf_dir):
    rows = featured(spark, sf_dir).select("CustomerID", "Churn")
    return hash_split(rows, "CustomerID", stratify="Churn")


# ---- preprocessing, fitted on the training rows only ------------------------------------

_TRAIN_SQL = f"{_STRATIFIED_SQL}, train AS (SELECT * FROM divided WHERE NOT is_test)"


@query(f"""{_TRAIN_SQL} SELECT "CustomerID", coalesce("Payment Method", (SELECT "Payment Method" FROM train
    WHERE "Payment Method" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS payment,
  coalesce("Streaming Movies", (SELECT "Streaming Movies" FROM train
    WHERE "Streaming Movies" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS movies FROM featured""")
def impute_mode(spark, sf_dir):
    rows = featured(spark, sf_dir).select("CustomerID", "Churn", "Payment Method", "Streaming Movies")
    training, _ = churn.split(rows)
    filled = prep.Filler(categorical=["Payment Method", "Streaming Movies"]).fit(training).transform(rows)
    return filled.select("CustomerID", quoted("Payment Method").alias("payment"), quoted("Streaming Movies").alias("movies"))


@query(f"""{_TRAIN_SQL} SELECT "CustomerID", coalesce("Tenure Months", (SELECT median("Tenure Months") FROM train)) AS months,
  round_even(coalesce("Total Charges", (SELECT median("Total Charges") FROM train)), 4) AS total FROM featured""")
def impute_median(spark, sf_dir):
    rows = featured(spark, sf_dir).select("CustomerID", "Churn", "Tenure Months", "Total Charges")
    training, _ = churn.split(rows)
    filled = prep.Filler(numeric=["Tenure Months", "Total Charges"]).fit(training).transform(rows)
    return filled.select("CustomerID", quoted("Tenure Months").alias("months"), r(quoted("Total Charges"), 4).alias("total"))


@query(f"""{_TRAIN_SQL}, levels AS (SELECT list(DISTINCT "Payment Method" ORDER BY "Payment Method") AS names FROM train
    WHERE "Payment Method" IS NOT NULL),
filled AS (SELECT "CustomerID", coalesce("Payment Method", (SELECT "Payment Method" FROM train
    WHERE "Payment Method" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS payment FROM featured)
SELECT "CustomerID", payment, array_to_string([CASE WHEN x = payment THEN 1 ELSE 0 END FOR x IN names], ',') AS slots
FROM filled, levels""")
def one_hot(spark, sf_dir):
    rows = featured(spark, sf_dir).select("CustomerID", "Churn", "Payment Method")
    training, _ = churn.split(rows)
    encoded = prep.preprocessor(["Payment Method"], []).fit(training).transform(rows)
    slots = F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string"))
    return encoded.select("CustomerID", quoted("Payment Method").alias("payment"), F.array_join(slots, ",").alias("slots"))


@query(f"{_TRAIN_SQL} " + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", round_even(coalesce(nullif(stddev_pop("{x}"), 0), 1), 4) AS scale FROM train""" for x in churn.NUMERICAL))
def scale_pop(spark, sf_dir):
    training, _ = churn.split(featured(spark, sf_dir).select("CustomerID", "Churn", *[quoted(x) for x in churn.NUMERICAL]))
    return prep.population_scales(training, churn.NUMERICAL).select("column", r("scale", 4))


_NAMED = ["Gender", "Contract", "Payment Method", "TenureGroup"]


@query(f"{_TRAIN_SQL}, named AS (" + " UNION ALL ".join(
    f"""SELECT DISTINCT {i} AS place, "{x}" AS level, 'categorical__{x}_' || "{x}" AS feature FROM train WHERE "{x}" IS NOT NULL"""
    for i, x in enumerate(_NAMED)) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT {100 + i}, '', 'numerical__{x}'" for i, x in enumerate(churn.NUMERICAL))
    + ") SELECT row_number() OVER (ORDER BY place, level) - 1 AS slot, feature FROM named")
def feature_names(spark, sf_dir):
    rows = featured(spark, sf_dir).select("CustomerID", "Churn", *[quoted(x) for x in [*_NAMED, *churn.NUMERICAL]])
    training, _ = churn.split(rows)
    names = prep.feature_names(prep.preprocessor(_NAMED, churn.NUMERICAL).fit(training))
    return spark.createDataFrame(list(enumerate(names)), "slot bigint, feature string")


# ---- metrics ----------------------------------------------------------------------------

_METRICS = [("linear", "estimate"), ("shrunk", "other_estimate")]


def _regression_sql(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS "Model", avg(abs(amount - {column})) AS "MAE", sqrt(avg((amount - {column}) ** 2)) AS "RMSE",
  1 - avg((amount - {column}) ** 2) / var_pop(amount) AS "R2" FROM predictions"""


@query(f"""WITH {v.PREDICTIONS_SQL} SELECT "Model", round_even("MAE", 4) AS "MAE", round_even("RMSE", 4) AS "RMSE",
  round_even("R2", 6) AS "R2" FROM ({_regression_sql(*_METRICS[0])})""")
def regression_metrics(spark, sf_dir):
    out = metrics.regression_metrics(v.predictions(spark, sf_dir), "amount", "estimate", "linear")
    return out.select("Model", r("MAE", 4), r("RMSE", 4), r("R2"))


@query(f"""WITH {v.PREDICTIONS_SQL}, stacked AS ({" UNION ALL ".join(_regression_sql(*m) for m in _METRICS)})
SELECT arg_min("Model", "RMSE") AS selected, round_even(min("RMSE"), 4) AS "RMSE" FROM stacked""")
def model_selection(spark, sf_dir):
    rows = v.predictions(spark, sf_dir)
    stacked = metrics.compare_models([metrics.regression_metrics(rows, "amount", p, n) for n, p in _METRICS])
    return metrics.select_regressor(stacked).select("selected", r("RMSE", 4))


def _class_sql(name: str, probability: str, cut: float) -> str:
    return f"""SELECT '{name}' AS "Model", avg((actual = ({probability} >= {cut})::INT)::INT) AS "Accuracy",
  coalesce(count(*) FILTER (actual = 1 AND {probability} >= {cut}) / nullif(count(*) FILTER ({probability} >= {cut}), 0)::DOUBLE, 0) AS "Precision",
  coalesce(count(*) FILTER (actual = 1 AND {probability} >= {cut}) / nullif(count(*) FILTER (actual = 1), 0)::DOUBLE, 0) AS "Recall",
  coalesce(2 * count(*) FILTER (actual = 1 AND {probability} >= {cut}) /
    nullif(count(*) FILTER (actual = 1) + count(*) FILTER ({probability} >= {cut}), 0)::DOUBLE, 0) AS "F1",
  (SELECT (sum(place) FILTER (actual = 1) - count(*) FILTER (actual = 1) * (count(*) FILTER (actual = 1) + 1) / 2.0)
     / (count(*) FILTER (actual = 1) * count(*) FILTER (actual = 0))
   FROM (SELECT actual, rank() OVER (ORDER BY {probability}) + (count(*) OVER (PARTITION BY {probability}) - 1) / 2.0 AS place
         FROM predictions)) AS "ROC_AUC" FROM predictions"""


_CLASSIFIERS = [("first", "probability", 0.5), ("second", "other_probability", 0.4), ("never", "other_probability", 2.0)]
_CLASS_COLUMNS = ["Accuracy", "Precision", "Recall", "F1", "ROC_AUC"]
_ROUNDED = ", ".join(f'round_even("{x}", 6) AS "{x}"' for x in _CLASS_COLUMNS)


def _classified(rows, name, probability, cut):
    marked = rows.withColumn("predicted", (c(probability) >= cut).cast("int"))
    return metrics.classification_metrics(marked, "actual", "predicted", probability, name)


@query(f"""WITH {v.PREDICTIONS_SQL} SELECT "Model", {_ROUNDED} FROM ({_class_sql(*_CLASSIFIERS[0])})""")
def classification_metrics(spark, sf_dir):
    out = _classified(v.predictions(spark, sf_dir), *_CLASSIFIERS[0])
    return out.select("Model", *[r(x) for x in _CLASS_COLUMNS])


@query(f"""WITH {v.PREDICTIONS_SQL}, stacked AS ({" UNION ALL ".join(_class_sql(*m) for m in _CLASSIFIERS)})
SELECT "Model", {_ROUNDED}, row_number() OVER (ORDER BY "F1" DESC, "Recall" DESC) AS place,
  row_number() OVER (ORDER BY "F1" DESC, "Recall" DESC) = 1 AS selected FROM stacked""")
def model_comparison(spark, sf_dir):
    rows = v.predictions(spark, sf_dir)
    ranked = metrics.rank_classifiers(metrics.compare_models([_classified(rows, *m) for m in _CLASSIFIERS]))
    return ranked.select("Model", *[r(x) for x in _CLASS_COLUMNS], "place", "selected")


@query(f"""WITH {v.PREDICTIONS_SQL} SELECT round_even("ROC_AUC", 6) AS "ROC_AUC" FROM ({_class_sql(*_CLASSIFIERS[0])})""")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(v.predictions(spark, sf_dir), "actual", "probability").select(r("ROC_AUC"))


@query(f"""WITH {v.PREDICTIONS_SQL} SELECT count(*) FILTER (actual = 0 AND probability < 0.5) AS tn,
  count(*) FILTER (actual = 0 AND probability >= 0.5) AS fp, count(*) FILTER (actual = 1 AND probability < 0.5) AS fn,
  count(*) FILTER (actual = 1 AND probability >= 0.5) AS tp FROM predictions""")
def confusion_matrix(spark, sf_dir):
    marked = v.predictions(spark, sf_dir).withColumn("predicted", (c("probability") >= 0.5).cast("int"))
    return metrics.confusion_matrix(marked, "actual", "predicted")


# ---- models -------------------------------------------------------------------------------

def _churn_sets(spark, sf_dir):
    """(training rows, test rows, categorical features, numeric features) of the pipeline."""
    rows = stored(featured(spark, sf_dir), "features")  # read by the selection, the split, the fit and the test
    categorical, numeric, _ = profile.select_features(rows, churn.CATEGORICAL, churn.NUMERICAL, churn.LEAKAGE)
    return *churn.split(rows), categorical, numeric


def _logistic(training, categorical, numeric):
    return models.fit(training, categorical, numeric, models.logistic_classifier("Churn", training.count()))


@query(f"""WITH {v.CLEAN_SCORES_SQL}, divided AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || row_key)) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM clean_scores),
fitted AS (SELECT "test preparation course", avg(overall_score) AS predicted FROM divided WHERE NOT is_test GROUP BY 1)
SELECT row_key, round_even(overall_score, 4) AS actual, round_even(predicted, 4) AS predicted
FROM divided JOIN fitted USING ("test preparation course") WHERE is_test""")
def linear_regression(spark, sf_dir):
    rows = clean_scores(spark, sf_dir).select("row_key", "test preparation course", "overall_score")
    training, testing = exams.split(rows, "row_key")
    model = models.fit(training, ["test preparation course"], [], models.linear_regressor("overall_score"))
    out = models.predict_values(model, testing)
    return out.select("row_key", r(c("overall_score"), 4).alias("actual"), r("predicted", 4))


@query()
def regression_predictions(spark, sf_dir):
    rows = clean_scores(spark, sf_dir)
    training, testing = exams.split(rows, "row_key")
    model = models.fit(training, exams.FEATURES, [], models.linear_regressor(exams.TARGET))
    return models.regression_table(models.predict_values(model, testing), exams.TARGET, ["row_key"])


@query()
def rf_regressor(spark, sf_dir):
    training, testing = exams.split(clean_scores(spark, sf_dir), "row_key")
    model = models.fit(training, exams.FEATURES, [], models.forest_regressor(exams.TARGET))
    return metrics.regression_metrics(models.predict_values(model, testing), exams.TARGET, "predicted", exams.FOREST)


@query()
def logistic_regression(spark, sf_dir):
    training, testing, categorical, numeric = _churn_sets(spark, sf_dir)
    tested = models.predict_classes(_logistic(training, categorical, numeric), testing)
    return models.classification_table(tested, "Churn", ["CustomerID", *categorical, *numeric])


@query()
def rf_classifier(spark, sf_dir):
    training, testing, categorical, numeric = _churn_sets(spark, sf_dir)
    model = models.fit(training, categorical, numeric, models.forest_classifier("Churn"))
    tested = models.predict_classes(model, testing)
    return metrics.classification_metrics(tested, "Churn", "predicted", "probability", churn.FOREST)


def _importances(spark, sf_dir):
    training, _ = exams.split(clean_scores(spark, sf_dir), "row_key")
    estimator = models.forest_regressor(exams.TARGET)
    return models.importances(models.fit(training, exams.FEATURES, [], estimator), spark)


@query()
def feature_importance(spark, sf_dir):
    return _importances(spark, sf_dir)


@query()
def feature_importance_top(spark, sf_dir):
    return models.top_importances(_importances(spark, sf_dir))


@query()
def batch_score(spark, sf_dir):
    training, _, categorical, numeric = _churn_sets(spark, sf_dir)
    incoming = churn.prepare(v.accounts(spark, sf_dir).drop("Churn Label")).drop("Gender")  # a column is absent
    return models.score(
        _logistic(training, categorical, numeric), incoming, "CustomerID", categorical, numeric, models.action_table(spark)
    )


@query(f"""WITH {v.LABELLED_SQL} SELECT "CustomerID", true AS same_probability FROM labelled""")
def model_roundtrip(spark, sf_dir):
    """A saved and loaded model gives every account the probability it had before."""
    rows = featured(spark, sf_dir)
    training, _, categorical, numeric = _churn_sets(spark, sf_dir)
    model = _logistic(training, categorical, numeric)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    again = models.load_model(path)
    before = models.predict_classes(model, rows).select("CustomerID", c("probability").alias("before"))
    after = models.predict_classes(again, rows).select("CustomerID", c("probability").alias("after"))
    return before.join(after, "CustomerID").select("CustomerID", (c("before") == c("after")).alias("same_probability"))


def _list_sql(section: str, names: list[str]) -> str:
    """The features of a list that vary (or do not) as manifest rows, in the order of the list."""
    kept = "<= 1" if section == "constant_removed" else "> 1"
    parts = [f"""SELECT '{x}' AS name, {i} AS place, count(DISTINCT "{x}") + (count("{x}") < count(*))::INT AS kinds FROM featured"""
             for i, x in enumerate(names)]
    return f"""SELECT '{section}' AS section, name, row_number() OVER (ORDER BY place) - 1 AS position, '' AS value
  FROM ({" UNION ALL ".join(parts)}) WHERE kinds {kept}"""


_OPTIONS_SQL = " UNION ALL ".join(
    f"""SELECT 'feature_option' AS section, '{x}' AS name, row_number() OVER (ORDER BY min("CustomerID"), "{x}") AS position, "{x}" AS value
  FROM featured WHERE "{x}" IS NOT NULL GROUP BY "{x}" """ for x in churn.CATEGORICAL
)
_FACTS = [("selected_model", "", churn.LOGISTIC), ("threshold", "low_max", str(ft.RISK_LOW_MAX)), ("threshold", "medium_max", str(ft.RISK_MEDIUM_MAX))]
_FACTS += [("action", band, text) for band, text in ft.RISK_ACTIONS.items()]
_FACTS_SQL = " UNION ALL ".join(f"SELECT '{a}', '{b}', 0, '{text}'" for a, b, text in _FACTS)


@query(f"""WITH {v.LABELLED_SQL} {_list_sql("categorical", churn.CATEGORICAL)} UNION ALL {_list_sql("numerical", churn.NUMERICAL)}
UNION ALL {_list_sql("constant_removed", [*churn.CATEGORICAL, *churn.NUMERICAL])} UNION ALL {_OPTIONS_SQL} UNION ALL {_FACTS_SQL}""")
def model_manifest(spark, sf_dir):
    """What a scoring job needs to know, but for the ranges of numeric features (see ``feature_profile``)."""
    rows = stored(featured(spark, sf_dir), "features")
    categorical, numeric, constant = profile.select_features(rows, churn.CATEGORICAL, churn.NUMERICAL, churn.LEAKAGE)
    facts = churn.manifest(rows, churn.LOGISTIC, categorical, numeric, constant, "CustomerID")
    return facts.where(~((c("section") == "feature_option") & c("name").isin(churn.NUMERICAL)))


# ---- models that SQL can compute: one feature, whose groups a model without a penalty tells apart --

_GROUP = "test preparation course"
_EXAM_GROUPS_SQL = f"""WITH {v.CLEAN_SCORES_SQL}, divided AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || row_key)) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM clean_scores),
fitted AS (SELECT "{_GROUP}", avg(overall_score) AS predicted FROM divided WHERE NOT is_test GROUP BY 1)"""
_TESTED_SQL = f"""{_EXAM_GROUPS_SQL} SELECT row_key, round_even(overall_score, 4) AS actual, round_even(predicted, 4) AS predicted,
  round_even(abs(overall_score - predicted), 4) AS absolute_error FROM divided JOIN fitted USING ("{_GROUP}") WHERE is_test"""


def _exam_groups(spark, sf_dir, estimator):
    rows = clean_scores(spark, sf_dir).select("row_key", _GROUP, exams.TARGET)
    training, testing = exams.split(rows, "row_key")
    return models.fit(training, [_GROUP], [], estimator), testing


def _tested(model, testing):
    out = models.regression_table(models.predict_values(model, testing), exams.TARGET, ["row_key"])
    return out.select("row_key", r("actual", 4), r("predicted", 4), r("absolute_error", 4))


@query(_TESTED_SQL)
def group_regression_table(spark, sf_dir):
    return _tested(*_exam_groups(spark, sf_dir, models.linear_regressor(exams.TARGET)))


@query(_TESTED_SQL)
def group_tree_table(spark, sf_dir):
    """One whole tree on one feature predicts the mean of each of its levels."""
    return _tested(*_exam_groups(spark, sf_dir, models.forest_regressor(exams.TARGET, 1, 5, bootstrap=False)))


@query(f"""{_EXAM_GROUPS_SQL}, scored AS (
  SELECT row_key, coalesce(f.predicted, m.predicted) AS predicted FROM clean_scores LEFT JOIN fitted f USING ("{_GROUP}"), (
    SELECT predicted FROM fitted JOIN (SELECT "{_GROUP}", count(*) AS n FROM divided WHERE NOT is_test GROUP BY 1) USING ("{_GROUP}")
    ORDER BY n DESC, "{_GROUP}" LIMIT 1) m)
SELECT row_key, round_even(predicted, 4) AS predicted, CASE WHEN predicted >= 70 THEN 'High' WHEN predicted >= 50 THEN 'Medium'
  ELSE 'Low' END AS performance_category FROM scored""")
def exam_batch_score(spark, sf_dir):
    """Records without most of the columns, scored by a saved and loaded exam model."""
    model, _ = _exam_groups(spark, sf_dir, models.linear_regressor(exams.TARGET))
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    records = clean_scores(spark, sf_dir).select("row_key", _GROUP)
    out = models.score_values(models.load_model(path), records, "row_key", [_GROUP])
    return out.select("row_key", r("predicted", 4), "performance_category")


GROUP_LEVEL = "Contract"
_CHURN_GROUPS_SQL = f"""{_STRATIFIED_SQL}, fitted AS (SELECT "{GROUP_LEVEL}", avg("Churn") AS probability FROM divided WHERE NOT is_test GROUP BY 1)"""
GROUP_SCORES_SQL = f"""{_CHURN_GROUPS_SQL}
SELECT "CustomerID", (probability > 0.5)::INT AS predicted, round_even(probability, 4) AS probability,
  CASE WHEN probability > 0.5 THEN 'Likely to Churn' ELSE 'Likely to Stay' END AS status, risk_band, action
FROM (SELECT *, CASE WHEN probability < {ft.RISK_LOW_MAX} THEN 'Low' WHEN probability < {ft.RISK_MEDIUM_MAX} THEN 'Medium' ELSE 'High' END AS risk_band
  FROM accounts JOIN fitted USING ("{GROUP_LEVEL}"))
JOIN (VALUES {", ".join(f"('{band}', '{text}')" for band, text in ft.RISK_ACTIONS.items())}) t(risk_band, action) USING (risk_band)"""


def group_model(spark, sf_dir):
    """Logistic regression without a penalty on one feature: the rate of each of its levels."""
    training, _ = churn.split(featured(spark, sf_dir).select("CustomerID", GROUP_LEVEL, "Churn"))
    return models.fit(training, [GROUP_LEVEL], [], models.logistic_classifier("Churn", 1, strength=0.0))


@query(GROUP_SCORES_SQL)
def group_batch_score(spark, sf_dir):
    """Status, band and action of raw accounts, scored by a model that SQL can compute."""
    incoming = churn.prepare(v.accounts(spark, sf_dir).drop("Churn Label")).drop("Gender")
    out = models.score(group_model(spark, sf_dir), incoming, "CustomerID", [GROUP_LEVEL], [], models.action_table(spark))
    return out.withColumn("probability", r("probability", 4))


@query(f"""{_CHURN_GROUPS_SQL} SELECT "CustomerID", "{GROUP_LEVEL}", "Churn" AS "Actual_Churn", (probability > 0.5)::INT AS "Predicted_Churn",
  round_even(probability, 4) AS "Churn_Probability", CASE WHEN probability < {ft.RISK_LOW_MAX} THEN 'Low'
  WHEN probability < {ft.RISK_MEDIUM_MAX} THEN 'Medium' ELSE 'High' END AS "Risk_Category"
FROM divided JOIN fitted USING ("{GROUP_LEVEL}") WHERE is_test""")
def group_logistic_table(spark, sf_dir):
    """Held-out accounts with the class, probability and band of ``group_model``."""
    _, testing = churn.split(featured(spark, sf_dir).select("CustomerID", GROUP_LEVEL, "Churn"))
    tested = models.predict_classes(group_model(spark, sf_dir), testing)
    out = models.classification_table(tested, "Churn", ["CustomerID", GROUP_LEVEL])
    return out.withColumn("Churn_Probability", r("Churn_Probability", 4))
