"""The churn pipeline: read, clean, features, rates, train two classifiers, select, score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import tabular as ft
from larkspur.operators import clean, metrics, models, profile
from larkspur.operators.bounds import quoted
from larkspur.operators.split import hash_split
from larkspur.sources import corpus, delimited

# The column names of the churn file.
REQUIRED = [
    "CustomerID", "Gender", "Senior Citizen", "Partner", "Dependents", "Tenure Months", "Phone Service",
    "Multiple Lines", "Internet Service", "Online Security", "Online Backup", "Device Protection", "Tech Support",
    "Streaming TV", "Streaming Movies", "Contract", "Paperless Billing", "Payment Method", "Monthly Charges",
    "Total Charges", "Churn Label",
]
EXPECTED = [
    "CustomerID", "Count", "Country", "State", "City", "Zip Code", "Lat Long", "Latitude", "Longitude", "Gender",
    "Senior Citizen", "Partner", "Dependents", "Tenure Months", "Phone Service", "Multiple Lines", "Internet Service",
    "Online Security", "Online Backup", "Device Protection", "Tech Support", "Streaming TV", "Streaming Movies",
    "Contract", "Paperless Billing", "Payment Method", "Monthly Charges", "Total Charges", "Churn Label",
    "Churn Value", "Churn Score", "CLTV", "Churn Reason",
]
LEAKAGE = ["CustomerID", "Churn Label", "Churn Value", "Churn Score", "Churn Reason", "CLTV"]
CATEGORICAL = [
    "Gender", "Senior Citizen", "Partner", "Dependents", "Phone Service", "Multiple Lines", "Internet Service",
    "Online Security", "Online Backup", "Device Protection", "Tech Support", "Streaming TV", "Streaming Movies",
    "Contract", "Paperless Billing", "Payment Method", "TenureGroup", "IsNewCustomer",
]
NUMERICAL = ["Tenure Months", "Monthly Charges", "Total Charges", "AvgMonthlySpend", "TotalServices"]
COERCED = ["Tenure Months", "Monthly Charges", "Total Charges", "Churn Value", "Churn Score", "CLTV"]
SERVICES = [
    "Phone Service", "Multiple Lines", "Online Security", "Online Backup", "Device Protection", "Tech Support",
    "Streaming TV", "Streaming Movies",
]
RATE_DIMENSIONS = ["Contract", "Internet Service", "Payment Method", "Senior Citizen", "TenureGroup"]
ID, TARGET = "CustomerID", "Churn"
LOGISTIC, FOREST = "Logistic Regression", "Random Forest"


def load(spark: SparkSession, path: str, null_literal: str | None = None) -> tuple[DataFrame, list[str]]:
    """(rows with ``row_id``, names of columns that are not expected)."""
    rows = delimited.read_dirty(spark, path, null_literal=null_literal)
    clean.require_columns(rows, REQUIRED)
    return rows, [c for c in rows.columns if c not in EXPECTED and c != "row_id"]


def clean_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """Trim, coerce, keep the first row per customer, keep rows with a Yes/No label."""
    rows = clean.coerce_numeric(clean.trim_strings(rows), COERCED)
    return clean.keep_labels(clean.first_by_key(rows, [ID], order), "Churn Label", target=TARGET)


def add_features(rows: DataFrame) -> DataFrame:
    tenure = ft.without_nan(quoted("Tenure Months"))
    return rows.select(
        "*",
        ft.avg_monthly_spend(tenure, quoted("Total Charges"), quoted("Monthly Charges")).alias("AvgMonthlySpend"),
        ft.tenure_group(tenure).alias("TenureGroup"),
        ft.is_new_customer(tenure).alias("IsNewCustomer"),
        ft.count_yes(*[quoted(s) for s in SERVICES]).alias("TotalServices"),
    )


def prepare(records: DataFrame) -> DataFrame:
    """Raw records as the models were trained on: trimmed, coerced, with features."""
    return add_features(clean.coerce_numeric(clean.trim_strings(records), COERCED))


def split(rows: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = hash_split(rows, ID, 0.2, seed, stratify=TARGET)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def train(
    rows: DataFrame, categorical: list[str], numeric: list[str], trees: int = models.TREES, depth: int = models.DEEPEST
):
    """(fitted models, test predictions per model, ranked comparison, selected model name)."""
    training, testing = split(rows)
    count = training.count()
    fitted = models.fit_all(
        training, categorical, numeric,
        {LOGISTIC: models.logistic_classifier(TARGET, count), FOREST: models.forest_classifier(TARGET, trees, depth)},
    )
    predicted = {name: models.predict_classes(model, testing) for name, model in fitted.items()}
    comparison = metrics.rank_classifiers(
        metrics.compare_models(
            [metrics.classification_metrics(p, TARGET, "predicted", "probability", name) for name, p in predicted.items()]
        )
    )
    selected = comparison.where("selected").first()["Model"]
    return fitted, predicted, comparison, selected


def manifest(
    rows: DataFrame, selected: str, categorical: list[str], numeric: list[str], constant: list[str], order: str
) -> DataFrame:
    """Everything a scoring job needs to know, as (section, name, position, value) rows."""
    spark = rows.sparkSession
    facts = [("selected_model", "", 0, selected)]
    for section, names in (("categorical", categorical), ("numerical", numeric), ("constant_removed", constant)):
        facts += [(section, name, i, "") for i, name in enumerate(names)]
    facts += [("threshold", "low_max", 0, str(ft.RISK_LOW_MAX)), ("threshold", "medium_max", 0, str(ft.RISK_MEDIUM_MAX))]
    facts += [("action", band, 0, text) for band, text in ft.RISK_ACTIONS.items()]
    known = spark.createDataFrame(facts, "section string, name string, position bigint, value string")
    options = profile.feature_profile(rows, [*CATEGORICAL, *NUMERICAL], order)
    numbers = F.to_json(F.struct("min", "max", "median"))
    described = options.select(
        F.lit("feature_option").alias("section"), F.col("feature").alias("name"), "position",
        F.when(F.col("type") == "numeric", numbers).otherwise(F.col("value")).alias("value"),
    )
    return known.unionByName(described)


def run(spark: SparkSession, path: str, out: str, trees: int = models.TREES) -> str:
    """The whole pipeline; tables, manifest and the selected model go below ``out``."""
    raw, _ = load(spark, path)
    trimmed = clean.coerce_numeric(clean.trim_strings(raw), COERCED)
    delimited.write_plain(clean.missing_counts(trimmed.drop("row_id"), only_missing=True), f"{out}/missing_values")
    rows = add_features(clean_rows(raw, ["row_id"]))
    rows.write.mode("overwrite").parquet(f"{out}/features")  # read many times below
    rows = spark.read.parquet(f"{out}/features")
    delimited.write_plain(profile.quality_report(rows.drop("row_id")), f"{out}/data_quality")
    rated = profile.rates(rows, RATE_DIMENSIONS, TARGET)
    delimited.write_plain(profile.ranked_rates(rated), f"{out}/rates")
    delimited.write_plain(profile.rate_extremes(rated, "Senior Citizen"), f"{out}/rate_extremes")
    delimited.write_plain(profile.majority_baseline(rows, TARGET), f"{out}/baseline")
    # The tables behind the charts.
    delimited.write_plain(profile.value_counts(rows, ["Churn Label"]), f"{out}/chart_outcomes")
    delimited.write_plain(profile.boxplot(rows, "Churn Label", "Monthly Charges"), f"{out}/chart_charges")
    by_tenure = rated.where(F.col("dimension") == "TenureGroup").withColumn("ordinal", ft.tenure_ordinal(F.col("level")))
    delimited.write_plain(by_tenure.orderBy("ordinal"), f"{out}/chart_tenure")
    categorical, numeric, constant = profile.select_features(rows, CATEGORICAL, NUMERICAL, LEAKAGE)
    fitted, predicted, comparison, selected = train(rows, categorical, numeric, trees)
    delimited.write_plain(comparison.drop("model_order"), f"{out}/model_comparison")
    tested = models.classification_table(predicted[selected], TARGET, [*categorical, *numeric])
    delimited.write_plain(tested, f"{out}/test_predictions")
    delimited.write_plain(metrics.confusion_matrix(predicted[selected], TARGET, "predicted"), f"{out}/confusion_matrix")
    delimited.write_plain(models.importances(fitted[FOREST], spark), f"{out}/feature_importance")
    corpus.write_json_rows(manifest(rows, selected, categorical, numeric, constant, "row_id"), f"{out}/manifest")
    models.save_model(fitted[selected], f"{out}/model")
    return selected
