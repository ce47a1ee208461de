"""The exam-score pipeline: clean, profile, train two regressors, compare, score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import tabular as ft
from larkspur.operators import clean, metrics, models, profile
from larkspur.operators.bounds import quoted
from larkspur.operators.split import hash_split
from larkspur.sources.delimited import write_plain

# The column names of the exam file.
FEATURES = ["gender", "race/ethnicity", "parental level of education", "lunch", "test preparation course"]
SCORES = ["math score", "reading score", "writing score"]
TARGET = "overall_score"
LINEAR, FOREST = "Linear Regression", "Random Forest"


def load(spark: SparkSession, path: str) -> DataFrame:
    """The rows of comma-separated files, all as text, with a ``row_id`` in the order of the files."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    clean.require_columns(raw, [*FEATURES, *SCORES])
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return raw.select("*", F.to_json(place).alias("row_id"))


def clean_scores(raw: DataFrame, dedupe: bool = True, id_column: str | None = None) -> DataFrame:
    """Coerce, remove equal rows, drop invalid scores and rows without any; add mean and band.

    Rows are equal if everything but ``id_column`` is; the first id stays.
    """
    clean.require_columns(raw, [*FEATURES, *SCORES])
    rows = clean.coerce_numeric(raw, SCORES)
    if dedupe and id_column:
        rows = clean.first_by_key(rows, [c for c in rows.columns if c != id_column], [id_column])
    elif dedupe:
        rows = clean.drop_duplicate_rows(rows)
    rows = clean.drop_all_missing(clean.guard_range(rows, SCORES), SCORES)
    rows = rows.withColumn(TARGET, ft.row_mean(*[quoted(s) for s in SCORES]))
    return rows.withColumn("performance_category", ft.performance_category(F.col(TARGET)))


def split(rows: DataFrame, id_column: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = hash_split(rows, id_column, 0.2, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def train(rows: DataFrame, id_column: str, trees: int = models.TREES, depth: int = models.DEEPEST):
    """(fitted models, predictions per model, comparison, selected model name)."""
    training, testing = split(rows, id_column)
    fitted = models.fit_all(
        training, FEATURES, [],
        {LINEAR: models.linear_regressor(TARGET), FOREST: models.forest_regressor(TARGET, trees, depth)},
    )
    predicted = {name: models.predict_values(model, testing) for name, model in fitted.items()}
    comparison = metrics.compare_models(
        [metrics.regression_metrics(p, TARGET, "predicted", name) for name, p in predicted.items()]
    )
    selected = metrics.select_regressor(comparison).first()["selected"]
    return fitted, predicted, comparison, selected


def run(raw: DataFrame, id_column: str, out: str, trees: int = models.TREES) -> str:
    """The whole pipeline; tables and the selected model go below ``out``. Returns its name."""
    rows = clean_scores(raw, id_column=id_column)
    write_plain(rows, f"{out}/cleaned")
    write_plain(profile.describe(rows, [*SCORES, TARGET]), f"{out}/describe")
    write_plain(profile.value_counts(rows, FEATURES), f"{out}/value_counts")
    for feature in FEATURES:
        write_plain(profile.group_stats(rows, feature, TARGET), f"{out}/by_{feature.replace('/', '_').replace(' ', '_')}")
    fitted, predicted, comparison, selected = train(rows, id_column, trees)
    write_plain(comparison.drop("model_order"), f"{out}/model_comparison")
    write_plain(models.regression_table(predicted[selected], TARGET, [id_column]), f"{out}/test_predictions")
    write_plain(models.importances(fitted[FOREST], rows.sparkSession), f"{out}/feature_importance")
    models.save_model(fitted[selected], f"{out}/model")
    return selected


def score(records: DataFrame, path: str, id_column: str) -> DataFrame:
    """Score new records with the model that ``run`` saved: predicted value and performance category."""
    return models.score_values(models.load_model(path), records, id_column, FEATURES)
