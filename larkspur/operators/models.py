"""Training, prediction, importance and scoring with MLlib."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import tabular as ft
from larkspur.operators import forests
from larkspur.operators.bounds import attach, checked_small, local_copy, quoted
from larkspur.operators.clean import project_to
from larkspur.operators.prep import FillerModel, feature_names, preprocessor
from larkspur.operators.ranks import running_totals

# The training settings of the source scripts.
TREES = 300
MIN_LEAF = 2
SEED = 42
MAX_ITERATIONS = 2000
DEEPEST = 30  # MLlib's limit; the source grows trees without one


def linear_regressor(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=0.0, maxIter=1000, tol=1e-12, predictionCol="prediction")


def forest_regressor(label: str, trees: int = TREES, depth: int = DEEPEST, bootstrap: bool = True) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, minInstancesPerNode=MIN_LEAF, featureSubsetStrategy="all", bootstrap=bootstrap,
        maxDepth=depth, seed=SEED, maxMemoryInMB=1024, cacheNodeIds=True,
    )


def logistic_classifier(label: str, train_rows: int, strength: float = 1.0) -> LogisticRegression:
    """L2 with unit inverse strength, which MLlib counts per training row; ``strength`` 0 is without."""
    return LogisticRegression(
        labelCol=label, regParam=strength / max(train_rows, 1), elasticNetParam=0.0,
        standardization=False, maxIter=MAX_ITERATIONS, tol=1e-6 if strength else 1e-12,
    )


def forest_classifier(label: str, trees: int = TREES, depth: int = DEEPEST) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, numTrees=trees, minInstancesPerNode=MIN_LEAF, featureSubsetStrategy="sqrt",
        impurity="gini", maxDepth=depth, seed=SEED, maxMemoryInMB=1024, cacheNodeIds=True,
    )


def fit_all(
    train: DataFrame, categorical: list[str], numeric: list[str], estimators: dict[str, object]
) -> dict[str, PipelineModel]:
    """Fit the preprocessing once on the training rows and every estimator on its result.

    The preprocessing reads the rows several times and the estimators read the vectors
    many times, so both are kept (in memory, else on disk) while they are needed.
    """
    label = next(iter(estimators.values())).getLabelCol()
    rows = train.select(*[quoted(c) for c in dict.fromkeys([*categorical, *numeric, label])]).persist()
    prepared = preprocessor(categorical, numeric).fit(rows)
    encoded = prepared.transform(rows).select("features", quoted(label).cast("double").alias(label)).persist()
    count = encoded.count()
    rows.unpersist()
    try:
        return {
            name: PipelineModel(stages=[*prepared.stages, _fitted(encoded, count, estimator, bool(numeric))])
            for name, estimator in estimators.items()
        }
    finally:
        encoded.unpersist()


def _fitted(encoded: DataFrame, count: int, estimator, numeric: bool):
    """The model of an estimator; a large regression forest without numeric features grows from sums."""
    summed = isinstance(estimator, RandomForestRegressor) and not numeric and count >= forests.SUMMED_ROWS
    return (forests.fit_summed(encoded, estimator) if summed else None) or estimator.fit(encoded)


def fit(train: DataFrame, categorical: list[str], numeric: list[str], estimator) -> PipelineModel:
    """Preprocessing and one estimator as a single saved-and-loaded model."""
    return fit_all(train, categorical, numeric, {"model": estimator})["model"]


def positive_probability(probability: str = "probability"):
    return vector_to_array(F.col(probability))[1]


def predict_classes(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Input columns with ``predicted`` (0/1) and ``probability`` of the positive class."""
    out = model.transform(rows)
    kept = [quoted(c) for c in rows.columns]
    return out.select(
        *kept, F.col("prediction").cast("int").alias("predicted"), positive_probability().alias("probability")
    )


def _distinct_inputs(model: PipelineModel, rows: DataFrame) -> DataFrame | None:
    """The distinct inputs of a forest of texts alone as a local table, None if they are many or the model is another."""
    filler, forest = model.stages[0], model.stages[-1]
    if rows.isStreaming or not isinstance(forest, RandomForestRegressionModel) or not isinstance(filler, FillerModel) or filler.getOrDefault("numeric"):
        return None
    return local_copy(rows.select(*[quoted(c) for c in filler.getOrDefault("categorical")]).distinct(), forests.MAX_CELLS)


def predict_values(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Input columns, imputed, with ``predicted``; hundreds of trees are asked once for rows with equal inputs."""
    inputs = _distinct_inputs(model, rows)
    if inputs is None:
        out = model.transform(rows)
    else:
        keys = {name: f"_asked_{i}" for i, name in enumerate(inputs.columns)}
        known = model.transform(inputs.select("*", *[quoted(c).alias(k) for c, k in keys.items()]))
        known = known.select(*[quoted(c) for c in inputs.columns], *keys.values(), "prediction")
        asked = rows.select(*[quoted(c).alias(keys.get(c, c)) for c in rows.columns])
        out = attach(asked, F.broadcast(known), [*keys.values()])
    return out.select(*[quoted(c) for c in rows.columns], F.col("prediction").alias("predicted"))


def regression_table(predicted: DataFrame, actual: str, keep: list[str] = ()) -> DataFrame:
    """Actual, predicted and absolute error of held-out rows."""
    return predicted.select(
        *[quoted(c) for c in keep],
        quoted(actual).alias("actual"), "predicted", F.abs(quoted(actual) - F.col("predicted")).alias("absolute_error"),
    )


def classification_table(predicted: DataFrame, actual: str, features: list[str]) -> DataFrame:
    """Features with actual and predicted class, probability and risk band."""
    return predicted.select(
        *[quoted(c) for c in features],
        quoted(actual).alias("Actual_Churn"),
        F.col("predicted").alias("Predicted_Churn"),
        F.col("probability").alias("Churn_Probability"),
        ft.risk_band(F.col("probability")).alias("Risk_Category"),
    )


def importances(model: PipelineModel, spark) -> DataFrame:
    """(position, feature, importance) of a fitted forest, largest first.

    The input is one number per model feature, which the fitted model already holds.
    """
    values = model.stages[-1].featureImportances.toArray()
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    rows = list(zip(feature_names(model), [float(v) for v in values]))
    frame = spark.createDataFrame(rows, schema)
    return running_totals(frame, [], [F.desc("importance"), F.col("feature")], {"position": F.lit(1)}).select(
        "position", "feature", "importance"
    )


def top_importances(ranked: DataFrame, limit: int = 15) -> DataFrame:
    """The most important features in rising order, as shown in a bar chart."""
    return ranked.orderBy("position").limit(limit).orderBy("importance", F.desc("position"))


def action_table(spark, actions: dict[str, str] = ft.RISK_ACTIONS) -> DataFrame:
    return spark.createDataFrame(list(actions.items()), "risk_band string, action string")


def with_actions(df: DataFrame, actions: DataFrame, band: str = "risk_band", default: str = ft.DEFAULT_ACTION) -> DataFrame:
    """Look up the action of each band; unknown or missing bands get the default text."""
    table = checked_small(actions.withColumnRenamed("risk_band", band))
    return attach(df, table, [band]).withColumn("action", F.coalesce("action", F.lit(default)))


def score(
    model: PipelineModel, records: DataFrame, id_column: str, categorical: list[str], numeric: list[str],
    actions: DataFrame | None = None,
) -> DataFrame:
    """Score records whose features are built: class, status, probability, band, action.

    Records are projected to the trained columns; absent ones are imputed by the model.
    """
    schema = T.StructType(
        [records.schema[id_column]]
        + [T.StructField(c, T.StringType()) for c in categorical]
        + [T.StructField(c, T.DoubleType()) for c in numeric]
    )
    scored = predict_classes(model, project_to(records, schema)).select(
        quoted(id_column), "predicted", "probability",
        ft.predicted_status(F.col("predicted")).alias("status"),
        ft.risk_band(F.col("probability")).alias("risk_band"),
    )
    return with_actions(scored, actions) if actions is not None else scored


def score_values(model: PipelineModel, records: DataFrame, id_column: str, features: list[str]) -> DataFrame:
    """Predict a value, and its performance category, for records that need not have all features."""
    schema = T.StructType([records.schema[id_column]] + [T.StructField(c, T.StringType()) for c in features])
    out = predict_values(model, project_to(records, schema)).select(quoted(id_column), "predicted")
    return out.withColumn("performance_category", ft.performance_category(F.col("predicted")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
