"""Fitted preprocessing: imputation, one-hot encoding, scaling and feature names.

The two custom stages keep their fitted state in a JSON parameter, so they are saved and
loaded together with the ``PipelineModel`` they are part of.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.bounds import quoted
from larkspur.operators.clean import replace_columns
from larkspur.operators.summaries import summarize, tall


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mode): the most frequent value of each column, the smallest on ties."""
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    counts = tall(texts, [], columns).where("x is not null").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("mode"))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, median): interpolated medians."""
    return summarize(df, [], columns, [], {"median": 0.5})


def population_scales(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, scale): population standard deviation, 1 where it is zero."""
    spread = tall(df, [], columns).groupBy("column").agg(F.stddev_pop("x").alias("s"))
    return spread.select("column", F.coalesce(F.nullif("s", F.lit(0.0)), F.lit(1.0)).alias("scale"))


class _Columns(Params):
    categorical = Param(Params._dummy(), "categorical", "text columns", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "number columns", TypeConverters.toListString)
    fitted = Param(Params._dummy(), "fitted", "fitted values as JSON", TypeConverters.toString)


class Filler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the mode of text columns and the median of number columns."""

    @keyword_only
    def __init__(self, *, categorical=None, numeric=None):
        super().__init__()
        self._set(categorical=categorical or [], numeric=numeric or [])

    def _fit(self, dataset: DataFrame) -> "FillerModel":
        texts, numbers = self.getOrDefault("categorical"), self.getOrDefault("numeric")
        values = {r["column"]: r["mode"] for r in modes(dataset, texts).collect()} if texts else {}
        if numbers:
            values.update({r["column"]: r["median"] for r in medians(dataset, numbers).collect()})
        model = FillerModel()
        return model._set(categorical=texts, numeric=numbers, fitted=json.dumps(values))


class FillerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces missing values; a column that was all missing in training is left as it is."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = json.loads(self.getOrDefault("fitted"))
        changes = {}
        for name in self.getOrDefault("categorical"):
            text = quoted(name).cast("string")
            changes[name] = F.coalesce(text, F.lit(values[name])) if values.get(name) is not None else text
        for name in self.getOrDefault("numeric"):
            number = quoted(name).cast("double")
            changes[name] = F.coalesce(number, F.lit(values[name])) if values.get(name) is not None else number
        return replace_columns(dataset, changes)


class PopulationScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns population standard deviations (MLlib's scaler uses the sample form)."""

    @keyword_only
    def __init__(self, *, numeric=None):
        super().__init__()
        self._set(numeric=numeric or [])

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        numbers = self.getOrDefault("numeric")
        rows = population_scales(dataset, numbers).collect() if numbers else []
        model = PopulationScalerModel()
        return model._set(numeric=numbers, fitted=json.dumps({r["column"]: r["scale"] for r in rows}))


class PopulationScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Divides by the learned scale; no centring. Values go to ``scaled__<column>``."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scales = json.loads(self.getOrDefault("fitted"))
        return dataset.select(
            "*",
            *[(quoted(c) / F.lit(scales[c])).alias(f"scaled__{_safe(c)}") for c in self.getOrDefault("numeric")],
        )


def _safe(name: str) -> str:
    """Stage column names without dots, which VectorAssembler would read as nesting."""
    return name.replace(".", "_")


def preprocessor(categorical: list[str], numeric: list[str], features: str = "features") -> Pipeline:
    """Impute, one-hot encode all levels in sorted order, scale, assemble.

    The indexer keeps a slot for unseen levels and the encoder drops exactly that slot,
    so an unseen level becomes all zeros.
    """
    stages: list = [Filler(categorical=categorical, numeric=numeric)]
    inputs = []
    if categorical:
        indexed = [f"index__{_safe(c)}" for c in categorical]
        encoded = [f"onehot__{_safe(c)}" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"))
        inputs += encoded
    if numeric:
        stages.append(PopulationScaler(numeric=numeric))
        inputs += [f"scaled__{_safe(c)}" for c in numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features))
    return Pipeline(stages=stages)


def feature_names(fitted: PipelineModel) -> list[str]:
    """Names of the vector slots: ``categorical__<column>_<level>``, ``numerical__<column>``."""
    names = []
    for stage in fitted.stages:
        if isinstance(stage, PipelineModel):
            return feature_names(stage)
        if isinstance(stage, StringIndexerModel):
            for column, levels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"categorical__{column}_{level}" for level in levels]
        if isinstance(stage, PopulationScalerModel):
            names += [f"numerical__{c}" for c in stage.getOrDefault("numeric")]
    return names
