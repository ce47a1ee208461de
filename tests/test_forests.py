"""Forests grown from sums are those that MLlib grows from rows."""

import pytest
from pyspark.sql import functions as F

from larkspur.operators import forests, models

LEVELS = {"a": 3, "b": 7, "c": 2}


@pytest.fixture(scope="module")
def rows(spark):
    """Every combination of three categories, some rarer than a leaf may be, with labels that all of them move."""
    i = F.col("id")
    texts = [F.when(i % 41 != 0, F.pmod(F.xxhash64("id", F.lit(n)), F.lit(k)).cast("string")).alias(n) for n, k in LEVELS.items()]
    frame = spark.range(3000).select("id", *texts).unionByName(spark.sql("SELECT -1L AS id, 'rare' AS a, '1' AS b, '0' AS c"))
    a, b, c = (F.coalesce(F.col(n).try_cast("int"), F.lit(9)) for n in LEVELS)
    y = a * 2 + b % 4 * (c + 1) + F.pmod(F.xxhash64("id"), F.lit(50)) / 9.0
    return frame.withColumn("y", y).localCheckpoint()


def fitted(monkeypatch, rows, least, estimator):
    monkeypatch.setattr(forests, "SUMMED_ROWS", least)
    return models.fit(rows, [*LEVELS], [], estimator)


def predicted(model, rows):
    return [r["predicted"] for r in models.predict_values(model, rows).orderBy("id").collect()]


@pytest.mark.parametrize("depth", [0, 3, 30])
def test_whole_trees_equal_those_of_mllib(spark, rows, monkeypatch, depth):
    by_rows = fitted(monkeypatch, rows, 10**9, models.forest_regressor("y", 2, depth, bootstrap=False))
    calls = []
    summed = forests.fit_summed
    monkeypatch.setattr(forests, "fit_summed", lambda *a: calls.append(1) or summed(*a))
    by_sums = fitted(monkeypatch, rows, 0, models.forest_regressor("y", 2, depth, bootstrap=False))
    assert calls and by_sums.stages[-1].getNumTrees == 2 and by_sums.stages[-1].getMaxDepth() == depth
    assert predicted(by_sums, rows) == pytest.approx(predicted(by_rows, rows), rel=1e-9)
    assert by_sums.stages[-1].totalNumNodes == by_rows.stages[-1].totalNumNodes
    got, wanted = (m.stages[-1].featureImportances.toArray() for m in (by_sums, by_rows))
    assert got == pytest.approx(wanted, rel=1e-9, abs=1e-12)


def test_bootstrapped_trees_differ_and_agree_with_mllib_on_average(spark, rows, monkeypatch, tmp_path):
    estimator = models.forest_regressor("y", 60)
    by_rows, by_sums = (fitted(monkeypatch, rows, least, estimator) for least in (10**9, 0))
    roots = {tree.toDebugString for tree in by_sums.stages[-1].trees}
    assert len(roots) == 60
    got, wanted = (m.stages[-1].featureImportances.toArray() for m in (by_sums, by_rows))
    assert got == pytest.approx(wanted, abs=0.02)
    some = rows.where("a <> 'rare'")
    assert predicted(by_sums, some) == pytest.approx(predicted(by_rows, some), abs=0.6)
    models.save_model(by_sums, str(tmp_path / "model"))
    assert predicted(models.load_model(str(tmp_path / "model")), rows) == predicted(by_sums, rows)


def test_draws_do_not_depend_on_where_rows_lie(spark, rows, monkeypatch):
    one, many = (fitted(monkeypatch, rows.repartition(n), 0, models.forest_regressor("y", 5)) for n in (1, 7))
    assert predicted(one, rows) == pytest.approx(predicted(many, rows), rel=1e-9)


def test_features_of_many_values_are_left_to_mllib(spark, rows, monkeypatch):
    monkeypatch.setattr(forests, "MAX_CELLS", 10)
    model = fitted(monkeypatch, rows, 0, models.forest_regressor("y", 2, 3))
    assert len(predicted(model, rows)) == rows.count()


def test_equal_inputs_are_predicted_once(spark, rows, monkeypatch):
    """The same predictions as the model's own, with missing and unseen levels; only distinct inputs reach the trees."""
    model = fitted(monkeypatch, rows, 0, models.forest_regressor("y", 5, 6))
    odd = spark.createDataFrame([(5001, None, "unseen", "1"), (5002, None, None, None)], "id long, a string, b string, c string")
    asked = rows.drop("y").unionByName(odd).unionByName(odd)
    wanted = sorted(map(tuple, model.transform(asked).select(*asked.columns, "prediction").collect()))
    seen = []
    transform = type(model).transform
    monkeypatch.setattr(type(model), "transform", lambda self, frame: seen.append(frame) or transform(self, frame))
    got = models.predict_values(model, asked)
    assert got.columns == ["id", "a", "b", "c", "predicted"]
    assert sorted(map(tuple, got.collect())) == wanted
    assert seen[0].count() == asked.select(*LEVELS).distinct().count() < 150
