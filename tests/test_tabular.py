"""Readers, preprocessing, metrics, models and the two tabular pipelines."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import clean, metrics, models, prep, profile
from larkspur.plans import churn, exams
from larkspur.plans import views as v
from larkspur.session import scratch_path
from larkspur.operators.split import hash_split
from larkspur.sources.delimited import read_dirty
from larkspur.streaming import jobs

MARKS = ["CustomerID", "Tenure Months", "Churn Label"]


def test_dirty_files(spark, tmp_path):
    (tmp_path / "tabs.csv").write_bytes(
        "﻿junk\n\nCustomerID\\tTenure Months \tChurn Label\nb\\t1\tYes\n\n  \na\t\tNA\n\t\t\nc\t2\t Yes \n".encode()
    )
    (tmp_path / "commas.csv").write_text('CustomerID,Tenure Months,Churn Label\n"x,""y""",3,No\n', encoding="utf-8")
    (tmp_path / "semi.csv").write_bytes(b"skip\nCustomerID;Tenure Months;Churn Label;More\nz;4;\xffNo;m\n")
    rows = read_dirty(spark, str(tmp_path), MARKS).orderBy("row_id").collect()
    got = [(r["CustomerID"], r["Tenure Months"], r["Churn Label"], r["More"]) for r in rows]
    assert sorted(got, key=str) == sorted(
        [
            ('x,"y"', "3", "No", None), ("z", "4", "�No", "m"), ("b", "1", "Yes", None),
            ("a", None, None, None), (None, None, None, None), ("c", "2", "Yes", None),
        ],
        key=str,
    )
    tabs = [r["CustomerID"] for r in rows if "tabs" in r["row_id"]["file"]]
    assert tabs == ["b", "a", None, "c"]
    texts = read_dirty(spark, str(tmp_path / "tabs.csv"), MARKS, null_literal="nan")
    assert texts.where("`Churn Label` = 'nan'").count() == 2


def test_dirty_file_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        read_dirty(spark, str(tmp_path), MARKS)
    (tmp_path / "b.csv").write_text("CustomerID,Tenure Months,Churn Label\n1,2,Yes\n", encoding="utf-8")
    with pytest.raises(ValueError, match="a.csv"):
        read_dirty(spark, str(tmp_path), MARKS)
    (tmp_path / "a.csv").write_text("CustomerID Tenure Months Churn Label\n1,2,Yes\n", encoding="utf-8")
    with pytest.raises(ValueError, match="separator"):
        read_dirty(spark, str(tmp_path), MARKS)


def test_many_layouts_in_one_scan(spark, tmp_path):
    for i in range(70):
        names = ["CustomerID", "Tenure Months", "Churn Label", f"Extra {i}"]
        names = names[i % 4 :] + names[: i % 4]
        sep = "\t,;"[i % 3]
        values = {"CustomerID": f"c{i}", "Tenure Months": str(i), "Churn Label": "Yes", f"Extra {i}": f"x{i}"}
        lines = [sep.join(names), sep.join(values[n] for n in names)]
        (tmp_path / f"f{i}.csv").write_text("\n".join(lines), encoding="utf-8")
    rows = read_dirty(spark, str(tmp_path), MARKS)
    assert len(rows.columns) == 1 + 3 + 70
    got = {r["CustomerID"]: r for r in rows.collect()}
    assert len(got) == 70
    for i in range(70):
        r = got[f"c{i}"]
        assert (r["Tenure Months"], r["Churn Label"], r[f"Extra {i}"], r[f"Extra {(i + 1) % 70}"]) == (str(i), "Yes", f"x{i}", None)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("] text") == 1


@pytest.mark.parametrize("stratify", [None, "k"])
def test_split_with_missing_ids(spark, stratify):
    rows = spark.createDataFrame([(None if i % 40 == 0 else i, "ab"[i % 2]) for i in range(200)], "i long, k string")
    marked = hash_split(rows, "i", stratify=stratify).collect()
    assert len(marked) == 200 and all(r["is_test"] is not None for r in marked)
    assert 40 <= sum(r["is_test"] for r in marked) <= 45


def test_split_of_many_large_classes(spark, monkeypatch):
    from larkspur.operators import split

    rows = spark.range(60_000).selectExpr("id", "id % 60 as k")
    monkeypatch.setattr(split, "COUNT_ROWS", 50)
    assert hash_split(rows, "id", stratify="k").where("is_test").count() == 12_000
    assert split._shares({"a": 10**10, "b": 3 * 10**10 + 1}, 0.2) == {"a": 2 * 10**9, "b": 6 * 10**9 + 1}


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_read_files_and_folders(spark, tmp_path, parts):
    path = str(tmp_path / "t.parquet")
    spark.range(90).repartition(parts).write.parquet(path)
    if parts == 1:
        path = str(next((tmp_path / "t.parquet").glob("*.parquet")))
    query = jobs.file_stream(spark, path, "id long").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 90


def test_header_reaches_all_splits_of_a_file(spark, tmp_path):
    lines = ["junk"] * 50 + ["CustomerID\tTenure Months\tChurn Label"] + [f"{i}\t{i % 70}\tYes" for i in range(4000)]
    (tmp_path / "big.csv").write_text("\n".join(lines), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_dirty(spark, str(tmp_path), MARKS)
        assert [int(r[0]) for r in rows.orderBy("row_id").select("CustomerID").collect()] == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        clean.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"])


def test_leaks_are_refused(spark):
    with pytest.raises(ValueError, match="CLTV"):
        profile.select_features(spark.range(1).toDF("CLTV"), [], ["CLTV"], churn.LEAKAGE)


def test_constant_features(spark):
    rows = spark.createDataFrame([("x", None, 1.0, "p"), (None, None, 1.0, "q")], "a string, b string, c double, d string")
    got = profile.select_features(rows, ["a", "b", "d", "absent"], ["c"], [])
    assert got == (["d"], [], ["a", "b", "c"])


def test_duplicates(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert tuple(clean.duplicate_counts(rows).first()) == (4, 2)
    assert clean.drop_duplicate_rows(rows).count() == 2


def test_imputation(spark):
    rows = spark.createDataFrame(
        [("b", 1.0, None), ("a", 2.0, None), ("a", 3.0, None), ("b", 5.0, None), (None, None, None)], "t string, x double, e string"
    )
    model = prep.Filler(categorical=["t", "e"], numeric=["x"]).fit(rows)
    filled = model.transform(rows.where("t is null")).first()
    assert tuple(filled) == ("a", 2.5, None)  # the smaller text on ties, the interpolated median


def test_one_hot_and_scale(spark):
    train = spark.createDataFrame([("b", 1.0, 7.0), ("a", 2.0, 7.0), ("c", 6.0, 7.0), ("b", None, 7.0)], "t string, x double, k double")
    fitted = prep.preprocessor(["t"], ["x", "k"]).fit(train)
    assert prep.feature_names(fitted) == [
        "categorical__t_a", "categorical__t_b", "categorical__t_c", "numerical__x", "numerical__k"
    ]
    new = spark.createDataFrame([("z", 2.0, 7.0), (None, None, None)], "t string, x double, k double")
    vectors = [list(r["features"].toArray()) for r in fitted.transform(new).collect()]
    scale = (sum((x - 2.75) ** 2 for x in (1, 2, 6, 2)) / 4) ** 0.5
    assert vectors[0] == pytest.approx([0, 0, 0, 2 / scale, 7])  # unseen level, constant column unscaled
    assert vectors[1] == pytest.approx([0, 1, 0, 2 / scale, 7])


def test_published_classification_numbers(spark):
    rows = [(0, 0)] * 116 + [(0, 1)] * 77 + [(1, 0)] * 58 + [(1, 1)] * 175
    frame = spark.createDataFrame(rows, "y int, p int")
    assert tuple(metrics.confusion_matrix(frame, "y", "p").first()) == (116, 77, 58, 175)
    scores = metrics.classification_metrics(frame, "y", "p").first()
    assert [round(scores[c], 4) for c in ("Accuracy", "Precision", "Recall", "F1")] == [0.6831, 0.6944, 0.7511, 0.7216]


def test_metrics_where_undefined(spark):
    none = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    scores = metrics.classification_metrics(none, "y", "p").first()
    assert [scores[c] for c in ("Accuracy", "Precision", "Recall", "F1")] == [1.0, 0.0, 0.0, 0.0]


def test_regression_metrics(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)], "y double, p double")
    got = metrics.regression_metrics(frame, "y", "p", "m").first()
    assert [round(got[c], 6) for c in ("MAE", "RMSE", "R2")] == [round(4 / 3, 6), round((10 / 3) ** 0.5, 6), round(1 - 10 / 14, 6)]


def test_histogram_of_one_value(spark):
    bins = profile.histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in bins] == [0, 0, 2, 0]


def test_rate_extremes_kinds(spark):
    rows = [("one", None, "Yes", 1), ("one", "a", "No", 0), ("one", "b", None, 1)]
    frame = spark.createDataFrame(rows, "k string, d string, s string, y int")
    got = {r["dimension"]: r for r in profile.rate_extremes(profile.rates(frame, ["k", "d", "s"], "y"), "s").collect()}
    assert (got["k"]["kind"], got["d"]["kind"], got["s"]["kind"]) == ("limited", "extremes", "pair")
    assert (got["d"]["highest"], got["d"]["lowest"], got["s"]["first_rate"], got["s"]["second_rate"]) == ("b", "a", 1.0, 0.0)


@pytest.fixture(scope="module")
def churn_rows(spark, sf_dir):
    labelled = clean.keep_labels(v.accounts(spark, sf_dir), "Churn Label")
    return churn.add_features(labelled).cache()


def test_churn_training(spark, churn_rows):
    categorical, numeric, constant = profile.select_features(churn_rows, churn.CATEGORICAL, churn.NUMERICAL, churn.LEAKAGE)
    assert constant == ["Phone Service"]
    fitted, predicted, comparison, selected = churn.train(churn_rows, categorical, numeric, trees=10, depth=6)
    table = {r["Model"]: r for r in comparison.collect()}
    assert min(r["ROC_AUC"] for r in table.values()) > 0.8
    assert table[selected]["F1"] == max(r["F1"] for r in table.values())
    ranked = models.importances(fitted[churn.FOREST], spark)
    assert ranked.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert models.top_importances(ranked, 3).count() == 3


def test_exam_training(spark, sf_dir):
    rows = exams.clean_scores(v.scores(spark, sf_dir))
    fitted, predicted, comparison, selected = exams.train(rows, "row_key", trees=10, depth=6)
    table = {r["Model"]: r for r in comparison.collect()}
    assert table[selected]["RMSE"] == min(r["RMSE"] for r in table.values())
    assert all(0.05 < r["R2"] < 1 for r in table.values())


def test_stream_scores_equal_batch_scores(spark, sf_dir, churn_rows):
    names = ["Contract", "Payment Method", "TenureGroup"]
    training, _ = churn.split(churn_rows)
    model = models.fit(training, names, churn.NUMERICAL, models.logistic_classifier("Churn", training.count()))
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    records = v.accounts(spark, sf_dir).drop("Churn Label")
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "scores", "state"))
    records.repartition(3).write.parquet(landing)
    stream = jobs.file_stream(spark, landing, records.schema, files=1)
    jobs.stream_scores(stream, models.load_model(path), "CustomerID", names, churn.NUMERICAL, out, state).awaitTermination()
    batch = models.score(model, churn.add_features(records), "CustomerID", names, churn.NUMERICAL, models.action_table(spark))
    streamed = spark.read.parquet(out)
    assert streamed.count() == records.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_churn_pipeline_from_file(spark, tmp_path):
    rng = random.Random(1)
    header = "\t".join(churn.REQUIRED)
    lines = ["exported", "", header]
    for i in range(400):
        tenure = rng.randint(0, 72)
        label = "Yes" if rng.random() < 0.9 - tenure / 90 else "No"
        services = [rng.choice(["Yes", "No"]) for _ in range(7)]
        values = {
            "CustomerID": f"c{i % 390}", "Gender": rng.choice(["Male", "Female"]), "Senior Citizen": rng.choice(["Yes", "No"]),
            "Partner": "Yes", "Dependents": "No", "Tenure Months": str(tenure), "Phone Service": "Yes", "Internet Service": "Fiber optic",
            "Contract": rng.choice(["Month-to-month", "Two year"]), "Paperless Billing": "Yes",
            "Payment Method": rng.choice(["Mailed check", "Electronic check"]), "Monthly Charges": "70.5",
            "Total Charges": str(round(70.5 * tenure, 2)) if i % 17 else " ", "Churn Label": label if i % 23 else "",
        }
        values.update(zip([s for s in churn.SERVICES if s != "Phone Service"], services))
        lines.append("\t".join(values[c] for c in churn.REQUIRED))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "churn.csv").write_text("\n".join(lines), encoding="utf-8")
    out = str(tmp_path / "out")
    selected = churn.run(spark, str(tmp_path / "in"), out, trees=5)
    assert selected in (churn.LOGISTIC, churn.FOREST)
    rows = spark.read.parquet(f"{out}/features")
    assert rows.count() == rows.select("CustomerID").distinct().count() <= 390
    manifest = {(r["section"], r["name"]) for r in spark.read.json(f"{out}/manifest").collect()}
    assert ("constant_removed", "Internet Service") in manifest and ("threshold", "low_max") in manifest
    assert models.load_model(f"{out}/model").stages
    read = {name: spark.read.option("header", True).csv(f"{out}/chart_{name}") for name in ("outcomes", "charges", "tenure")}
    counted = {r["value"]: int(r["count"]) for r in read["outcomes"].collect()}
    assert counted == {r[0]: r[1] for r in rows.groupBy("Churn Label").count().collect()}
    assert {r["Churn Label"] for r in read["charges"].collect()} == set(counted)
    assert [int(r["ordinal"]) for r in read["tenure"].where("ordinal is not null").collect()] == sorted(
        int(r["ordinal"]) for r in read["tenure"].where("ordinal is not null").collect())
