"""The forms for large and skewed data give the results of the plain forms."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import clean, metrics, split
from larkspur.operators.ranks import block_running_totals, running_totals
from larkspur.operators.search import search
from larkspur.operators.summaries import summarize


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows, two thirds of them under one key, keys also NULL."""
    rng = random.Random(7)
    rows = [(i, None if i % 50 == 0 else ("hot" if i % 3 else f"k{i % 7}"), rng.choice([None, rng.random(), 0.5])) for i in range(900)]
    return spark.createDataFrame(rows, "i long, k string, x double").repartition(6).cache()


def test_running_totals_across_partitions(skewed):
    totals = {"n": F.lit(1), "s": F.col("i")}
    order = [F.col("i")]
    plain = running_totals(skewed, ["k"], order, totals)
    split_up = running_totals(skewed, ["k"], order, totals, max_rows=0)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split_up.collect()))
    whole = running_totals(skewed, [], order, {"n": F.lit(1)}, max_rows=0)
    assert [r["n"] for r in whole.orderBy("i").collect()] == list(range(1, 901))


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_block_running_totals(skewed, block):
    got = block_running_totals(skewed, ["k"], "i", {"n": F.lit(1)}, block)
    want = running_totals(skewed, ["k"], [F.col("i")], {"n": F.lit(1)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_exact_quantiles_without_holding_a_group(skewed):
    wanted = {"q1": 0.25, "median": 0.5, "q9": 0.9}
    small = summarize(skewed, ["k"], ["x"], ["count", "mean"], wanted)
    large = summarize(skewed, ["k"], ["x"], ["count", "mean"], wanted, distinct_limit=0)

    def rounded(frame):
        return sorted([[round(v, 9) if isinstance(v, float) else v for v in r] for r in frame.collect()])

    assert rounded(small) == rounded(large)
    hot = [r["x"] for r in skewed.where("k = 'hot' and x is not null").collect()]
    assert [r["median"] for r in large.where("k = 'hot'").collect()] == pytest.approx([statistics.median(hot)])


def test_exact_quantiles_without_other_statistics(skewed):
    for keys in ([], ["k"]):
        frame = skewed.withColumn("none", F.lit(None).cast("double"))
        small = summarize(frame, keys, ["x", "none"], [], {"median": 0.5})
        large = summarize(frame, keys, ["x", "none"], [], {"median": 0.5}, distinct_limit=0)
        assert small.columns == large.columns and sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_first_by_key_with_a_hot_key(skewed):
    got = {r["k"]: r["i"] for r in clean.first_by_key(skewed, ["k"], ["i"]).collect()}
    first = {}
    for r in skewed.orderBy("i").collect():
        first.setdefault(r["k"], r["i"])
    assert got == first


@pytest.mark.parametrize("stratify", [None, "k"])
@pytest.mark.parametrize("rows_read", [10_000, 3])
def test_split_is_exact(skewed, monkeypatch, stratify, rows_read):
    monkeypatch.setattr(split, "FINAL_ROWS", rows_read)
    marked = split.hash_split(skewed, "i", stratify=stratify).cache()
    assert marked.where("is_test").count() == 180
    assert marked.count() == 900
    if stratify:
        for r in marked.groupBy("k").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
            assert abs(r["t"] - r["n"] / 5) < 1


def test_split_with_many_classes_agrees(skewed, monkeypatch):
    want = {r["i"] for r in split.hash_split(skewed, "i", stratify="k").where("is_test").collect()}
    monkeypatch.setattr(split, "COUNT_ROWS", 1)
    got = {r["i"] for r in split.hash_split(skewed, "i", stratify="k").where("is_test").collect()}
    assert got == want


def test_split_of_equal_ids_does_not_read_them(spark, monkeypatch):
    monkeypatch.setattr(split, "FINAL_ROWS", 5)
    same = spark.createDataFrame([(1,)] * 50, "i long")
    assert split.hash_split(same, "i").where("is_test").count() == 50


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "i long, k string")
    assert split.hash_split(empty, "i").count() == 0


def brute_auc(pairs):
    wins = sum((p > n) + 0.5 * (p == n) for p in (s for y, s in pairs if y) for n in (s for y, s in pairs if not y))
    positives = sum(y for y, _ in pairs)
    return wins / (positives * (len(pairs) - positives))


def test_roc_auc(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 1), rng.choice([0.5, rng.random()])) for _ in range(400)]
    frame = spark.createDataFrame(pairs, "y int, s double")
    assert metrics.roc_auc(frame, "y", "s").first()[0] == pytest.approx(brute_auc(pairs))
    monkeypatch.setattr(running_totals, "__defaults__", (0,))
    assert metrics.roc_auc(frame, "y", "s").first()[0] == pytest.approx(brute_auc(pairs))
    assert metrics.roc_auc(frame.where("y = 1"), "y", "s").first()[0] is None


def test_search_in_blocks_and_with_ties(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    vectors = np.vstack([base, np.repeat(base[:1], 40, axis=0)])  # 41 equal vectors
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    corpus = spark.createDataFrame(
        [(i, i % 2, [float(x) for x in v]) for i, v in enumerate(vectors)], "chunk_id long, side int, embedding array<double>"
    ).repartition(5)
    queries = corpus.where("chunk_id < 12").select(F.col("chunk_id").alias("query_id"), "embedding")
    scores = vectors @ vectors.T
    for within in (None, "side"):
        want = set()
        for q in range(12):
            for side in (0, 1) if within else (None,):
                ids = [i for i in range(100) if (side is None or i % 2 == side) and scores[q, i] >= 0.1]
                for rank, i in enumerate(sorted(ids, key=lambda i: (-round(scores[q, i], 9), i))[:5], 1):
                    want.add((q, i, rank))
        for limit in (1_000_000, 30):
            got = search(queries, corpus, 5, 0.1, within=within, carry=["side"] if not within else [], query_values=limit)
            assert {(r["query_id"], r["chunk_id"], r["rank"]) for r in got.collect()} == want


def test_search_without_queries(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0])], "chunk_id long, embedding array<double>")
    queries = spark.createDataFrame([], "query_id long, embedding array<double>")
    assert search(queries, corpus).count() == 0


@pytest.mark.parametrize("width", [8, 64, 384])
def test_score_tiles_stay_within_their_bound(width, monkeypatch):
    from larkspur.operators import search as module

    monkeypatch.setattr(module, "TILE_CELLS", 500)
    seen = []
    plain = module._best
    monkeypatch.setattr(module, "_best", lambda scores, *a: seen.append(scores.size) or plain(scores, *a))
    draw = np.random.default_rng(width)
    rows, matrix = draw.standard_normal((400, width)), draw.standard_normal((20, width))
    ids, kinds = np.arange(400)[::-1].copy(), draw.integers(0, 3, 400)
    asked, at, values = module._block_best(rows, ids, kinds, matrix, 3, -1e9)
    assert max(seen) <= 500
    scores = rows @ matrix.T
    for q in range(20):
        for kind in range(3):
            some = np.flatnonzero(kinds == kind)
            want = some[np.lexsort((ids[some], -scores[some, q]))[:3]]
            assert sorted(at[(asked == q) & (kinds[at] == kind)]) == sorted(want)
    assert np.allclose(values, scores[at, asked])


def test_sent_rows_do_not_grow_with_batches(spark):
    rows = [(i, [float(i % 17), 1.0]) for i in range(3000)]
    corpus = spark.createDataFrame(rows, "chunk_id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = search(asked, corpus, 5, 0.0).orderBy("rank").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r["chunk_id"] for r in got] == [16 + 17 * i for i in range(5)]
