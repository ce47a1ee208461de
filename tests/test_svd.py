"""The trained encoder against a dense singular value decomposition."""

import random

import numpy as np
from pyspark.sql import functions as F

from larkspur.operators import svd
from larkspur.session import scratch_path


def corpus(n=240):
    draw = random.Random(7)
    topics = [[f"{t}{i}" for i in range(25)] for t in ("sea", "tax", "owl", "jet")]
    texts = [" ".join(draw.choice(topics[i % 4] if draw.random() < 0.9 else draw.choice(topics)) for _ in range(draw.randint(3, 60))) for i in range(n)]
    return [*texts, None, "", " ... ", "Sea0 SEA0 sea0!"]


def dense(texts, slots):
    lists = [own for own in (svd.slots_of(t, slots) for t in texts) if own]
    counts = np.zeros((len(lists), slots))
    for i, own in enumerate(lists):
        np.add.at(counts[i], own, 1)
    idf = np.log((1 + len(lists)) / (1 + (counts > 0).sum(axis=0))) + 1
    matrix = np.where(counts > 0, (1 + np.log(np.maximum(counts, 1))) * idf, 0)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True), idf


def test_same_subspace_as_a_dense_decomposition(spark, monkeypatch):
    monkeypatch.setattr(svd, "ENTRIES", 300)
    texts = corpus()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5)
    model = svd.fit(frame, rank=4, slots=512, rounds=8)
    matrix, idf = dense(texts, 512)
    _, values, vectors = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.idf, idf) and np.allclose(model.values, values[:4], rtol=1e-6)
    assert np.linalg.svd(vectors[:4] @ model.vectors)[1].min() > 1 - 1e-6
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(4), atol=1e-9)

    path = scratch_path(spark, "svd")
    model.save(spark, path)
    again = svd.load(spark, path)
    out = {r["id"]: np.array(r["embedding"]) for r in again.encoder().embed(frame, "text").collect()}
    assert len(out) == len(texts)
    for i in (240, 241, 242):
        assert not out[i].any()
    assert np.allclose([np.linalg.norm(out[i]) for i in range(240)], 1, atol=1e-5)
    inner, outer = [], []
    for i in range(0, 60):
        for j in range(i):
            (inner if i % 4 == j % 4 else outer).append(out[i] @ out[j])
    assert np.mean(inner) > np.mean(outer) + 0.3


def test_nothing_to_train_on(spark):
    model = svd.fit(spark.createDataFrame([(None,), ("..",)], "text string"), rank=2, slots=64, rounds=1)
    out = model.encoder().embed(spark.createDataFrame([("word",)], "text string"), "text")
    assert out.select(F.size("embedding")).first()[0] == 2


def test_counts_and_sums_of_texts():
    lists = [[5, 1, 5], [0], [7, 7, 7, 1]]
    row, slot, n = svd._counted(lists, 8)
    assert (row.tolist(), slot.tolist(), n.tolist()) == ([0, 0, 1, 2, 2], [1, 5, 0, 1, 7], [1, 2, 1, 1, 3])
    value = svd._weights(row, slot, n, np.ones(8))
    assert np.allclose(np.bincount(row, weights=value**2), 1)
    matrix = np.arange(16.0).reshape(8, 2)
    dense = np.zeros((3, 8))
    dense[row, slot] = value
    assert np.allclose(svd._sums(value, matrix, slot, np.array([0, 2, 3])), dense @ matrix)
    assert [len(own) for own in svd._counted([], 8)] == [0, 0, 0]
