"""Search in a clustered table equals a scan, and reads little where the vectors are clustered."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import clusters
from larkspur.operators.search import search
from larkspur.session import scratch_path

VECTORS = "chunk_id long, embedding array<float>, label string"
QUERIES = "query_id long, embedding array<double>"


def frames(spark, vectors, queries):
    stored = spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "l") for i, v in vectors], VECTORS)
    asked = spark.createDataFrame([(i, None if q is None else [float(x) for x in q]) for i, q in queries], QUERIES)
    return stored, asked


def compare(spark, stored, asked, n, k, floor, **sizes):
    path = scratch_path(spark, "clustered")
    clusters.build(stored, path, n, **({"file_rows": 40} if sizes else {}))
    found = clusters.search(asked, path, k, floor, **sizes)
    got = sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["similarity_score"], 9)) for r in found.hits.collect())
    want = search(asked, stored, k, floor).collect()
    assert got == sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["similarity_score"], 9)) for r in want)
    return clusters.share_read(found, path).first(), got


def blobs(seed, centres, each, width=16, spread=0.03):
    draw = np.random.default_rng(seed)
    middle = draw.standard_normal((centres, width))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    own = np.repeat(middle, each, axis=0) + spread * draw.standard_normal((centres * each, width))
    return middle, own.astype("float32")


def test_clustered_vectors_are_mostly_left_unread(spark):
    middle, own = blobs(1, 20, 60)
    rows = [(int(i), v) for i, v in enumerate(own)] + [(5000 + i, own[7]) for i in range(6)] + [(9000, None)]  # ties and a missing one
    stored, asked = frames(spark, rows, [(i, m) for i, m in enumerate(middle[:4])] + [(77, own[7]), (78, None)])
    share, got = compare(spark, stored, asked, 40, 5, 0.35)
    assert share["stored"] == 20 * 60 + 6
    assert share["read"] <= 0.5 * share["stored"] and share["share_scored"] <= 0.2
    copies = [c for q, r, c, s in got if q == 77 and (c == 7 or c >= 5000)]
    assert copies == sorted(copies)


@pytest.mark.parametrize("k,floor", [(1, -2.0), (7, 0.0), (400, -2.0)])
def test_vectors_in_all_directions(spark, k, floor):
    draw = np.random.default_rng(3)
    own = draw.standard_normal((300, 6)).astype("float32") * draw.uniform(0, 2, (300, 1))
    stored, asked = frames(spark, list(enumerate(own)), [(i, q) for i, q in enumerate(draw.standard_normal((12, 6)))] + [(99, np.zeros(6))])
    compare(spark, stored, asked, 15, k, floor)
    compare(spark, stored, asked, 15, k, floor, query_values=12, block=25)  # blocks of queries and of clusters


def test_hot_cluster_has_files_of_bounded_size(spark):
    _, own = blobs(5, 1, 400, spread=0.001)
    _, few = blobs(6, 3, 10)
    stored, asked = frames(spark, list(enumerate(np.concatenate([own, few]))), [(1, own[0]), (2, few[0])])
    path = scratch_path(spark, "clustered")
    clusters.build(stored, path, 4, file_rows=50)
    files = spark.read.parquet(f"{path}/vectors").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert files <= 50
    share, _ = compare(spark, stored, asked, 4, 3, 0.0, block=60)
    assert share["stored"] == 430


def test_small_tables(spark):
    stored, asked = frames(spark, [(1, [1, 0]), (2, [0, 1])], [(1, [1, 0])])
    compare(spark, stored, asked, None, 5, 0.35)
    compare(spark, stored, asked, 10, 5, -1.0)
    compare(spark, stored.limit(0), asked, None, 5, 0.35)
    compare(spark, stored, asked.limit(0), None, 5, 0.35)
    compare(spark, stored.where("chunk_id = 1"), asked, None, 5, 0.35)


def test_another_dimension_is_refused(spark):
    stored, asked = frames(spark, [(i, [i, 1, 2]) for i in range(9)], [(1, [1, 0])])
    path = scratch_path(spark, "clustered")
    clusters.build(stored, path, 2)
    with pytest.raises(Exception, match="dimension"):
        clusters.search(asked, path, 5, 0.0).hits.collect()
