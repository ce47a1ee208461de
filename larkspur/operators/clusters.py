"""Exact top-k search that reads only the clusters of a vector table that can hold a result.

A table is stored with a partition per cluster, and beside it each cluster's centre, radius
and size. No vector of a cluster scores above ``q . centre + |q| * radius``. A search first
reads the most promising clusters of each query; their k-th best score is a floor under the
result, and only clusters whose bound reaches it are read after that. What is left out cannot
hold a result, so the hits and their ties are those of a scan of all vectors.

Centres are fitted on a bounded sample; they decide how much is read, not what is found. The
number of clusters is bounded, and so is what is broadcast. A cluster of any size is read in
blocks, as are the queries that meet it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.bounds import attach
from larkspur.operators.search import CORPUS_BLOCK, MIN_SIMILARITY, QUERY_VALUES, TOP_K, _block_best, _matrix
from larkspur.session import durable, scratch_path

MAX_CLUSTERS = 1024
SAMPLE = 50_000
FILE_ROWS = 100_000
PROBES = 1  # clusters that a query reads first
#: Share of a bound's terms by which it is raised against rounding.
SLACK = 1e-9

Batches = Iterator[pa.RecordBatch]


class Found(NamedTuple):
    """``hits`` like those of ``search``, and ``probes``: query_id, cluster and vectors read for it."""

    hits: DataFrame
    probes: DataFrame


def _centres(vectors: DataFrame, vector: str, clusters: int, rows: int, seed: int) -> np.ndarray:
    some = vectors if rows <= SAMPLE else vectors.sample(SAMPLE / rows, seed=seed)
    features = some.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=clusters, seed=seed, maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def build(
    vectors: DataFrame, path: str, clusters: int | None = None, vector: str = "embedding", chunk_id: str = "chunk_id", seed: int = 1,
    file_rows: int = FILE_ROWS,
) -> None:
    """Write ``vectors`` (one width, missing ones left out) as a clustered table below ``path``."""
    spark = vectors.sparkSession
    present = vectors.where(F.col(vector).isNotNull())
    rows = present.count()
    schema = T.StructType([*present.schema, T.StructField("cluster", T.IntegerType()), T.StructField("gap", T.DoubleType())])
    wanted = min(MAX_CLUSTERS, clusters or max(1, math.isqrt(rows)), max(rows, 1))
    if rows:
        centres = spark.sparkContext.broadcast(_centres(present, vector, wanted, rows, seed) if wanted > 1 else np.zeros((1, 1)))

    def assign(batches: Batches) -> Batches:
        points = centres.value
        for batch in batches:
            own = _matrix(batch.column(batch.schema.get_field_index(vector)))
            if points.shape[1] != own.shape[1]:
                points = np.zeros((1, own.shape[1]))  # a single cluster around zero
            nearest = np.argmin((points**2).sum(axis=1) - 2 * (own @ points.T), axis=1).astype("int32")
            gap = np.sqrt(((own - points[nearest]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest), pa.array(gap)], names=schema.names)

    raw = scratch_path(spark, "clusters")
    (present.mapInArrow(assign, schema) if rows else spark.createDataFrame([], schema)).write.parquet(raw)
    assigned = spark.read.parquet(raw)
    sizes = durable(assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.max("gap").alias("radius")))  # at most MAX_CLUSTERS
    files = F.broadcast(sizes.select("cluster", F.expr(f"rows div {file_rows} + 1").alias("files")))
    salted = assigned.drop("gap").join(files, "cluster").withColumn("part", F.pmod(F.xxhash64(chunk_id), F.col("files")))
    salted.repartition("cluster", "part").drop("files", "part").write.mode("overwrite").option(
        "maxRecordsPerFile", file_rows
    ).partitionBy("cluster").parquet(f"{path}/vectors")
    assigned.drop("gap").limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # also where there is no vector
    points = centres.value.tolist() if rows and wanted > 1 else []
    placed = spark.createDataFrame(list(enumerate(points)), "cluster int, centre array<double>")
    attach(sizes, placed, ["cluster"]).write.mode("overwrite").parquet(f"{path}/clusters")


class _Index:
    """Centres, radii and sizes of the clusters: at most ``MAX_CLUSTERS`` rows."""

    def __init__(self, spark: SparkSession, path: str):
        rows = sorted(spark.read.parquet(f"{path}/clusters").collect(), key=lambda r: r["cluster"])
        self.ids = np.array([r["cluster"] for r in rows], dtype="int32")
        self.sizes = {r["cluster"]: r["rows"] for r in rows}
        self.radii = np.array([r["radius"] for r in rows], dtype="float64")
        centred = rows and rows[0]["centre"] is not None
        self.centres = np.array([r["centre"] for r in rows]) if centred else None

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No score of a query in a cluster is above these, also not by rounding."""
        length = np.linalg.norm(queries, axis=1)[:, None]
        if self.centres is None:
            return length * self.radii * (1 + SLACK)
        if queries.shape[1] != self.centres.shape[1]:
            raise ValueError(f"queries of dimension {queries.shape[1]}, vectors of {self.centres.shape[1]}")
        reach = np.linalg.norm(self.centres, axis=1) + self.radii
        return queries @ self.centres.T + length * self.radii + SLACK * length * reach


def _probes(index: _Index, query_id: str, vector: str, floor: float, probes: int, later: bool):
    """(query, vector, cluster) of the first ``probes`` clusters by bound, or of all others that reach the query's floor."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            at = batch.schema.get_field_index
            bounds = index.bounds(_matrix(batch.column(at(vector))))
            order = np.argsort(-bounds, axis=1, kind="stable")
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
            least = np.full(len(bounds), floor)
            if later:
                least = np.maximum(least, batch.column(at("least")).to_numpy(zero_copy_only=False))
            take = (bounds >= least[:, None]) & ((rank >= probes) if later else (rank < probes))
            query, cluster = np.nonzero(take)
            rows = pa.array(query)
            yield pa.RecordBatch.from_arrays(
                [batch.column(at(query_id)).take(rows), batch.column(at(vector)).take(rows), pa.array(index.ids[cluster])],
                names=[query_id, vector, "cluster"],
            )

    return run


def _score(probed: DataFrame, index: _Index, path: str, k: int, floor: float, query_id: str, chunk_id: str, vector: str, query_values: int, block: int) -> DataFrame:
    """The k best per query of the clusters it probes; other partitions are not read."""
    spark = probed.sparkSession
    asked = probed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).collect()  # at most MAX_CLUSTERS
    plan = [(r["cluster"], index.sizes[r["cluster"]] // block + 1, r["n"] * r["width"] // query_values + 1) for r in asked]
    plan = F.broadcast(spark.createDataFrame(plan, "cluster int, blocks long, askers long"))
    schema = spark.read.parquet(f"{path}/schema").schema
    stored = spark.read.schema(schema).parquet(f"{path}/vectors").where(F.col("cluster").isin([r["cluster"] for r in asked]))

    def every(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    left = probed.join(plan, "cluster").withColumn("_q", F.pmod(F.xxhash64(query_id), F.col("askers"))).withColumn("_c", every("blocks"))
    right = stored.select("cluster", chunk_id, vector).join(plan, "cluster")
    right = right.withColumn("_c", F.pmod(F.xxhash64(chunk_id), F.col("blocks"))).withColumn("_q", every("askers"))
    schema = T.StructType([probed.schema[query_id], stored.schema[chunk_id], T.StructField("similarity_score", T.DoubleType())])
    names = schema.names

    def best(some: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(rows):
            return pd.DataFrame({n: [] for n in names})
        own, matrix = np.stack(rows[vector]).astype("float64"), np.stack(some[vector]).astype("float64")
        query, at, values = _block_best(own, rows[chunk_id].to_numpy(), None, matrix, k, floor)
        return pd.DataFrame({query_id: some[query_id].to_numpy()[query], chunk_id: rows[chunk_id].to_numpy()[at], "similarity_score": values})

    keys = ["cluster", "_q", "_c"]
    return left.select(*keys, query_id, vector).groupBy(*keys).cogroup(right.select(*keys, chunk_id, vector).groupBy(*keys)).applyInPandas(best, schema)


def search(
    queries: DataFrame, path: str, k: int = TOP_K, floor: float = MIN_SIMILARITY, query_id: str = "query_id", chunk_id: str = "chunk_id",
    vector: str = "embedding", probes: int = PROBES, query_values: int = QUERY_VALUES, block: int = CORPUS_BLOCK,
) -> Found:
    """(query_id, chunk_id, similarity_score, rank) as by an exact scan, from a table that ``build`` wrote.

    Query ids are told apart; a missing query vector finds nothing.
    """
    spark = queries.sparkSession
    index = _Index(spark, path)
    wanted = durable(queries.where(F.col(vector).isNotNull()).select(query_id, vector))
    probe_schema = T.StructType([wanted.schema[query_id], wanted.schema[vector], T.StructField("cluster", T.IntegerType())])
    order = Window.partitionBy(query_id).orderBy(F.desc("similarity_score"), chunk_id)

    def top(hits: DataFrame) -> DataFrame:
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def read(asking: DataFrame, later: bool) -> tuple[DataFrame, DataFrame]:
        probed = durable(asking.mapInArrow(_probes(index, query_id, vector, floor, probes, later), probe_schema))
        return probed.select(query_id, "cluster"), _score(probed, index, path, k, floor, query_id, chunk_id, vector, query_values, block)

    first_probes, first = read(wanted, False)
    first = durable(top(first).drop("rank"))
    reached = first.groupBy(query_id).agg(F.count(F.lit(1)).alias("n"), F.min("similarity_score").alias("least"))
    least = reached.select(query_id, F.when(F.col("n") >= k, F.col("least")).alias("least"))
    asking = wanted.join(least, query_id, "left").select(query_id, vector, F.coalesce("least", F.lit(float(floor))).alias("least"))
    later_probes, later = read(asking, True)
    sizes = spark.createDataFrame(list(index.sizes.items()), "cluster int, vectors long")
    both = first_probes.unionByName(later_probes).join(F.broadcast(sizes), "cluster")
    return Found(top(first.unionByName(later)), both.select(query_id, "cluster", "vectors"))


def share_read(found: Found, path: str) -> DataFrame:
    """One row: vectors stored, vectors in the partitions read, and scores computed as a share of all pairs."""
    probes = found.probes
    query_id = probes.columns[0]
    stored = probes.sparkSession.read.parquet(f"{path}/clusters").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("stored"))
    read = probes.select("cluster", "vectors").distinct().agg(F.coalesce(F.sum("vectors"), F.lit(0)).alias("read"))
    scored = probes.agg(F.coalesce(F.sum("vectors"), F.lit(0)).alias("scored"), F.count_distinct(query_id).alias("asked"))
    row = {**stored.first().asDict(), **read.first().asDict(), **scored.first().asDict()}
    pairs = row["stored"] * row["asked"]
    values = (row["stored"], row["read"], row["scored"] / pairs if pairs else 0.0)
    return probes.sparkSession.createDataFrame([values], "stored long, read long, share_scored double")


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
