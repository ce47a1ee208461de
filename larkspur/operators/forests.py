"""Regression forests on one-hot features, grown from sums instead of rows.

Rows with equal features go the same way through every tree, so a tree needs of them only how often
they are in its bootstrap sample, and the sum and the sum of squares of their labels. MLlib passes
all rows and trees for every level; here one pass over the distinct (features, label) rows draws how
often each is in the sample of each tree and adds up per distinct features, and every tree grows
from these sums, by MLlib's rules, in a task of its own. The result is an MLlib model.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import scratch_path

SUMMED_ROWS = 100_000  # forests of fewer rows are left to MLlib, whose draws depend on where the rows lie
MAX_CELLS = 4096  # distinct features; with more of them sums would not be much smaller than rows
NEAR = 1e-12  # gains that differ by less of the impurity are equal, the first feature wins as in MLlib

SUMS = "tree int, cell int, w double, wy double, wyy double"
NODES = (
    "tree int, id int, prediction double, impurity double, w double, wy double, wyy double, gain double,"
    " left int, right int, feature int, category double"
)


def drawn_sums(parts: Iterator[pa.RecordBatch], cells: int, trees: int, seed: int, bootstrap: bool) -> Iterator[pa.RecordBatch]:
    """Per tree and cell the drawn number of rows with the sums of their labels and squares.

    A row that occurs n times is drawn as often as n rows drawn by a Poisson law of mean one,
    which is a Poisson law of mean n. Draws are keyed by the row, so they are the same however
    the rows are dealt to tasks.
    """
    sums = np.zeros((3, cells, trees))
    for part in parts:
        columns = [part.column(name).to_numpy(zero_copy_only=False) for name in ("cell", "y", "n", "key")]
        for cell, y, n, key in zip(*columns):
            if bootstrap:
                drawn = np.random.Generator(np.random.Philox(key=[seed, int(key) & (2**64 - 1)])).poisson(n, trees)
            else:
                drawn = np.full(trees, n)
            sums[0, cell] += drawn
            sums[1, cell] += drawn * y
            sums[2, cell] += drawn * (y * y)
    cell, tree = np.nonzero(sums[0])
    columns = [tree.astype(np.int32), cell.astype(np.int32), *[s[cell, tree] for s in sums]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "cell", "w", "wy", "wyy"])


def _impurity(sums: np.ndarray) -> np.ndarray:
    """Variance of the last axis' (w, wy, wyy); 0 without rows."""
    w = np.where(sums[..., 0] > 0, sums[..., 0], 1.0)
    return np.maximum(sums[..., 2] / w - (sums[..., 1] / w) ** 2, 0.0)


def grow(ones: np.ndarray, sums: np.ndarray, least: int, depth: int) -> list[list]:
    """Nodes in preorder: id, sums, gain, left, right, feature, left category; a leaf has -1 for the last five.

    ``ones`` has the 0/1 features of every cell, ``sums`` its (w, wy, wyy). As in MLlib the category
    with the smaller mean goes left, the first feature of the largest gain splits, and both children
    need ``least`` rows.
    """
    nodes: list[list] = []
    floor = NEAR * _impurity(sums.sum(axis=0))

    def add(at: np.ndarray, level: int) -> int:
        own = sums[at]
        total, place = own.sum(axis=0), len(nodes)
        impurity = _impurity(total)
        nodes.append([place, *total, -1.0, -1, -1, -1, -1.0])
        if level == depth or len(at) < 2 or impurity <= floor:
            return place
        one, zero = ones[at].T @ own, (1.0 - ones[at]).T @ own
        gains = impurity - (one[:, 0] * _impurity(one) + zero[:, 0] * _impurity(zero)) / total[0]
        gains[(one[:, 0] < least) | (zero[:, 0] < least)] = -1.0
        gain = gains.max(initial=-1.0)
        if gain <= NEAR * impurity:
            return place
        feature = int(np.argmax(gains >= gain - NEAR * impurity))
        category = float(one[feature, 1] / one[feature, 0] < zero[feature, 1] / zero[feature, 0])
        goes = ones[at, feature] == category
        left = add(at[goes], level + 1)
        nodes[place][4:] = [float(gains[feature]), left, add(at[~goes], level + 1), feature, category]
        return place

    add(np.flatnonzero(sums[:, 0] > 0), 0)
    return nodes


def fit_summed(encoded: DataFrame, estimator: RandomForestRegressor) -> RandomForestRegressionModel | None:
    """The forest of all rows of (features, label), grown from sums; None where features have too many distinct values.

    ``encoded`` has one-hot features only.
    """
    spark, label = encoded.sparkSession, estimator.getLabelCol()
    trees, seed, bootstrap = estimator.getNumTrees(), estimator.getSeed(), estimator.getBootstrap()
    least, depth = estimator.getMinInstancesPerNode(), estimator.getMaxDepth()
    rows = encoded.select(F.transform(vector_to_array("features"), lambda v: v.cast("int")).alias("x"), F.col(label).alias("y"))
    found = sorted(r["x"] for r in rows.select("x").distinct().limit(MAX_CELLS + 1).collect())
    if not found or len(found) > MAX_CELLS:
        return None
    cells = spark.createDataFrame(list(enumerate(found)), "cell int, x array<int>")
    middle = rows.agg(F.avg("y")).first()[0]  # sums of differences from it lose fewer digits
    kinds = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(cells), "x")
    kinds = kinds.select("cell", (F.col("y") - F.lit(middle)).alias("y"), "n", F.xxhash64("x", "y").alias("key"))
    size, ones = len(found), np.array(found, dtype=np.float64)
    sums = kinds.mapInArrow(lambda parts: drawn_sums(parts, size, trees, seed, bootstrap), SUMS)

    def grown(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        summed = np.stack([np.bincount(part["cell"], weights=part[c], minlength=size) for c in ("w", "wy", "wyy")], axis=1)
        out = pd.DataFrame(grow(ones, summed, least, depth), columns=["id", "w", "wy", "wyy", "gain", "left", "right", "feature", "category"])
        mean, impurity = out["wy"] / out["w"], _impurity(out[["w", "wy", "wyy"]].to_numpy())
        out["wyy"] = out["wyy"] + 2 * middle * out["wy"] + middle**2 * out["w"]
        out["wy"] = out["wy"] + middle * out["w"]
        return out.assign(tree=key[0], prediction=mean + middle, impurity=impurity)[[c.split()[0] for c in NODES.split(",")]]

    return _as_model(sums.groupBy("tree").applyInPandas(grown, NODES), estimator, encoded)


def _as_model(nodes: DataFrame, estimator: RandomForestRegressor, encoded: DataFrame) -> RandomForestRegressionModel:
    """The nodes as the stored data of a model with the settings of the estimator, loaded by MLlib."""
    c = F.col
    leaf = c("feature") < 0
    split = F.struct(
        c("feature").alias("featureIndex"), F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("category")).alias("leftCategoriesOrThreshold"),
        F.when(leaf, -1).otherwise(2).alias("numCategories"),
    )
    data = F.struct(
        "id", "prediction", "impurity", F.array("w", "wy", "wyy").alias("impurityStats"), c("w").cast("long").alias("rawCount"), "gain",
        c("left").alias("leftChild"), c("right").alias("rightChild"), split.alias("split"),
    )
    path = scratch_path(nodes.sparkSession, "forest")
    estimator.fit(encoded.limit(2)).write().save(path)
    nodes.select(c("tree").alias("treeID"), data.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
