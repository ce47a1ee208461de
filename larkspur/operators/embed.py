"""Text to unit vectors behind one small interface."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 32
DIMENSION = 384
COUNTED = 512  # texts that are counted at once


class Embedder(Protocol):
    def embed(self, df: DataFrame, text: str, output: str) -> DataFrame: ...


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits of a text column."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def slot(token: str, dimension: int) -> int:
    """The slot of a token: the leading 28 bits of its md5, which any engine can compute."""
    return int(hashlib.md5(token.encode()).hexdigest()[:7], 16) % dimension


def _unit_counts(lists: pa.ListArray, dimension: int) -> pa.ListArray:
    """Token counts per slot as unit vectors; each distinct token of a batch is hashed once."""
    coded = lists.flatten().dictionary_encode()
    slots = np.array([slot(token, dimension) for token in coded.dictionary.to_pylist()], dtype=np.int64)
    flat = slots[coded.indices.to_numpy()]
    ends = np.cumsum([0, *lists.value_lengths().to_numpy()])
    out = np.empty((len(lists), dimension), dtype=np.float32)
    for begin in range(0, len(lists), COUNTED):
        stop = min(begin + COUNTED, len(lists))
        row = np.repeat(np.arange(stop - begin), np.diff(ends[begin : stop + 1]))
        cells = np.bincount(row * dimension + flat[ends[begin] : ends[stop]], minlength=(stop - begin) * dimension)
        counts = cells.reshape(-1, dimension).astype(np.float64)
        length = np.sqrt(np.einsum("ij,ij->i", counts, counts))
        out[begin:stop] = counts / np.where(length > 0, length, 1.0)[:, None]
    offsets = np.arange(len(lists) + 1, dtype=np.int32) * np.int32(dimension)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))


class HashedTokens:
    """Token counts hashed to a fixed number of slots, unit length.

    Deterministic, needs no fitting and no model file. A text without tokens becomes the
    zero vector. Spark cuts the texts; tasks hash and count by batches.
    """

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        dimension = self.dimension

        @F.arrow_udf("array<float>")
        def counted(lists: pa.Array) -> pa.Array:
            return _unit_counts(lists, dimension)

        return df.select(*df.columns, counted(tokens(F.col(text))).alias(output))


class BatchEncoder:
    """Wraps a model: ``load`` runs once per Python worker and returns ``encode(texts)``.

    Texts reach the model in batches; rows are scaled to unit length as float32.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = BATCH):
        self.load, self.batch = load, batch

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        load, size = self.load, self.batch

        @F.pandas_udf("array<float>")
        def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for part in parts:
                texts = part.fillna("").tolist()
                rows: list = []
                for at in range(0, len(texts), size):
                    block = np.asarray(model(texts[at : at + size]), dtype="float64")
                    length = np.linalg.norm(block, axis=1, keepdims=True)
                    rows.extend((block / np.where(length > 0, length, 1.0)).astype("float32"))
                yield pd.Series(rows)

        return df.withColumn(output, encode(F.col(text)))


def vector_check(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: vectors, dimensions, whether they agree, largest deviation from length one."""
    from larkspur.functions.vectors import norm

    out = df.agg(
        F.count(vector).alias("vectors"),
        F.min(F.size(vector)).alias("min_dimension"),
        F.max(F.size(vector)).alias("max_dimension"),
        F.max(F.abs(norm(F.col(vector)) - 1)).alias("norm_error"),
    )
    return out.withColumn("uniform", F.col("min_dimension") == F.col("max_dimension"))


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
