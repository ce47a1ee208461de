"""Exact top-k inner-product search."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOP_K = 5
MIN_SIMILARITY = 0.35

QUERY_ROWS = 10_000  # query vectors the driver reads at most
QUERY_VALUES = 4_000_000  # numbers in a broadcast query matrix: 32 MB of doubles
CORPUS_BLOCK = 50_000  # vectors of one corpus block in the grid form
TILE_CELLS = 16_000_000  # scores held at once: 128 MB of doubles, whatever the width


def _matrix(column: pa.Array, dimension: int | None = None) -> np.ndarray:
    """Arrow list column to a 2-D double matrix; all rows must have one dimension."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    widths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(widths) > 1 or (dimension is not None and len(widths) and widths[0] != dimension):
        raise ValueError(f"vectors of different dimensions: {widths.tolist()}, expected {dimension}")
    width = int(widths[0]) if len(widths) else 0
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return values.reshape(len(column), width)


def _best(scores: np.ndarray, ids: np.ndarray, k: int, floor: float) -> Iterator[tuple[int, np.ndarray]]:
    """Per query column, row numbers of the k best scores; the smaller id wins ties."""
    for q in range(scores.shape[1]):
        column = scores[:, q]
        rows = np.flatnonzero(column >= floor)
        if len(rows) > k:
            edge = np.partition(column[rows], len(rows) - k)[len(rows) - k]
            rows = rows[column[rows] >= edge]
        if len(rows):
            yield q, rows[np.lexsort((ids[rows], -column[rows]))[:k]]


def search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    floor: float = MIN_SIMILARITY,
    query_id: str = "query_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    within: str | None = None,
    carry: list[str] = (),
    query_values: int = QUERY_VALUES,
) -> DataFrame:
    """(query_id, [within], chunk_id, [carry], similarity_score, rank): the k best per query.

    Scores are inner products in double precision; scores below ``floor`` are dropped,
    ties go to the smaller chunk id. ``within`` ranks separately per value of a corpus
    column, ``carry`` takes further corpus columns along. Each task keeps its own k best
    per query, so what is shuffled is at most k rows per query and task, and pairs are
    never rows. At most ``TILE_CELLS`` scores are held at once.

    Query vectors are broadcast as one matrix if there are at most ``QUERY_ROWS`` of them
    and their numbers are within ``query_values``. More queries are met in a grid: blocks of queries against blocks
    of the corpus, each pair of blocks in one task, every pair of vectors exactly once.
    """
    kept = [*([within] if within else []), chunk_id, *carry]
    wanted = queries.where(F.col(vector).isNotNull()).select(F.col(query_id), F.col(vector))
    stored = corpus.select(*kept, F.col(vector))  # rows without a vector are left out by the tasks: a filter would make it twice
    schema = T.StructType(
        [queries.schema[query_id]]
        + [corpus.schema[c] for c in kept]
        + [T.StructField("similarity_score", T.DoubleType())]
    )
    size = wanted.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).first()
    width = size["width"] or 0
    if size["n"] <= QUERY_ROWS and size["n"] * width <= query_values:  # measured before it is read
        table = wanted.toArrow()
        found = _against_matrix(table, stored, k, floor, query_id, chunk_id, vector, within, kept, schema)
    else:
        blocks = math.ceil(size["n"] / max(1, query_values // max(1, width)))
        found = _against_grid(wanted, stored, k, floor, query_id, chunk_id, vector, within, kept, schema, blocks)
    groups = [within] if within else []
    order = Window.partitionBy(query_id, *groups).orderBy(F.desc("similarity_score"), chunk_id)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top(asked: np.ndarray, kinds: np.ndarray | None, ids: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries per query and kind; the smaller id wins ties."""
    kind = np.zeros(len(asked), "int64") if kinds is None else np.unique(kinds, return_inverse=True)[1]
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], -values, kind, asked))
    first = np.ones(len(order), bool)
    first[1:] = (asked[order][1:] != asked[order][:-1]) | (kind[order][1:] != kind[order][:-1])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]


def _block_best(rows, ids, kinds, matrix, k, floor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query numbers, row numbers, scores) of the k best rows per query and kind, tile by tile."""
    asked, at, values = [np.zeros(0, "int64")], [np.zeros(0, "int64")], [np.zeros(0)]
    step = max(1, TILE_CELLS // max(1, len(matrix)))
    for start in range(0, len(ids), step):
        scores = rows[start : start + step] @ matrix.T
        own = None if kinds is None else kinds[start : start + step]
        for kind in [None] if kinds is None else np.unique(own):
            some = np.arange(len(scores)) if kinds is None else np.flatnonzero(own == kind)
            for q, best in _best(scores[some], ids[start + some], k, floor):
                asked.append(np.full(len(best), q))
                at.append(start + some[best])
                values.append(scores[some[best], q])
    asked, at, values = np.concatenate(asked), np.concatenate(at), np.concatenate(values)
    kept = _top(asked, None if kinds is None else kinds[at], ids[at], values, k)
    return asked[kept], at[kept], values[kept]


def _against_matrix(table, stored, k, floor, query_id, chunk_id, vector, within, kept, schema) -> DataFrame:
    names = table.column(query_id).combine_chunks()
    matrix = _matrix(table.column(vector)) if len(names) else np.zeros((0, 0))
    shared = stored.sparkSession.sparkContext.broadcast((names, matrix))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of a task: what is sent on does not grow with its batches."""
        names, matrix = shared.value
        held = None
        for batch in batches:
            if batch.column(vector).null_count:
                batch = batch.filter(batch.column(vector).is_valid())
            if not len(names) or not batch.num_rows:
                continue
            columns = {name: batch.column(batch.schema.get_field_index(name)) for name in [*kept, vector]}
            kinds = columns[within].to_numpy(zero_copy_only=False) if within else None
            ids = columns[chunk_id].to_numpy(zero_copy_only=False)
            rows = _matrix(columns[vector], matrix.shape[1])
            asked, at, values = _block_best(rows, ids, kinds, matrix, k, floor)
            arrays = [pa.array(asked), *[columns[c].take(pa.array(at)) for c in kept], pa.array(values)]
            found = pa.table(arrays, names=["_asked", *kept, "similarity_score"])
            held = found if held is None else pa.concat_tables([held, found])
            kinds = held.column(within).to_numpy() if within else None
            places = _top(held.column("_asked").to_numpy(), kinds, held.column(chunk_id).to_numpy(), held.column("similarity_score").to_numpy(), k)
            held = held.take(pa.array(places))
        if held is not None:
            asked = names.take(held.column("_asked").combine_chunks())
            out = pa.table([asked, *[held.column(c) for c in kept], held.column("similarity_score")], names=[query_id, *kept, "similarity_score"])
            yield from out.combine_chunks().to_batches()

    return stored.mapInArrow(best, schema)


def _numbers(n: int) -> Column:
    """0 to n - 1 as an array of longs."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _against_grid(wanted, stored, k, floor, query_id, chunk_id, vector, within, kept, schema, query_blocks) -> DataFrame:
    stored = stored.where(F.col(vector).isNotNull())
    corpus_blocks = max(1, math.ceil(stored.count() / CORPUS_BLOCK))
    left = wanted.withColumn("_q", F.pmod(F.xxhash64(query_id), F.lit(query_blocks)))
    left = left.withColumn("_c", F.explode(_numbers(corpus_blocks)))
    right = stored.withColumn("_c", F.pmod(F.xxhash64(chunk_id), F.lit(corpus_blocks)))
    right = right.withColumn("_q", F.explode(_numbers(query_blocks)))

    def best(some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(block):
            return pd.DataFrame({f.name: [] for f in schema})
        kinds = block[within].to_numpy() if within else None
        rows, matrix = np.stack(block[vector]).astype("float64"), np.stack(some[vector]).astype("float64")
        asked, at, values = _block_best(rows, block[chunk_id].to_numpy(), kinds, matrix, k, floor)
        out = block[kept].iloc[at].reset_index(drop=True)
        out.insert(0, query_id, some[query_id].to_numpy()[asked])
        out["similarity_score"] = values
        return out

    return left.groupBy("_q", "_c").cogroup(right.groupBy("_q", "_c")).applyInPandas(best, schema)


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
