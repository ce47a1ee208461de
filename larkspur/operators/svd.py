"""A trained text encoder: leading singular vectors of the weighted token-document matrix.

Tokens are hashed to slots, so the matrix has a bounded number of columns, one row per text.
Randomised block power iteration finds its leading right singular vectors: each round is one
pass of the tasks over the texts' slots, which multiplies a broadcast block of vectors by the
matrix and its transpose. Tasks add up their rows before they send anything, and partial sums
meet in two levels by blocks of slots. The driver holds blocks of (slots x vectors) only, and
makes them orthogonal.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.embed import BatchEncoder
from larkspur.session import stored

SLOTS = 1 << 14
RANK = 128
EXTRA = 8  # vectors beyond the rank, which make the leading ones sharper
ROUNDS = 5
BLOCK = 256  # slots of one partial sum
ENTRIES = 1 << 13  # entries of the matrix that a task works on at once
ENCODED = 256  # texts that are encoded at once
MEMO_TOKENS = 1 << 18
MERGERS = 16

_TOKEN = regex.compile(r"[\p{L}\p{N}]+")
Batches = Iterator[pa.RecordBatch]


class _Slots(dict):
    """Slots of tokens, as many as a task keeps in memory."""

    def __init__(self, slots: int):
        super().__init__()
        self.slots = slots

    def __missing__(self, token: str) -> int:
        value = int.from_bytes(hashlib.md5(token.encode("utf-8", "surrogatepass")).digest()[:4], "big") % self.slots
        if len(self) >= MEMO_TOKENS:
            self.clear()
        self[token] = value
        return value


_MEMO: dict[int, _Slots] = {}


def slots_of(text: str | None, slots: int) -> list[int]:
    memo = _MEMO.get(slots) or _MEMO.setdefault(slots, _Slots(slots))
    return list(map(memo.__getitem__, _TOKEN.findall((text or "").lower())))


def _counted(lists: list[list[int]], slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, count) of the distinct slots of some texts, in this order."""
    sizes = [len(own) for own in lists]
    flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=sum(sizes))
    pairs, n = np.unique(np.repeat(np.arange(len(lists)), sizes) * slots + flat, return_counts=True)
    return pairs // slots, pairs % slots, n


def _weights(row: np.ndarray, slot: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The values of the matrix: damped counts by rarity, rows of unit length."""
    value = (1 + np.log(n)) * idf[slot]
    return value / np.sqrt(np.bincount(row, weights=value**2))[row]


def _sums(value: np.ndarray, matrix: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``value`` times the rows ``at`` of a matrix, over the runs that begin at ``starts``."""
    products = matrix.take(at, axis=0)
    products *= value[:, None]
    return np.add.reduceat(products, starts)


def _applied(shared, slots: int) -> Callable[[Batches], Batches]:
    """Partial sums of A' A Q over the texts of a task, in blocks of slots."""

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        idf, block = shared.value
        total, touched = np.zeros_like(block), np.zeros(-(-slots // BLOCK), dtype=bool)
        for batch in batches:
            sizes = batch.column("slots").value_lengths().to_numpy()
            slot, n = (batch.column(name).flatten().to_numpy() for name in ("slots", "counts"))
            row, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum([0, *sizes])
            value = _weights(row, slot, n, idf)
            begin = 0
            while begin < len(sizes):
                stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + ENTRIES, side="right")) - 1)
                some = slice(ends[begin], ends[stop])
                images = _sums(value[some], block, slot[some], ends[begin:stop] - ends[begin])  # no text is without slots
                order = np.argsort(slot[some], kind="stable")
                own = slot[some][order]
                firsts = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[firsts]] += _sums(value[some][order], images, row[some][order] - begin, firsts)
                touched[own[firsts] // BLOCK] = True
                begin = stop
        part = TaskContext.get().partitionId() % MERGERS
        for i in np.flatnonzero(touched).tolist():
            own = np.ascontiguousarray(total[i * BLOCK : (i + 1) * BLOCK]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([own], pa.binary())], names=["block", "part", "sums"])

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["sums"].iat[0]) // 8)
    for own in rows["sums"]:
        total += np.frombuffer(own)
    return pd.DataFrame({"block": [rows["block"].iat[0]], "part": [0], "sums": [total.tobytes()]})


def _product(texts: DataFrame, idf: np.ndarray, block: np.ndarray) -> np.ndarray:
    schema = "block int, part int, sums binary"
    shared = texts.sparkSession.sparkContext.broadcast((idf, block))
    parts = texts.mapInArrow(_applied(shared, len(idf)), schema)
    parts = parts.groupBy("block", "part").applyInPandas(_added, schema).groupBy("block").applyInPandas(_added, schema)
    out = np.zeros_like(block)
    for row in parts.collect():  # at most slots / BLOCK rows
        own = np.frombuffer(row["sums"]).reshape(-1, block.shape[1])
        out[row["block"] * BLOCK : row["block"] * BLOCK + len(own)] = own
    shared.destroy()
    return out


@dataclass(frozen=True)
class TokenSvd:
    """Rarity weights and the leading right singular vectors (slots x rank) with their values."""

    idf: np.ndarray
    vectors: np.ndarray
    values: np.ndarray

    def encoder(self) -> BatchEncoder:
        """An embedder: texts projected on the vectors, unit length; the zero vector without tokens."""
        idf, vectors = self.idf, self.vectors

        def encode(texts: list[str]) -> np.ndarray:
            row, slot, n = _counted([slots_of(t, len(idf)) for t in texts], len(idf))
            out = np.zeros((len(texts), vectors.shape[1]))
            if len(row):
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                out[row[starts]] = _sums(_weights(row, slot, n, idf), vectors, slot, starts)
            return out

        return BatchEncoder(lambda: encode, ENCODED)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, float(w), v) for i, (w, v) in enumerate(zip(self.idf, self.vectors.tolist()))]
        spark.createDataFrame(rows, "slot int, idf double, vector array<double>").write.mode("overwrite").parquet(f"{path}/slots")
        values = spark.createDataFrame([(self.values.tolist(),)], "singular array<double>")
        values.write.mode("overwrite").parquet(f"{path}/values")


def load(spark: SparkSession, path: str) -> TokenSvd:
    rows = sorted(spark.read.parquet(f"{path}/slots").collect())  # a row per slot
    values = spark.read.parquet(f"{path}/values").first()["singular"]
    return TokenSvd(np.array([r["idf"] for r in rows]), np.array([r["vector"] for r in rows]), np.array(values))


def fit(texts: DataFrame, text: str = "text", rank: int = RANK, slots: int = SLOTS, rounds: int = ROUNDS, seed: int = 1) -> TokenSvd:
    """Train on all texts. Missing texts and texts without tokens have no part in it."""

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            lists = [own for own in (slots_of(t, slots) for t in batch.column(0).to_pylist()) if own]
            row, slot, n = _counted(lists, slots)
            ends = np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(own.astype(np.int32))) for own in (slot, n)]
            yield pa.RecordBatch.from_arrays(columns, names=["slots", "counts"])

    held = stored(texts.select(text).mapInArrow(cut, "slots array<int>, counts array<int>"), "slots")
    n = held.count()
    seen = held.select(F.explode_outer("slots").alias("slot")).groupBy("slot").count().collect()  # at most a row per slot
    df = np.zeros(slots)
    df[[r["slot"] for r in seen]] = [r["count"] for r in seen]
    idf = np.log((1 + n) / (1 + df)) + 1
    width = min(rank + EXTRA, slots)
    block, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((slots, width)))
    for _ in range(rounds):
        block, _ = np.linalg.qr(_product(held, idf, block))
    image = _product(held, idf, block)
    squares, turns = np.linalg.eigh(block.T @ image)
    order = np.argsort(-squares)[:rank]
    return TokenSvd(idf, block @ turns[:, order], np.sqrt(np.maximum(squares[order], 0)))


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
