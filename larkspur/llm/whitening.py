"""Whitening of embeddings on the leading eigenvectors of their covariance.

Entries become integers (``floor(SCALE * c) + SHIFT``). One job sums them exactly, a second one
sums the products of the centred entries, a third checks the covariance of the result, and the
last one writes it. Tasks reduce their rows to sums before anything is shuffled; the driver sees
only statistics whose size is given by the vectors' width (``width`` sums, ``width ** 2``
products). The eigenvectors come from ``feast``.

Entries are centred on the rounded mean, which keeps them exact, and the mean's fraction is
taken off afterwards.

Defined cases: vectors that are missing or hold a missing or non-finite entry are dropped, as
are entries of ``LARGEST`` or more in size (their integer no double holds) and vectors of another
width than the commonest one (of equally common ones the widest); rows that repeat count as
often as they are there; components without variance (at most ``FLAT`` of the trace) are left
out, so one vector, or copies of one, give no rows; a deviation that no long holds is NULL; an
empty table gives no rows. Extra columns are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from larkspur.llm.feast import eigenpairs

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(2**43)
FLAT = 1e-13
#: Entries that a task works on at once.
BATCH_ENTRIES = 1 << 20
_HALF = 26

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Fit:
    """What tasks need to whiten: exact sums, and the components found."""

    width: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def middle(self) -> np.ndarray:
        """The mean, rounded to integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the rounded mean lacks."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]

    @property
    def fraction(self) -> np.ndarray:
        return np.array([r / self.n for r in self.rest])


def _integers(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their integer entries."""
    of_width = pc.fill_null(pc.equal(pc.list_value_length(vectors), width), False)
    rows = np.flatnonzero(of_width.to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(vectors.take(pa.array(rows))).cast(pa.float64())
    entries = flat.to_numpy(zero_copy_only=False).reshape(len(rows), width)  # missing ones are NaN
    good = (np.abs(entries) < LARGEST).all(axis=1)
    return rows[good], np.floor(SCALE * entries[good]).astype(np.int64) + SHIFT


def _pieces(batches: Batches, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    step = max(1, BATCH_ENTRIES // width)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            piece = batch.slice(start, step)
            yield (piece, *_integers(piece.column("embedding"), width))


def _long_form(name: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=name.split())


def _summed(width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        n, high, low = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for _, _, x in _pieces(batches, width):
            n += len(x)
            high += (x >> _HALF).sum(axis=0)
            low += (x & (1 << _HALF) - 1).sum(axis=0)
        yield _long_form("place n high low", np.arange(width), np.full(width, n), high, low)

    return run


def _products(width: int, of: Callable[[np.ndarray], np.ndarray]) -> Callable[[Batches], Batches]:
    """Sums of the products of the columns of ``of(x)``, and of those columns, as (place, total)."""

    def run(batches: Batches) -> Batches:
        total = None
        for _, _, x in _pieces(batches, width):
            own = of(x)
            own = np.column_stack([own, np.ones(len(own))])
            total = own.T @ own if total is None else total + own.T @ own
        if total is not None:
            yield _long_form("place total", np.arange(total.size), total.ravel())

    return run


def _square(vectors: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of products, sums) over all rows; ``(columns + 1) ** 2`` numbers reach the driver."""
    parts = vectors.mapInArrow(_products(width, of), "place long, total double")
    total = np.zeros((columns + 1) ** 2)
    for row in parts.groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    total = total.reshape(columns + 1, columns + 1)
    return total[:-1, :-1], total[:-1, -1]


def commonest_width(vectors: DataFrame) -> int:
    """Width of most of the vectors that can take part; 0 if there are none."""
    entries = F.col("embedding").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | ~(F.abs(c) < LARGEST) | F.isnan(c))
    sizes = vectors.where(entries.isNotNull() & ~bad & (F.size(entries) > 0)).groupBy(F.size(entries).alias("width")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Exact sums and leading components of all rows that take part; None without any."""
    vectors = vectors.select("embedding")
    width = commonest_width(vectors)
    if not width:
        return None
    parts = vectors.mapInArrow(_summed(width), "place long, n long, high long, low long").groupBy("place")
    sums = sorted(parts.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    n = sums[0]["n"]
    plain = Fit(width, n, tuple((r["high"] << _HALF) + r["low"] for r in sums), np.zeros(0), np.zeros((width, 0)), 0.0)
    middle, fraction = plain.middle, plain.fraction
    products, _ = _square(vectors, width, lambda x: (x - middle).astype(float), width)
    covariance = products / n - np.outer(fraction, fraction)
    trace = float(np.trace(covariance))
    values, found = eigenpairs((covariance + covariance.T) / 2, components)
    kept = values > FLAT * trace
    return Fit(width, n, plain.sums, values[kept], found[:, kept], trace)


def whitened(x: np.ndarray, model: Fit) -> np.ndarray:
    """Rows of integers on the components, each with variance one."""
    return ((x - model.middle) - model.fraction) @ model.vectors / np.sqrt(model.values)


def identity_error(vectors: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    k = len(model.values)
    products, sums = _square(vectors.select("embedding"), model.width, lambda x: whitened(x, model), k)
    mean = sums / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, model: Fit) -> pa.Array:
    """Per row the sum over dimensions of (n * x - S) ** 2, exactly; NULL if no long holds it."""
    y = x - model.middle
    largest = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, model.rest), default=0)
    if largest**2 * model.width < 2**63:
        z = model.n * y - np.array(model.rest, dtype=np.int64)
        return pa.array((z * z).sum(axis=1), pa.int64())
    exact = ((model.n * y.astype(object) - np.array(model.rest, dtype=object)) ** 2).sum(axis=1)
    return pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, model: Fit | None, key: str = "vec_id") -> DataFrame:
    """key, component, n, deviation, whitened and explained, a row per vector and component."""
    schema = StructType([
        vectors.schema[key], StructField("component", IntegerType()), StructField("n", LongType()),
        StructField("deviation", LongType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
    ])
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def run(batches: Batches) -> Batches:
        for piece, rows, x in _pieces(batches, model.width):
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(key).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, model.n, dtype=np.int64)),
                    deviations(x, model).take(each),
                    pa.array(whitened(x, model).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(rows))),
                ],
                names=schema.names,
            )

    return vectors.select(key, "embedding").mapInArrow(run, schema)


def report(vectors: DataFrame) -> DataFrame:
    """The rows of ``whiten`` with the error of their covariance."""
    model = fit(vectors)
    error = identity_error(vectors, model) if model else 0.0
    return whiten(vectors, model).withColumn("identity_error", F.lit(error))
