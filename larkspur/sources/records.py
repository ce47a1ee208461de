"""Records of delimited files that run over several lines, put together from splits read in parallel.

A line break inside a quoted field belongs to the record. Whether a line starts inside of one
depends on all lines before it, but only through one bit, and a line without a quote never
changes it. So every split is followed from both values of the bit, over its lines with quotes
alone; the splits' outcomes, four kinds of functions of one bit, are put together per file by
window functions over one small row per split, and each split then knows how it starts.

Where no line at all ends inside quotes, lines are the records and nothing more is done.
Otherwise the splits are read again, each from its known start. A record within a split is put
together in its task. What a split cannot finish, its first and last piece at most, meets the
other pieces by the split in which their record starts.

A quote opens a field only at its start, two quotes inside of one are one, and what follows a
closing quote belongs to the field. A quote that is never closed takes the rest of its file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larkspur.operators.bounds import local_copy
from larkspur.session import durable

QUOTE = '"'
SPLIT = ["file", "block"]
Batches = Iterator[pa.RecordBatch]


def ends_open(line: str, separator: str, opened: bool) -> bool:
    """Whether a line ends inside quotes, given how it starts."""
    at = 0
    while True:
        if opened:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            opened = False
        elif line.startswith(QUOTE, at):
            opened, at = True, at + 1
            continue
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The parts of a batch that come from one split each."""
    keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
    start = 0
    for at in range(1, len(keys) + 1):
        if at == len(keys) or keys[at] != keys[start]:
            yield keys[start], batch.slice(start, at - start)
            start = at


def _outcomes(batches: Batches) -> Batches:
    """Per split and assumed start: how it ends, whether a line starts outside quotes, whether one ends inside."""
    found: dict[tuple, list[list[bool]]] = {}
    for batch in batches:
        for key, run in _runs(batch):
            sides = found.setdefault(key, [[False, False, False], [True, False, False]])
            for line, separator in zip(run.column("value").to_pylist(), run.column("separator").to_pylist()):
                for side in sides:
                    side[1] |= not side[0]
                    side[0] = ends_open(line, separator, side[0])
                    side[2] |= side[0]
    rows = [(*key, *sides[0], *sides[1]) for key, sides in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*SPLIT, "end0", "starts0", "open0", "end1", "starts1", "open1"])


def with_start_bit(splits: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Add ``opened``: the bit at the start of each split, false at first.

    ``end0`` and ``end1`` tell the bit at a split's end for either start. A split sets the bit,
    turns it, or keeps it (so do splits without an outcome). So the bit is the one last set
    before, turned as often as splits since then turn it.
    """
    ordered = Window.partitionBy(*groups).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.count_if(F.col("end0") & ~F.col("end1")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    counted = splits.withColumn("_turned", turned)
    sets = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("bit"), F.col("_turned").alias("turned")))
    known = counted.select("*", F.last(sets, ignorenulls=True).over(before).alias("_set"), F.lag("_turned", 1, 0).over(ordered).alias("_upto"))
    odd = (F.col("_upto") - F.coalesce("_set.turned", F.lit(0))) % 2 == 1
    return known.withColumn("opened", F.coalesce("_set.bit", F.lit(False)) != odd).drop("_turned", "_set", "_upto")


def split_states(lines: DataFrame) -> DataFrame | None:
    """Per split: whether it starts inside quotes, and the split in which that record starts; None if no line ends inside.

    ``lines`` has file, block, value and separator.
    """
    quoted = lines.where(F.col("value").contains(QUOTE)).select(*SPLIT, "value", "separator")
    schema = "file string, block long, end0 boolean, starts0 boolean, open0 boolean, end1 boolean, starts1 boolean, open1 boolean"
    # A split may be packed with others, but is never divided, so each has one row.
    outcomes = durable(quoted.mapInArrow(_outcomes, schema))
    if outcomes.where("open0").isEmpty():
        return None  # every split starts outside quotes, and no line ends inside
    every = lines.select(*SPLIT).distinct().join(outcomes, SPLIT, "left")
    known = with_start_bit(every, ["file"], ["block"])
    starts = F.when(F.col("opened"), F.coalesce("starts1", F.lit(False))).otherwise(True)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return known.select(*SPLIT, "opened", F.last(F.when(starts, F.col("block")), ignorenulls=True).over(before).alias("owner"))


def _record_schema(row_id: str, lines: DataFrame) -> StructType:
    return StructType([
        StructField("file", StringType()), lines.schema[row_id], StructField("value", StringType()), StructField("owner", LongType()),
    ])


def _pieces(row_id: str, names: list[str]):
    """Records of each split; pieces of records that other splits have a part of carry their ``owner``."""

    def run(batches: Batches) -> Batches:
        key, opened = None, False
        held: list[str] = []  # lines of the record at hand
        held_at = anchor = None  # where it starts; its split, if that is an earlier one

        def row(file, at, lines, piece):
            values = [pa.array([file]), at, pa.array(["\n".join(lines)], pa.string()), pa.array([piece], pa.int64())]
            return pa.RecordBatch.from_arrays(values, names=names)

        for batch in batches:
            for this, part in _runs(batch):
                if this != key:
                    if held:  # open at the split's end
                        yield row(key[0], held_at, held, key[1] if anchor is None else anchor)
                    key, held, opened = this, [], part.column("opened")[0].as_py()
                    anchor = part.column("owner")[0].as_py() if opened else None
                values, places = part.column("value"), part.column(row_id)
                quoted = np.flatnonzero(pc.fill_null(pc.match_substring(values, QUOTE), False).to_numpy(zero_copy_only=False))
                starts = np.empty(part.num_rows + 1, dtype=bool)  # whether each line, and the next batch's first one, starts a record
                separators = part.column("separator")
                at = 0
                for q in quoted.tolist():
                    starts[at : q + 1] = not opened
                    opened = ends_open(values[q].as_py(), separators[q].as_py(), opened)
                    at = q + 1
                starts[at:] = not opened
                single = np.flatnonzero(starts[:-1] & starts[1:])
                if len(single):
                    taken = pa.array(single)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("file").take(taken), places.take(taken), values.take(taken), pa.nulls(len(single), pa.int64())], names=names)
                for i in np.flatnonzero(~(starts[:-1] & starts[1:])).tolist():
                    if starts[i]:
                        held, anchor = [], None
                    if not held:
                        held_at = places.slice(i, 1)
                    held.append(values[i].as_py())
                    if starts[i + 1]:
                        yield row(key[0], held_at, held, anchor)
                        held, anchor = [], None
        if held:
            yield row(key[0], held_at, held, key[1] if anchor is None else anchor)

    return run


def whole_records(lines: DataFrame, row_id: str) -> DataFrame | None:
    """file, ``row_id``, value: the records of ``lines`` (file, block, ``row_id``, value, separator), line breaks kept.

    None if every line is a record. The lines of a split must come from one task in order, as
    a text scan gives them; ``row_id`` must order them and becomes that of a record's first line.
    """
    states = split_states(lines)
    if states is None:
        return None
    states = durable(states)
    wanted = [*SPLIT, row_id, "value", "separator", "opened", "owner"]
    small = local_copy(states)
    if small is not None:
        told = lines.join(F.broadcast(small), SPLIT).select(*wanted)  # keeps the order of the scan
    else:
        told = lines.join(states, SPLIT).select(*wanted).repartition(*SPLIT).sortWithinPartitions(*SPLIT, row_id)
    schema = _record_schema(row_id, lines)
    pieces = told.mapInArrow(_pieces(row_id, schema.names), schema)
    whole = pieces.where("owner is null").drop("owner")
    parts = pieces.where("owner is not null").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct(row_id, "value"))).alias("parts"))
    joined = parts.select(
        "file", F.element_at("parts", 1)[row_id].alias(row_id), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")
    )
    return whole.unionByName(joined)


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
