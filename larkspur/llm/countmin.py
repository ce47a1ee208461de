"""A count-min sketch that is built in partitions, merged by slice, and saturates at two.

The width follows the number of entries up to ``2 ** MAX_BITS`` slots, so what is collected
and broadcast is at most ``ROWS * 2 ** MAX_BITS / 8`` bytes (128 MB). The sketch only
overestimates: an entry that it calls single is single.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 2
MIN_BITS = 16
MAX_BITS = 29
SLICE_BITS = 22
#: Rows of the sketch from here on hold plain counts, which are added up.
COUNTS = 100

RECORD = "row int, part int, slots binary"


def width_bits(entries: int) -> int:
    """log2 of the number of slots for so many entries."""
    return min(max(int(entries).bit_length() + 1, MIN_BITS), MAX_BITS)


def slots(prints: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of (n, ROWS) 64-bit hashes."""
    return [(prints[:, i] >> np.uint64(64 - bits)).astype(np.int64) for i in range(ROWS)]


def squeezed(numbers: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed; sorted or small numbers leave little."""
    import zstandard

    planes = np.ascontiguousarray(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def restored(blob: bytes, kind: str) -> np.ndarray:
    """The numbers that ``squeezed`` was given."""
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(blob)), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Borders of the runs of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]))


def partial(prints: np.ndarray, bits: int) -> list[dict]:
    """Records of a part of the entries: sorted slots per row of the sketch and slice."""
    out = []
    for row, found in enumerate(slots(prints, bits)):
        found = np.sort(found)
        third = np.zeros(len(found), bool)  # two of a kind say all: the sketch saturates there
        third[2:] = found[2:] == found[:-2]
        found = found[~third]
        for begin, end in runs(found >> SLICE_BITS):
            part = int(found[begin] >> SLICE_BITS)
            gaps = np.diff(found[begin:end] - (part << SLICE_BITS), prepend=np.int64(0)).astype("<u4")
            out.append({"row": row, "part": part, "slots": squeezed(gaps)})
    return out


def record_batch(records: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(records, pa.schema([("row", pa.int32()), ("part", pa.int32()), ("slots", pa.binary())]))


def _merged(bits: int):
    """Bitmaps and sums from records sorted by (row, part); one slice is open at a time."""
    width = 1 << min(bits, SLICE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, once, twice, sums = None, None, None, None

        def closed() -> pa.RecordBatch:
            blob = squeezed(sums) if key[0] >= COUNTS else squeezed(np.packbits(twice))
            return record_batch([{"row": key[0], "part": key[1], "slots": blob}])

        for batch in batches:
            for row, part, blob in zip(batch.column("row").to_pylist(), batch.column("part").to_pylist(), batch.column("slots")):
                if key != (row, part):
                    if key is not None:
                        yield closed()
                    key, sums = (row, part), None
                    if row < COUNTS:
                        once, twice = np.zeros(width, bool), np.zeros(width, bool)
                if row >= COUNTS:
                    counts = restored(blob.as_py(), "<u8")
                    sums = counts if sums is None else sums + counts
                    continue
                found = np.cumsum(restored(blob.as_py(), "<u4").astype(np.int64))
                twice[found[1:][found[1:] == found[:-1]]] = True
                twice[found[once[found]]] = True
                once[found] = True
        if key is not None:
            yield closed()

    return run


def collected(records: DataFrame, bits: int) -> tuple[list[bytes], dict[int, np.ndarray]]:
    """One bitmap per row of the sketch, slots seen twice or more; and the sums by part."""
    merged = records.repartition("row", "part").sortWithinPartitions("row", "part").mapInArrow(_merged(bits), RECORD)
    size = (1 << min(bits, SLICE_BITS)) // 8
    bitmaps, sums = [bytearray((1 << bits) // 8) for _ in range(ROWS)], {}
    for row, part, blob in merged.collect():  # bounded by MAX_BITS
        if row >= COUNTS:
            sums[part] = restored(blob, "<u8")
        else:
            bitmaps[row][part * size : (part + 1) * size] = restored(blob, "u1").tobytes()
    return [bytes(b) for b in bitmaps], sums


def seen_twice(prints: np.ndarray, bits: int, bitmaps: list[bytes]) -> np.ndarray:
    """May the entry occur twice or more?"""
    maybe = np.ones(len(prints), bool)
    for found, bitmap in zip(slots(prints, bits), bitmaps):
        bytes_ = np.frombuffer(bitmap, dtype=np.uint8)
        maybe &= (bytes_[found >> 3] >> (7 - (found & 7)).astype(np.uint8)) & 1 == 1
    return maybe
