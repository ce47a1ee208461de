"""Removal of passages that repeat across documents, behind a count-min prefilter.

A window is ``WINDOW`` consecutive words. A window is a repeat where its word sequence also
starts in a document with a smaller id, and all its words go.

1. Every task counts its windows, once per document, in a sketch: the slots of each window's
   hash, saturating at two. The partial sketches, sparse and cut into slices, are merged by
   slice; what is left is one bit per slot: seen in two documents or more.
2. Windows whose every slot is set may repeat. The sketch only overestimates, so no repeat is
   lost. Only these are grouped, exactly, by their 128-bit fingerprint. A task answers itself
   for all but the smallest id it has of a fingerprint, so a passage that a third of all
   documents hold sends one document per piece of work, not a group of that size.
3. The places of repeats go back to the piece they came from, become spans of words per
   document, and a join by id and text hash cuts the documents.

The sketch (see ``countmin``) grows with the number of windows up to a fixed width; beyond that
it lets more windows through, which costs shuffle but changes no result.

Defined cases: a missing or empty text has no words and an empty rest; a document without an
id never repeats another and no document repeats it; rows with equal ids are one document
for the comparison and are cut alike; documents under a window's length are kept whole; an
empty table gives no rows. Extra columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larkspur.llm.countmin import RECORD, collected, partial, record_batch, restored, runs, seen_twice, squeezed, width_bits
from larkspur.llm.text import WORD, as_bytes

WINDOW = 50
MEMO_WORDS = 1 << 17
BATCH_WORDS = 1 << 19
SLICE_WINDOWS = 1 << 21

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Two 64-bit hashes per word; ``MEMO_WORDS`` bounds the look-up table only."""

    def __missing__(self, word: bytes) -> bytes:
        value = xxhash.xxh3_128_digest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


def _rolled(values: np.ndarray, window: int, multiplier: int) -> np.ndarray:
    """Polynomial hash of every run of ``window`` values, by doubling the run length."""
    n = len(values) - window + 1
    total, done, power = np.zeros(n, dtype=np.uint64), 0, 1
    part, length = values, 1
    while True:
        if window & length:
            total = total + np.uint64(power) * part[done : done + n]
            done += length
            power = pow(multiplier, done, 1 << 64)
        if done == window:
            break
        part = part[:-length] + np.uint64(pow(multiplier, length, 1 << 64)) * part[length:]
        length *= 2
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


class Piece:
    """Some whole documents of a task: their rows and the fingerprints of their windows."""

    def __init__(self, ids: list[int], ties: list[int], digests: list[bytes], window: int):
        self.ids, self.ties = np.array(ids, dtype=np.int64), np.array(ties, dtype=np.int64)
        values = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
        counts = np.array([len(d) // 16 for d in digests], dtype=np.int64)
        starts = np.cumsum(counts) - counts
        windows = np.maximum(counts - window + 1, 0)
        self.row = np.repeat(np.arange(len(ids)), windows)
        self.place = np.arange(len(self.row)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = starts[self.row] + self.place
        self.prints = np.zeros((len(at), 2), dtype=np.uint64)
        if len(at):
            for i, multiplier in enumerate(_MULTIPLIERS):
                self.prints[:, i] = _rolled(values[:, i], window, multiplier)[at]
        self.doc = self.ids[self.row]


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[Piece]:
    """Whole documents in pieces of a bounded number of words; a longer one stands alone."""
    hashes = WordHashes()
    ids, ties, digests, size = [], [], [], 0
    for batch in batches:
        columns = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), batch.column("text")
        for doc_id, tie, text in zip(*columns):
            found = as_bytes(text.as_py()).split()
            if len(found) < window:
                continue
            ids.append(doc_id)
            ties.append(tie)
            digests.append(b"".join(map(hashes.__getitem__, found)))
            size += len(found)
            if size >= BATCH_WORDS:
                yield Piece(ids, ties, digests, window)
                ids, ties, digests, size = [], [], [], 0
    if ids:
        yield Piece(ids, ties, digests, window)


def _partial_sketch(bits: int, window: int):
    """Slots of the distinct (window, document) pairs, per row of the sketch and slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, window):
            order = np.lexsort((piece.doc, piece.prints[:, 0]))
            prints, doc = piece.prints[order], piece.doc[order]
            new = np.ones(len(order), bool)
            new[1:] = (prints[1:, 0] != prints[:-1, 0]) | (doc[1:] != doc[:-1])
            yield record_batch(partial(prints[new], bits))

    return run


def sketch(known: DataFrame, n_windows: int, window: int = WINDOW) -> tuple[int, list[bytes]]:
    """log2 of the width, and one bitmap per row of the sketch: slots seen in two documents or more."""
    bits = width_bits(n_windows)
    return bits, collected(known.mapInArrow(_partial_sketch(bits, window), RECORD), bits)[0]


_MESSAGE = "part int, piece long, kind int, prints binary, more binary, ids binary, rows binary, places binary"
_ROWS, _REPEATS, _ASKED = 0, 1, 2


def _candidates(shared, window: int, slices: int):
    """Per piece: its documents, the repeats found inside, and per slice what must be asked."""
    schema = pa.schema(
        [("part", pa.int32()), ("piece", pa.int64()), ("kind", pa.int32()), ("prints", pa.binary()), ("more", pa.binary()), ("ids", pa.binary()),
         ("rows", pa.binary()), ("places", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bits, bitmaps = shared.value
        for count, piece in enumerate(_pieces(batches, window)):
            number = (TaskContext.get().partitionId() << 32) + count
            maybe = seen_twice(piece.prints, bits, bitmaps)
            prints, doc, row, place = piece.prints[maybe], piece.doc[maybe], piece.row[maybe], piece.place[maybe]
            order = np.lexsort((doc, prints[:, 1], prints[:, 0]))
            prints, doc, row, place = prints[order], doc[order], row[order], place[order]
            repeat = _above_first(prints, doc)
            common = {"piece": number, "part": number % slices}
            out = [common | {"kind": _ROWS, "ids": piece.ids.tobytes(), "rows": piece.ties.tobytes()}]
            inside = np.lexsort((place[repeat], row[repeat]))
            out.append(
                common | {"kind": _REPEATS, "rows": squeezed(row[repeat][inside].astype("<u4")), "places": squeezed(place[repeat][inside].astype("<u4"))}
            )
            prints, row, place = prints[~repeat], row[~repeat], place[~repeat]
            part = (prints[:, 1] % np.uint64(slices)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            prints, row, place, part = prints[order], row[order], place[order], part[order]
            for begin, end in runs(part):
                own = slice(begin, end)
                out.append(
                    {"part": int(part[begin]), "piece": number, "kind": _ASKED, "prints": squeezed(prints[own, 0]), "more": prints[own, 1].tobytes(),
                     "ids": piece.ids.tobytes(), "rows": squeezed(row[own].astype("<u4")), "places": squeezed(place[own].astype("<u4"))}
                )
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _above_first(prints: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For entries sorted by print and document: is the document above the print's first?"""
    new = np.ones(len(doc), bool)
    new[1:] = (prints[1:] != prints[:-1]).any(axis=1)
    first = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    return doc > doc[first]


_ANSWER = "piece long, kind int, ids binary, rows binary, places binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact grouping of one slice at a time; other messages pass through."""
    schema = pa.schema([("piece", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("places", pa.binary())])
    part, asked = None, []

    def settled() -> pa.RecordBatch:
        pieces, blobs = [a[0] for a in asked], [a[1:] for a in asked]
        rows = [restored(b[3], "<u4") for b in blobs]
        prints = np.stack(
            [np.concatenate([restored(b[0], "<u8") for b in blobs]), np.concatenate([np.frombuffer(b[1], "<u8") for b in blobs])], axis=1
        )
        doc = np.concatenate([np.frombuffer(b[2], "<i8")[r] for b, r in zip(blobs, rows)])
        place = np.concatenate([restored(b[4], "<u4") for b in blobs])
        source, row = np.repeat(np.arange(len(asked)), [len(r) for r in rows]), np.concatenate(rows)
        order = np.lexsort((doc, prints[:, 1], prints[:, 0]))
        chosen = order[_above_first(prints[order], doc[order])]
        chosen = chosen[np.lexsort((place[chosen], row[chosen], source[chosen]))]
        out = []
        for begin, end in runs(source[chosen]):
            own = chosen[begin:end]
            out.append({"piece": pieces[int(source[own[0]])], "kind": _REPEATS, "rows": squeezed(row[own]), "places": squeezed(place[own])})
        return pa.RecordBatch.from_pylist(out, schema)

    for batch in batches:
        names = ("part", "piece", "kind", "prints", "more", "ids", "rows", "places")
        for values in zip(*(batch.column(n) for n in names)):
            now, piece, kind, prints, more, ids, rows, places = (v.as_py() for v in values)
            if now != part:
                if asked:
                    yield settled()
                part, asked = now, []
            if kind == _ASKED:
                asked.append((piece, prints, more, ids, rows, places))
            else:
                yield pa.RecordBatch.from_pylist([{"piece": piece, "kind": kind, "ids": ids, "rows": rows, "places": places}], schema)
    if asked:
        yield settled()


def _spans(window: int):
    """Word spans of repeats per document, from the answers sorted by piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("spans", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, ids, ties, rows, places = None, None, None, [], []

        def closed() -> pa.RecordBatch:
            row = np.concatenate([restored(blob, "<u4") for blob in rows]).astype(np.int64)
            place = np.concatenate([restored(blob, "<u4") for blob in places]).astype(np.int64)
            order = np.lexsort((place, row))
            row, place = row[order], place[order]
            begins = np.ones(len(row), bool)
            begins[1:] = (row[1:] != row[:-1]) | (place[1:] > place[:-1] + window)
            at = np.flatnonzero(begins)
            ends = np.concatenate([at[1:] - 1, [len(row) - 1]]) if len(at) else at
            spans = np.stack([place[at], place[ends] + window], axis=1).astype("<u4")
            out = [
                {"doc_id": int(ids[row[at[b]]]), "tie": int(ties[row[at[b]]]), "spans": spans[b:e].tobytes()} for b, e in runs(row[at])
            ]
            return pa.RecordBatch.from_pylist(out, schema)

        for batch in batches:
            for values in zip(*(batch.column(n) for n in ("piece", "kind", "ids", "rows", "places"))):
                now, kind, own_ids, own_rows, own_places = (v.as_py() for v in values)
                if now != piece:
                    if rows:
                        yield closed()
                    piece, rows, places = now, [], []
                if kind == _ROWS:
                    ids, ties = np.frombuffer(own_ids, "<i8"), np.frombuffer(own_rows, "<i8")
                else:
                    rows.append(own_rows)
                    places.append(own_places)
        if rows:
            yield closed()

    return run


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, tie (hash of the text) and packed word spans of documents with repeats."""
    context = docs.sparkSession.sparkContext
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    extra = F.regexp_count("text", F.lit(WORD)) - (window - 1)
    n_windows = known.agg(F.sum(F.when(extra > 0, extra.cast("long")))).first()[0] or 0
    shared = context.broadcast(sketch(known, n_windows, window))
    slices = n_windows // SLICE_WINDOWS + 1
    messages = known.mapInArrow(_candidates(shared, window, slices), _MESSAGE)
    answers = messages.repartition("part").sortWithinPartitions("part").mapInArrow(_answer, _ANSWER)
    by_piece = answers.repartition("piece").sortWithinPartitions("piece", "kind")
    found = by_piece.mapInArrow(_spans(window), "doc_id long, tie long, spans binary")
    return found.groupBy("doc_id", "tie").agg(F.first("spans").alias("spans"))  # equal rows have equal spans


_CUT = StructType(
    [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]
)


def _cut_words(digest: bool):
    @F.pandas_udf(_CUT)
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, packed in zip(texts, spans):
            words = as_bytes(text).split()
            n = len(words)
            if packed is not None:
                for start, stop in np.frombuffer(packed, dtype="<u4").reshape(-1, 2)[::-1].tolist():
                    del words[start:stop]
            kept = b" ".join(words)
            rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace")))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return cut


def remove(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by a space, or its sha256)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    joined = plain.where(F.col("doc_id").isNotNull()).join(spans(docs, window), ["doc_id", "tie"], "left")
    unnamed = plain.where(F.col("doc_id").isNull()).withColumn("spans", F.lit(None).cast("binary"))
    both = joined.select("doc_id", "text", "spans").unionByName(unnamed.select("doc_id", "text", "spans"))
    return both.select("doc_id", _cut_words(digest)("text", "spans").alias("cut")).select("doc_id", "cut.*")


def report(docs: DataFrame) -> DataFrame:
    return remove(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE = r"""
WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM doc WHERE len(ws) >= 50)),
repeat AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY gram) AS smallest FROM win) WHERE smallest < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS w FROM repeat),
lists AS (SELECT doc_id, list(w) AS gone FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, ws[w] AS word, w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS w FROM doc)),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.w) AS kept FROM word
  LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.w = word.w WHERE gone.w IS NULL GROUP BY word.doc_id)
SELECT doc.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN lists ON lists.doc_id = doc.doc_id LEFT JOIN kept ON kept.doc_id = doc.doc_id
"""
