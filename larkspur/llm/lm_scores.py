"""Language-model scores of whole texts: context-tree weighting beside a unigram base.

1. Each piece of work sends its distinct byte grams with their training counts to slices of
   the last ``UPPER`` + 1 bytes of the context. A slice holds all deeper contexts below its own
   ones, weights them and answers each piece with the mixture of these depths. Contexts of up
   to ``UPPER`` bytes, which the number of byte values bounds, are put together and broadcast.
2. In the same exchange it sends its distinct words with their training counts to slices of
   the word hashes and gets the counts over the whole corpus back. A word or gram that most
   documents hold is one entry per piece, and no table that grows with the corpus is broadcast.
3. With the answers and the texts, which travel compressed, a piece sums up its documents.

No gram is left out, however rare, so the counts grow with the corpus and the slices with them.

Words are compared by 64-bit hashes. The last token of a text is its end.

Defined cases: a missing or empty text has only its end; a document without an id counts as
id "" (held out); equal rows are scored and learned row by row; without training texts the
model is uniform over bytes and the base uses N = V = 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from larkspur.llm import ctw
from larkspur.llm.countmin import restored, runs, squeezed
from larkspur.llm.shipping import opened, shipped
from larkspur.llm.text import WORD, as_bytes, fold
from larkspur.session import durable, scratch_path

FOLDS, HELD_OUT = 10, 0
SMOOTHING = 0.1
GRAM_SLICES = 8
TEXT_BYTES = 1 << 22
SLICE_WORDS = 1 << 22
SLICE_BYTES = 1 << 23
PENDING_GRAMS = 1 << 21
UPPER = 2
MEMO_WORDS = 1 << 17

_GRAMS = "depth int, part int, grams binary, counts binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Bounded runs of rows with their texts as bytes; a longer text stands alone."""
    for batch in batches:
        begin, texts, size = 0, [], 0
        for i, text in enumerate(batch.column("text")):
            texts.append(as_bytes(text.as_py()))
            size += len(texts[-1])
            if size >= TEXT_BYTES:
                yield batch.slice(begin, i + 1 - begin), texts
                begin, texts, size = i + 1, [], 0
        if texts:
            yield batch.slice(begin), texts


def _gram_schema() -> pa.Schema:
    return pa.schema([("depth", pa.int32()), ("part", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of a task at every depth, cut into slices of their contexts."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def sent() -> pa.RecordBatch:
        out = []
        for depth in range(ctw.DEPTH + 1):
            own, n = ctw.summed(ctw.shorter(keys, ctw.DEPTH, depth), counts)
            part = ((own >> np.uint64(8)) % np.uint64(GRAM_SLICES)).astype(np.int64)
            for i in range(GRAM_SLICES):
                if (chosen := part == i).any():
                    out.append({"depth": depth, "part": i, "grams": squeezed(own[chosen]), "counts": squeezed(n[chosen])})
        return pa.RecordBatch.from_pylist(out, _gram_schema())

    for _, texts in _pieces(batches):
        new, n = ctw.counted(ctw.text_grams(texts)[0])
        keys, counts = ctw.summed(np.concatenate([keys, new]), np.concatenate([counts, n]))
        if len(keys) > ctw.MAX_ENTRIES:
            yield sent()
            keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield sent()


def _merged_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals per gram from rows sorted by (depth, part); two sorted lists are held at a time."""
    key, grams, counts = None, None, None
    schema = _gram_schema().append(pa.field("kept", pa.list_(pa.int64())))

    def closed() -> pa.RecordBatch:
        levels = np.bincount(np.log2(ctw.context_counts(grams, counts)).astype(np.int64), minlength=48)
        kept = np.cumsum(levels[::-1])[::-1]  # grams whose context has 2 ** k counts or more
        return pa.RecordBatch.from_pylist(
            [{"depth": key[0], "part": key[1], "grams": squeezed(grams), "counts": squeezed(counts), "kept": kept.tolist()}], schema
        )

    for batch in batches:
        for depth, part, own, n in zip(batch.column("depth").to_pylist(), batch.column("part").to_pylist(), batch.column("grams"), batch.column("counts")):
            own, n = restored(own.as_py(), "<u8"), restored(n.as_py(), "<i8")
            if key != (depth, part):
                if key is not None:
                    yield closed()
                key, grams, counts = (depth, part), own, n
            else:
                grams, counts = ctw.summed(np.concatenate([grams, own]), np.concatenate([counts, n]))
    if key is not None:
        yield closed()


def _pruned(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for depth, part, own, n in zip(batch.column("depth").to_pylist(), batch.column("part").to_pylist(), batch.column("grams"), batch.column("counts")):
                own, n = restored(own.as_py(), "<u8"), restored(n.as_py(), "<i8")
                chosen = ctw.context_counts(own, n) >= least
                yield pa.RecordBatch.from_pylist(
                    [{"depth": depth, "part": part, "grams": squeezed(own[chosen]), "counts": squeezed(n[chosen])}], _gram_schema()
                )

    return run


def fit(texts: DataFrame) -> ctw.Model:
    """A model of bounded size for use in memory; ``score`` uses the whole counts instead."""
    records = texts.select("text").mapInArrow(_gathered, _GRAMS).repartition("depth", "part").sortWithinPartitions("depth", "part")
    merged = durable(records.mapInArrow(_merged_grams, _GRAMS + ", kept array<long>"))
    sizes = merged.select("depth", F.posexplode("kept").alias("power", "n")).groupBy("depth", "power").agg(F.sum("n").alias("n"))
    powers = sizes.groupBy("power").agg(F.max("n").alias("n")).collect()  # 48 rows
    power = min((r["power"] for r in powers if r["n"] <= ctw.MAX_ENTRIES), default=0)
    tables: list[list] = [[] for _ in range(ctw.DEPTH + 1)]
    for row in merged.select("depth", "part", "grams", "counts").mapInArrow(_pruned(1 << power), _GRAMS).collect():  # MAX_ENTRIES
        tables[row["depth"]].append((restored(row["grams"], "<u8"), restored(row["counts"], "<i8")))
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    joined = [[np.concatenate([t[i] for t in [empty, *own]]) for i in (0, 1)] for own in tables]
    return ctw.Model([ctw.summed(keys, counts) for keys, counts in joined])


def model_scores(model: ctw.Model, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each text."""
    if not texts:
        return np.zeros(0)
    found, sizes = ctw.text_grams(texts)
    return np.add.reduceat(model.log10(found), np.cumsum(sizes) - sizes)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        value = xxhash.xxh3_64_digest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


_ROWS, _GRAM, _WORDS, _VOCABULARY, _SHORT = range(5)
_MESSAGE = "part int, piece long, kind int, a binary, b binary, c binary, d binary, e binary"
_MESSAGE_SCHEMA = pa.schema(
    [("part", pa.int32()), ("piece", pa.int64()), ("kind", pa.int32())] + [(n, pa.binary()) for n in "abcde"]
)


def _slice_of(grams: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each gram, the same for all grams with the same last ``UPPER`` + 1 bytes of context."""
    context = grams >> np.uint64(8 * (ctw.DEPTH - UPPER))
    mixed = context * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(slices)).astype(np.int64)


def _asked_grams(texts: list[bytes], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams of some texts, and how often each occurs in the training ones."""
    found, sizes = ctw.text_grams(texts)
    marked = np.sort((found << np.uint64(1)) | np.repeat(training, sizes).astype(np.uint64))
    keys = marked >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)


def _packed(texts: list[bytes]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(texts))


def _unpacked(blob: bytes, sizes: np.ndarray) -> list[bytes]:
    import zstandard

    whole, stops = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(sizes)
    return [whole[begin:end] for begin, end in zip((stops - sizes).tolist(), stops.tolist())]


def _messages(slices: int, gram_slices: int, lower: bool):
    """Per piece: texts and word matrix of its documents, and per slice its distinct words and grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes = WordHashes()
        for count, (rows, texts) in enumerate(_pieces(batches)):
            piece = (TaskContext.get().partitionId() << 32) + count
            lists = [[*(text.lower() if lower else text).split(), b""] for text in texts]  # A-Z only; the empty word is the end
            sizes = np.array([len(own) for own in lists], dtype=np.int64)
            flat = np.frombuffer(b"".join(b"".join(map(hashes.__getitem__, own)) for own in lists), dtype="<u8")
            words, place = np.unique(flat, return_inverse=True)
            owner = np.repeat(np.arange(len(lists)), sizes)
            training = rows.column("held_out").to_numpy(zero_copy_only=False) == False  # noqa: E712
            learned = np.bincount(place, weights=training[owner], minlength=len(words)).astype(np.int64)
            part = (words % np.uint64(slices)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            # Words of each document in the order in which the answers will stand together.
            cell, times = np.unique(owner * len(words) + rank[place], return_counts=True)
            starts = np.searchsorted(cell // len(words), np.arange(len(lists) + 1))
            ids = rows.column("doc_id").to_pylist()
            known = np.array([i is not None for i in ids])
            ids = np.array([i or 0 for i in ids], dtype=np.int64)
            head = np.stack([ids, known.astype(np.int64), training.astype(np.int64), sizes, [len(text) for text in texts]])
            out = [
                {"part": piece % slices, "piece": piece, "kind": _ROWS, "a": head.tobytes(), "b": _packed(texts), "c": starts.astype("<i8").tobytes(),
                 "d": squeezed((cell % len(words)).astype("<u4")), "e": squeezed(times.astype("<u4"))}
            ]
            words, learned, part = words[order], learned[order], part[order]
            for begin, end in runs(part):
                out.append({"part": int(part[begin]), "piece": piece, "kind": _WORDS, "a": squeezed(words[begin:end]), "b": squeezed(learned[begin:end])})
            grams, times = _asked_grams(texts, training)
            own = _slice_of(grams, gram_slices)
            order = np.argsort(own, kind="stable")
            grams, times, own = grams[order], times[order], own[order]
            for begin, end in runs(own):  # slices of grams are numbered behind those of words
                blobs = {"a": squeezed(grams[begin:end]), "b": squeezed(times[begin:end].astype("<u4"))}
                out.append({"part": slices + int(own[begin]), "piece": piece, "kind": _GRAM, **blobs})
            yield pa.RecordBatch.from_pylist(out, _MESSAGE_SCHEMA)

    return run


def _weighted_grams(part: int, asked: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    """Each piece's mixture of the depths beyond ``UPPER``, and the sums of the slice that the depths up to there need."""
    every, counts, new, n, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], [], 0
    for i, (_, a, b) in enumerate(asked):
        new.append(restored(a, "<u8"))
        n.append(restored(b, "<u4").astype(np.int64))
        held += len(new[-1])
        if held >= max(PENDING_GRAMS, len(every)) or i == len(asked) - 1:
            every, counts = ctw.summed(np.concatenate([every, *new]), np.concatenate([counts, *n]))
            new, n, held = [], [], 0
    learned = counts > 0
    keys, counts = every[learned], counts[learned]
    levels = [ctw.Level(*ctw.summed(ctw.shorter(keys, ctw.DEPTH, depth), counts)) for depth in range(UPPER + 1, ctw.DEPTH + 1)]
    weighted = ctw.weigh(levels, levels[-1].log_own)
    mixed = ctw.mixed(levels, UPPER + 1, every, np.full(len(every), 1 / 256))
    for piece, a, _ in asked:
        answer = mixed[np.searchsorted(every, restored(a, "<u8"))]
        yield pa.RecordBatch.from_pylist([{"part": part, "piece": piece, "kind": _GRAM, "a": squeezed(answer)}], _MESSAGE_SCHEMA)
    short, n = ctw.summed(ctw.shorter(keys, ctw.DEPTH, UPPER), counts)
    contexts = levels[0].contexts >> np.uint64(8)
    first = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(contexts) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weighted, first) if len(contexts) else weighted
    blobs = {"a": short.tobytes(), "b": n.tobytes(), "c": contexts[first].tobytes(), "d": sums.tobytes()}
    yield pa.RecordBatch.from_pylist([{"part": part, "piece": -1, "kind": _SHORT, **blobs}], _MESSAGE_SCHEMA)


def _short_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of slices as rows: grams with their counts, and contexts with what weighs below them."""
    for batch in batches:
        for a, b, c, d in zip(*(batch.column(name).to_pylist() for name in "abcd")):
            grams, contexts = np.frombuffer(a, "<i8"), np.frombuffer(c, "<i8")
            counts = np.concatenate([np.frombuffer(b, "<i8"), np.zeros(len(contexts), np.int64)])
            below = np.concatenate([np.zeros(len(grams)), np.frombuffer(d, "<f8")])
            names = ["is_gram", "key", "n", "below"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(counts)) < len(grams)), pa.array(np.concatenate([grams, contexts])), pa.array(counts), pa.array(below)], names=names
            )


def _short_levels(answers: DataFrame) -> list[ctw.Level]:
    """The depths up to ``UPPER`` with their weights: at most 256 ** (UPPER + 1) grams, whatever the corpus."""
    rows = answers.where(F.col("kind") == _SHORT).select(*"abcd").mapInArrow(_short_rows, "is_gram boolean, key long, n long, below double")
    sums = rows.groupBy("is_gram", "key").agg(F.sum("n").alias("n"), F.sum("below").alias("below")).orderBy("is_gram", "key").toArrow()
    is_gram = sums.column("is_gram").to_numpy()
    keys, counts = sums.column("key").to_numpy().astype(np.uint64), sums.column("n").to_numpy()
    grams, n = keys[is_gram], counts[is_gram]
    levels = [ctw.Level(*ctw.summed(ctw.shorter(grams, UPPER, depth), n)) for depth in range(UPPER + 1)]
    below = np.zeros(len(levels[-1].contexts))
    below[levels[-1].find(keys[~is_gram])] = sums.column("below").to_numpy()[~is_gram]
    last = levels[-1]
    weighted = np.logaddexp(last.log_own, below) - np.log(2)
    last.stop = np.exp(last.log_own - np.log(2) - weighted)
    ctw.weigh(levels, weighted)
    return levels


def _answered(slices: int):
    """Corpus counts of one slice of the words or grams at a time, answered per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, asked = None, []

        def settled() -> Iterator[pa.RecordBatch]:
            if part >= slices:
                yield from _weighted_grams(part, asked)
                return
            words = [restored(a, "<u8") for _, a, _ in asked]
            every, place = np.unique(np.concatenate(words), return_inverse=True)
            totals = np.zeros(len(every), np.int64)
            np.add.at(totals, place, np.concatenate([restored(b, "<i8") for _, _, b in asked]))
            out, at = [], 0
            for (piece, _, _), own in zip(asked, words):
                out.append({"part": part, "piece": piece, "kind": _WORDS, "a": squeezed(totals[place[at : at + len(own)]])})
                at += len(own)
            sums = np.array([(totals > 0).sum(), totals.sum()], dtype="<i8")
            out.append({"part": part, "piece": -1, "kind": _VOCABULARY, "a": sums.tobytes()})
            yield pa.RecordBatch.from_pylist(out, _MESSAGE_SCHEMA)

        for batch in batches:
            for row in range(batch.num_rows):
                now, piece, kind, *blobs = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                if now != part:
                    if asked:
                        yield from settled()
                    part, asked = now, []
                if kind != _ROWS:
                    asked.append((piece, blobs[0], blobs[1]))
                else:
                    yield batch.slice(row, 1)
        if asked:
            yield from settled()

    return run


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def _gram_logs(levels: list[ctw.Level], texts: list[bytes], answers: list[np.ndarray], gram_slices: int) -> np.ndarray:
    """log10 probability of each text, from the answers in the order of slices and grams."""
    found, sizes = ctw.text_grams(texts)
    every, place = np.unique(found, return_inverse=True)
    order = np.argsort(_slice_of(every, gram_slices), kind="stable")
    deep = np.empty(len(every))
    deep[order] = np.concatenate(answers)
    logs = np.log10(ctw.mixed(levels, 0, every, deep))
    return np.add.reduceat(logs[place], np.cumsum(sizes) - sizes)


def _totals(shared, gram_slices: int):
    """Per document its known tokens, the sum of log10 smoothed counts and its score, from rows sorted by (piece, kind, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = opened(shared)
        piece, head, counts, mixtures = None, None, [], []

        def closed() -> pa.RecordBatch:
            totals = np.concatenate(counts)
            ids, known, training, sizes, lengths = np.frombuffer(head[0], "<i8").reshape(5, -1)
            starts = np.frombuffer(head[2], "<i8")
            place, times = restored(head[3], "<u4"), restored(head[4], "<u4").astype(np.int64)
            found = totals[place]
            logs = np.add.reduceat(np.log10(found + SMOOTHING) * times, starts[:-1])
            seen = np.add.reduceat(np.where(found > 0, times, 0), starts[:-1])
            scores = _gram_logs(levels, _unpacked(head[1], lengths), mixtures, gram_slices)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=known == 0), pa.array(training == 0), pa.array(sizes), pa.array(seen), pa.array(logs), pa.array(scores)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                _, now, kind, *blobs = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                if now != piece:
                    if head:
                        yield closed()
                    piece, head, counts, mixtures = now, None, [], []
                if kind == _ROWS:
                    head = blobs
                elif kind == _GRAM:
                    mixtures.append(restored(blobs[0], "<f8"))
                else:
                    counts.append(restored(blobs[0], "<i8"))
        if head:
            yield closed()

    return run


@F.udf(ArrayType(LongType()))
def _pair(blob):
    return np.frombuffer(blob, "<i8").tolist()


def score(docs: DataFrame, lower: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document.

    With ``lower`` the base counts words with A-Z in lower case; the model always reads the texts as they are.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    sizes = plain.agg(
        F.sum(F.regexp_count("text", F.lit(WORD)).cast("long")).alias("words"), F.sum(F.octet_length("text").cast("long")).alias("bytes")
    ).first()
    slices, gram_slices = (sizes["words"] or 0) // SLICE_WORDS + 1, (sizes["bytes"] or 0) // SLICE_BYTES + 1
    messages = plain.mapInArrow(_messages(slices, gram_slices, lower), _MESSAGE)
    path = scratch_path(spark, "word-counts")
    messages.repartition("part").sortWithinPartitions("part").mapInArrow(_answered(slices), _MESSAGE).write.parquet(path)
    answers = spark.read.parquet(path)
    shared = shipped(spark.sparkContext, _short_levels(answers))
    sums = answers.where(F.col("kind") == _VOCABULARY).select(_pair("a").alias("s"))
    size = sums.agg(F.sum(F.col("s")[0]).alias("v"), F.sum(F.col("s")[1]).alias("n")).first()
    v, n = size["v"] or 0, size["n"] or 0
    pieces = answers.where(F.col("piece") >= 0).repartition("piece").sortWithinPartitions("piece", "kind", "part")
    log_all = float(np.log10(n + SMOOTHING * (v + 1)))
    return pieces.mapInArrow(_totals(shared, gram_slices), _RESULT).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * log_all).alias("base_score"), "score",
    )
