"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every whole text is cut into overlapping windows of words. A word enters the network as a
hashed embedding of itself beside the mean of hashed embeddings of its character n-grams.
A run of more than ``LETTERS`` bytes (scripts without spaces) becomes several overlapping words.
Two gated recurrences read each window in both directions, attention pools their states, and
a document scores as its highest window. The network is trained here in numpy.

Training uses a bounded sample of labelled rows: at most ``SAMPLE`` of either label, lowest
hashes first, while their windows are within ``SAMPLE_WINDOWS``; a row beyond that is passed
over. Texts of the sample are used whole. A document's label counts for its highest window, so
long documents are learned as they are scored. The driver holds the sample as word numbers;
windows are views of them.

Scoring goes through batches of texts in the tasks, without a shuffle. Memory depends on
``TEXT_BYTES`` and the longest single text only.

Defined cases: missing and empty texts, and texts without words, score as the share of label 1
in the sample; missing labels are not learned from; of several labels for one id the highest
counts; without both labels in the sample all scores are that share (0 without any label);
equal rows score alike; an empty table gives no rows. Extra columns are kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from larkspur.llm.text import as_bytes, carried, fold, text_of
from larkspur.session import durable

THRESHOLD = 0.7
WINDOW, STRIDE = 48, 24
SAMPLE = 1500
SAMPLE_WINDOWS = 1 << 16
EPOCHS, FIRST_EPOCHS = 10, 3  # the former at least, and as many as make LEAST_STEPS
LEAST_STEPS, STEP_WINDOWS = 300, 128
HIDDEN, WIDTH = 8, 8
WORD_BUCKETS, GRAM_BUCKETS = 1 << 12, 1 << 15
GRAMS = (3, 4, 5)
LETTERS = 24
BATCH_WINDOWS = 8192
TEXT_BYTES = 1 << 20
FOLDS, HELD_OUT = 3, 1

_KEPT = bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and characters beyond ASCII; of a longer run than ``LETTERS`` bytes its pieces."""
    own = as_bytes(text).translate(_TABLE).split()
    if own and len(max(own, key=len)) > LETTERS:
        return [piece for word in own for piece in _cut(word)]
    return own


def _cut(word: bytes) -> list[bytes]:
    """Pieces of a run of letters that overlap so far that every n-gram of the run is in one of them."""
    last = max(len(word) - max(GRAMS) + 1, 1)
    return [word[i : i + LETTERS] for i in range(0, last, LETTERS - max(GRAMS) + 1)] if len(word) > LETTERS else [word]


class Features:
    """Hash buckets of distinct words: one per word, and one per n-gram of its letters."""

    def __init__(self, distinct: list[bytes]):
        n = len(distinct)
        letters = np.zeros((n, LETTERS + 2), dtype=np.uint8)
        if n:
            padded = b"".join((b"<" + w + b">")[: LETTERS + 2].ljust(LETTERS + 2, b"\0") for w in distinct)
            letters = np.frombuffer(padded, dtype=np.uint8).reshape(n, LETTERS + 2)
        codes = letters.astype(np.uint32)
        whole = np.full(n, 2166136261, dtype=np.uint32)
        for j in range(codes.shape[1]):
            whole = (whole ^ codes[:, j]) * np.uint32(16777619)
        self.word = ((whole ^ (whole >> np.uint32(15))) % np.uint32(WORD_BUCKETS)).astype(np.int64)
        grams, real = [], []
        for size in GRAMS:
            columns = codes.shape[1] - size + 1
            mixed = np.full((n, columns), size, dtype=np.uint32)
            for j in range(size):
                mixed = (mixed ^ codes[:, j : j + columns]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
            grams.append((mixed % np.uint32(GRAM_BUCKETS)).astype(np.int32))
            real.append(codes[:, size - 1 : size - 1 + columns] > 0)
        self.grams, self.real = np.concatenate(grams, axis=1), np.concatenate(real, axis=1)
        self.share = (1 / np.maximum(self.real.sum(axis=1), 1)).astype(np.float32)

    def some(self, rows: np.ndarray) -> Features:
        part = object.__new__(Features)
        for name, value in vars(self).items():
            setattr(part, name, value[rows])
        return part


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    shapes = {
        "words": ((WORD_BUCKETS, WIDTH), 0.1), "grams": ((GRAM_BUCKETS, WIDTH), 0.3), "input": ((2 * WIDTH, 6 * HIDDEN), 0.4),
        "bias": ((6 * HIDDEN,), 0.0), "ahead": ((HIDDEN, 3 * HIDDEN), 0.3), "back": ((HIDDEN, 3 * HIDDEN), 0.3),
        "attention": ((2 * HIDDEN,), 0.3), "output": ((2 * HIDDEN,), 0.3), "offset": ((1,), 0.0),
    }
    return {name: (draw.standard_normal(shape) * scale).astype(np.float32) for name, (shape, scale) in shapes.items()}


def embedded(model: dict[str, np.ndarray], features: Features) -> np.ndarray:
    """Embedding of each distinct word; blocks bound the memory of the n-gram look-ups."""
    out = np.empty((len(features.word), 2 * WIDTH), dtype=np.float32)
    out[:, :WIDTH] = model["words"][features.word]
    for begin in range(0, len(out), 4096):
        own = slice(begin, begin + 4096)
        rows = model["grams"][features.grams[own]]
        out[own, WIDTH:] = np.einsum("ngw,ng->nw", rows, features.real[own].astype(np.float32)) * features.share[own, None]
    return out


def _step(inputs: np.ndarray, state: np.ndarray, weights: np.ndarray):
    """One step of a gated recurrence; also what its derivative needs."""
    inner = state @ weights
    gates = _sigmoid(inputs[:, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
    keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    fresh = np.tanh(inputs[:, 2 * HIDDEN :] + reset * inner[:, 2 * HIDDEN :])
    return fresh + keep * (state - fresh), keep, reset, fresh, inner[:, 2 * HIDDEN :]


def logits(model: dict[str, np.ndarray], projected: np.ndarray, windows: np.ndarray | Windows) -> np.ndarray:
    """Logit per window. ``windows`` gives rows of ``projected``, whose last row is padding."""
    out = np.empty(len(windows), dtype=np.float32)
    padding = len(projected) - 1
    for begin in range(0, len(windows), BATCH_WINDOWS):
        chosen = windows[slice(begin, begin + BATCH_WINDOWS)]
        real = (chosen != padding).astype(np.float32)
        n, steps = chosen.shape
        ahead = np.empty((steps, n, HIDDEN), dtype=np.float32)
        state = np.zeros((n, HIDDEN), dtype=np.float32)
        for t in range(steps):
            new = _step(projected[chosen[:, t], : 3 * HIDDEN], state, model["ahead"])[0]
            state = state + real[:, t, None] * (new - state)
            ahead[t] = state
        state = np.zeros((n, HIDDEN), dtype=np.float32)
        total, pooled = np.zeros(n, dtype=np.float32), np.zeros(n, dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            new = _step(projected[chosen[:, t], 3 * HIDDEN :], state, model["back"])[0]
            state = state + real[:, t, None] * (new - state)
            look = ahead[t] @ model["attention"][:HIDDEN] + state @ model["attention"][HIDDEN:]
            weight = np.exp(np.clip(look, -30, 30)) * real[:, t]
            value = ahead[t] @ model["output"][:HIDDEN] + state @ model["output"][HIDDEN:]
            total += weight
            pooled += weight * value
        out[begin : begin + n] = pooled / np.maximum(total, 1e-20) + model["offset"][0]
    return out


def project(model: dict[str, np.ndarray], features: Features) -> np.ndarray:
    """Inputs of both recurrences per distinct word, and a last row for padding."""
    rows = embedded(model, features) @ model["input"] + model["bias"]
    return np.concatenate([rows, np.zeros((1, 6 * HIDDEN), dtype=np.float32)])


def gradients(model: dict[str, np.ndarray], features: Features, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Derivative of the mean log loss for some windows; padding is the number of words."""
    n, steps = windows.shape
    padding = len(features.word)
    x = embedded(model, features)
    projected = np.concatenate([x @ model["input"] + model["bias"], np.zeros((1, 6 * HIDDEN), dtype=np.float32)])
    real = (windows != padding).astype(np.float32)
    states, caches = {}, {}
    for side, order, own in (("ahead", range(steps), slice(0, 3 * HIDDEN)), ("back", range(steps - 1, -1, -1), slice(3 * HIDDEN, None))):
        state = np.zeros((n, HIDDEN), dtype=np.float32)
        states[side], caches[side] = np.empty((steps, n, HIDDEN), dtype=np.float32), [None] * steps
        for t in order:
            new, *parts = _step(projected[windows[:, t], own], state, model[side])
            caches[side][t] = (state, *parts)
            state = state + real[:, t, None] * (new - state)
            states[side][t] = state
    both = np.concatenate([states["ahead"], states["back"]], axis=2)
    look = both @ model["attention"] + (real.T - 1) * 1e9
    weight = np.exp(look - look.max(axis=0))
    weight /= weight.sum(axis=0)
    value = both @ model["output"]
    logit = (weight * value).sum(axis=0) + model["offset"][0]
    slope = ((_sigmoid(logit) - labels) / n).astype(np.float32)

    out = {name: np.zeros_like(array) for name, array in model.items()}
    out["offset"][0] = slope.sum()
    d_value = weight * slope
    d_look = weight * (value - (logit - model["offset"][0])) * slope
    out["output"] = np.einsum("tn,tnh->h", d_value, both)
    out["attention"] = np.einsum("tn,tnh->h", d_look, both)
    d_both = d_value[:, :, None] * model["output"] + d_look[:, :, None] * model["attention"]
    d_projected = np.zeros_like(projected)
    for side, order, own, part in (
        ("ahead", range(steps - 1, -1, -1), slice(0, 3 * HIDDEN), slice(0, HIDDEN)),
        ("back", range(steps), slice(3 * HIDDEN, None), slice(HIDDEN, None)),
    ):
        carried = np.zeros((n, HIDDEN), dtype=np.float32)
        for t in order:
            before, keep, reset, fresh, inner = caches[side][t]
            carried = carried + d_both[t][:, part]
            d_new = carried * real[:, t, None]
            d_fresh = d_new * (1 - keep) * (1 - fresh * fresh)
            d_keep = d_new * (before - fresh) * keep * (1 - keep)
            d_reset = d_fresh * inner * reset * (1 - reset)
            d_inner = np.concatenate([d_keep, d_reset, d_fresh * reset], axis=1)
            out[side] += before.T @ d_inner
            np.add.at(d_projected[:, own], windows[:, t], np.concatenate([d_keep, d_reset, d_fresh], axis=1))
            carried = carried * (1 - real[:, t, None]) + d_new * keep + d_inner @ model[side].T
    d_rows = d_projected[:-1]
    out["bias"] = d_rows.sum(axis=0)
    out["input"] = x.T @ d_rows
    d_x = d_rows @ model["input"].T
    np.add.at(out["words"], features.word, d_x[:, :WIDTH])
    each = (d_x[:, WIDTH:] * features.share[:, None])[:, None, :] * features.real[:, :, None]
    np.add.at(out["grams"], features.grams[features.real], each[features.real])
    return out


class Adam:
    """Steps of a size that follows the running moments of the derivative."""

    def __init__(self, model: dict[str, np.ndarray], rate: float):
        self.model, self.rate, self.count = model, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in model.items()}
        self.square = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, slopes: dict[str, np.ndarray]) -> None:
        self.count += 1
        for name, slope in slopes.items():
            mean, square = self.mean[name], self.square[name]
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            scale = np.sqrt(1 - 0.99**self.count) / (1 - 0.9**self.count)
            self.model[name] -= self.rate * scale * mean / (np.sqrt(square) + 1e-8)


class Windows:
    """The overlapping windows of some texts, as places in one row of word numbers."""

    def __init__(self, texts: list[list[bytes]]):
        place: dict[bytes, int] = {}
        numbers = [np.array([place.setdefault(w, len(place)) for w in own], dtype=np.int32) for own in texts]
        self.distinct = list(place)
        sizes = np.array([len(own) for own in numbers])
        begins = [_starts(n) for n in sizes.tolist()]
        counts = [len(own) for own in begins]
        self.flat = np.concatenate([*numbers, np.full(WINDOW, len(place), dtype=np.int32)])
        ends = np.cumsum(sizes)
        self.owner = np.repeat(np.arange(len(texts)), counts)
        self.begin = np.concatenate([*begins, np.zeros(0, dtype=np.int64)]) + np.repeat(ends - sizes, counts)
        self.end = np.repeat(ends, counts)

    def __len__(self) -> int:
        return len(self.begin)

    def __getitem__(self, some) -> np.ndarray:
        """Word numbers of some windows; the number of distinct words is padding."""
        at = self.begin[some][:, None] + np.arange(WINDOW)
        return np.where(at < self.end[some][:, None], self.flat[np.minimum(at, len(self.flat) - 1)], len(self.distinct))


def train(bags: list[tuple[list[bytes], int]], seed: int = 7) -> dict[str, np.ndarray]:
    """A model from (words, label) of documents; each has words."""
    draw = np.random.default_rng(seed)
    grid = Windows([own for own, _ in bags])
    features, padding, owner = Features(grid.distinct), len(grid.distinct), grid.owner
    labels = np.array([label for _, label in bags], dtype=np.float32)
    first = np.searchsorted(owner, np.arange(len(bags)))
    counts = np.bincount(owner, minlength=len(bags))
    model = initial(seed)
    adam = Adam(model, 0.01)
    for epoch in range(max(EPOCHS, LEAST_STEPS * STEP_WINDOWS // (2 * len(bags)))):
        if epoch < FIRST_EPOCHS:  # no view yet of which window makes a document toxic
            chosen = np.concatenate([first + draw.integers(0, counts), first + draw.integers(0, counts)])
        else:
            found = logits(model, project(model, features), grid)
            order = np.lexsort((-found, owner))
            chosen = np.concatenate([order[first], (first + draw.integers(0, counts))[labels == 0]])
        draw.shuffle(chosen)
        for begin in range(0, len(chosen), STEP_WINDOWS):
            rows = chosen[begin : begin + STEP_WINDOWS]
            used, local = np.unique(grid[rows], return_inverse=True)
            local = local.reshape(len(rows), WINDOW)
            if used[-1] == padding:
                used = used[:-1]
            adam.step(gradients(model, features.some(used), np.minimum(local, len(used)), labels[owner[rows]]))
    return model


def _starts(n: int) -> np.ndarray:
    """Begins of overlapping windows that cover n words, the last one reaching the end."""
    if n <= WINDOW:
        return np.arange(1 if n else 0)
    inner = np.arange(0, n - WINDOW, STRIDE)
    return np.append(inner, n - WINDOW)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label, words and number of windows of each text."""
    for batch in batches:
        lists = [words(text.as_py()) for text in batch.column("text")]
        columns = [pa.array([b" ".join(own) for own in lists], pa.binary()), pa.array([len(_starts(len(own))) for own in lists], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *columns], names=["doc_id", "label", "words", "windows"])


def sample(
    docs: DataFrame, labels: DataFrame, column: str = "toxic", size: int = SAMPLE, windows: int = SAMPLE_WINDOWS
) -> list[tuple[list[bytes], int]]:
    """(words, label) of the training rows: at most ``size`` of either label, with at most so many windows; equal rows are one."""
    known = labels.where(F.col(column).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == label).orderBy(*order).limit(size) for label in (1, 0)]
    texts = docs.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("doc_id", "label", "text")  # at most 2 * size ids
    cut = texts.mapInArrow(_words, "doc_id long, label int, words binary, windows long").where("windows > 0")
    stored = durable(cut.distinct().withColumn("digest", F.md5("words")))
    chosen = []
    for label in (1, 0):  # an id may have many texts, so rows are bounded once more
        own = stored.where(F.col("label") == label).select("doc_id", "digest", "windows")
        left = windows
        for row in own.orderBy(*order, "digest").limit(size).collect():
            if row["windows"] <= left:
                left -= row["windows"]
                chosen.append((row["doc_id"], row["digest"]))
    keys = docs.sparkSession.createDataFrame(chosen, "doc_id long, digest string")
    rows = stored.join(F.broadcast(keys), ["doc_id", "digest"]).select("doc_id", "digest", "label", "words").collect()
    return [(bytes(r["words"]).split(), r["label"]) for r in sorted(rows)]


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", size: int = SAMPLE) -> tuple[dict[str, np.ndarray] | None, float]:
    """The trained model, and the share of label 1 in the sample."""
    bags = sample(docs, labels, column, size)
    share = float(np.mean([label for _, label in bags])) if bags else 0.0
    if share in (0.0, 1.0):
        return None, share
    return train(bags), share


def scores(model: dict[str, np.ndarray] | None, share: float, texts: list[str | None]) -> np.ndarray:
    """The highest window's score of each text."""
    out = np.full(len(texts), share)
    if model is None:
        return out
    grid = Windows([words(text) for text in texts])
    if not len(grid):
        return out
    best = np.full(len(texts), -np.inf, dtype=np.float64)
    np.maximum.at(best, grid.owner, logits(model, project(model, Features(grid.distinct)), grid))
    found = np.isfinite(best)
    out[found] = 1 / (1 + np.exp(-best[found]))
    return out


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        model, share = shared.value
        for batch in batches:
            texts = text_of(batch)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            part = (np.cumsum(sizes) - sizes) // TEXT_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if end > begin:
                    found = scores(model, share, texts.slice(begin, end - begin).to_pylist())
                    yield pa.RecordBatch.from_arrays([batch.column("row").slice(begin, end - begin), pa.array(found)], names=["row", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    plain = carried(docs, carry or docs.columns)
    schema = StructType([StructField("row", plain.schema["row"].dataType), StructField("score", DoubleType())])
    return plain.mapInArrow(_scored(shared), schema)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    return score(docs, labels).where(F.col("score") < threshold).select("row.*")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold(F.col("row.doc_id"), FOLDS) == HELD_OUT
    return score(docs, labels, carry=["doc_id"]).select(
        "row.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
