"""Token ids of documents in files of bit-plane shuffled blocks.

Documents are put in ascending order of their ids by a range partitioning, encoded, and
each partition becomes one shard. The ids of a shard are cut into blocks of a fixed number
of ids; a block is transposed into byte or bit planes, so that the almost constant high
bits of the ids stand together, and each plane is compressed with zstandard on its own.

The file format is one Parquet folder with two tables that Spark's committer writes, so a
lost executor leaves no torn file and any store that Spark can write to will do:

* ``blocks``: shard, block, n_ids, and the compressed planes, highest plane last;
* ``index``: per document shard, row (its place in the shard), doc_id, offset (ids of the
  shard before it) and n_ids; per shard the chunk index is its blocks' (block, n_ids).

Reading needs neither the texts nor the tokenizer. A task holds one block, one batch of
documents and one batch of index rows at a time, whatever the length of a document.

Defined cases: missing and empty texts are the end id alone; rows with equal ids are
ordered by the hash of their texts; rows without an id come first; an empty table makes
empty tables. Extra columns are not stored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from larkspur.llm.text import as_bytes
from larkspur.session import scratch_path

BLOCK_IDS = 1 << 16
LEVEL = 3
END_ID = 2
MEMO_WORDS = 1 << 18
TEXT_BYTES = 1 << 22

RECORDS = "kind int, shard int, row long, doc_id long, offset long, n_ids long, planes array<binary>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer drops white space and never merges across it, nor between a run of letters
    and the marks that follow. So the distinct words of some texts are encoded once, letters
    apart from final marks, many in one call; the ids of a lower-cased word are remembered in
    two generations of some ``MEMO_WORDS``, which bounds memory and not what is encoded. Arrow finds the words and the distinct ones; ids are put together by numpy.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        self.tokenizer, self.model = tokenizer, tokenizer.model
        vocabulary = tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, from one call."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(one.ids, dtype="<u4") for one in found]

    def _many(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, each a single run for the tokenizer, encoded as one text."""
        ids = self._each([b" ".join(words).decode()])[0]
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        return _sliced(ids, stops) if len(stops) == len(words) else self._apart(words)

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of a-z only, which the tokenizer hands to its model as they are."""
        found = list(map(self.model.tokenize, b" ".join(words).decode().split(" ")))
        ids = np.fromiter((token.id for tokens in found for token in tokens), dtype="<u4")
        return _sliced(ids, np.cumsum(list(map(len, found))))

    def _apart(self, words: list[bytes]) -> list[bytes]:
        """Ids of any words, each a text of its own."""
        return [ids.tobytes() for ids in self._each([word.decode("utf-8", "replace") for word in words])]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of the distinct words, from memory or encoded now."""
        found = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh, plain, runs, others = {}, [], [], []
        for word in (words[i] for i in missing):
            ids = self.old.get(word)
            if ids is not None:
                fresh[word] = ids
            else:
                (plain if word.isalpha() and word.islower() else runs if _run_of_letters(word) else others).append(word)
        for kind, encode in ((plain, self._plain), (runs, self._many), (others, self._apart)):
            for begin in range(0, len(kind), 1024):
                some = kind[begin : begin + 1024]
                fresh.update(zip(some, encode(some)))
        for i in missing:
            found[i] = fresh[words[i]]
        self.young.update(fresh)
        if len(self.young) > MEMO_WORDS:
            self.old, self.young = self.young, {}
        return found

    def _table(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A code for each part, the number of ids by code, and all ids in the order of the codes."""
        coded = parts.dictionary_encode()
        ids = self._known(_listed(coded.dictionary))
        return coded.indices.to_numpy(), np.array(list(map(len, ids)), dtype=np.int64) // 4, np.frombuffer(b"".join(ids), dtype="<u4")

    def encoded(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, those in ``end`` after each text, and the number of each text's ids with them."""
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = lists.flatten().dictionary_encode()
        letters, marks = _cut(coded.dictionary)
        codes, lengths, table = self._table(pa.concat_arrays([letters, marks]))
        words, sizes = _gathered(codes.reshape(2, -1).T.ravel(), lengths, table)
        flat, sizes = _gathered(coded.indices.to_numpy(), sizes[0::2] + sizes[1::2], words)
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(lists.value_lengths().to_numpy())]
        return np.insert(flat, np.repeat(stops, len(end)), end * len(stops)), np.diff(stops, prepend=0) + len(end)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        flat, sizes = self.encoded(pa.array([as_bytes(text) for text in texts], pa.binary()).view(pa.string()), [])
        stops = 4 * np.cumsum(sizes)
        whole = flat.tobytes()
        return [whole[begin:stop] for begin, stop in zip((stops - 4 * sizes).tolist(), stops.tolist())]


def _sliced(ids: np.ndarray, stops: np.ndarray) -> list[bytes]:
    """The bytes of ids up to each of the stops."""
    flat, out, start = ids.tobytes(), [], 0
    for stop in (4 * stops).tolist():
        out.append(flat[start:stop])
        start = stop
    return out


def _listed(words: pa.Array) -> list[bytes]:
    """The bytes of words without nulls, made in one call and not through a scalar each."""
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


_MARKS = ".,;:!?"
_LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"  # letters that stay so, composed and in lower case
_LATIN_BYTES = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _cut(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs of letters in lower case and the marks after them; any other word whole, and nothing."""
    import pyarrow.compute as pc

    letters = pc.ascii_rtrim(words, characters=_MARKS)
    runs = pc.match_substring_regex(letters, _LATIN).to_numpy(zero_copy_only=False).copy()
    others = np.flatnonzero(~runs & ~pc.string_is_ascii(letters).to_numpy(zero_copy_only=False))
    runs[others] = [_run_of_letters(word) for word in _listed(letters.take(pa.array(others)))]
    sizes = pc.binary_length(letters).to_numpy()
    marked = np.flatnonzero(runs & (pc.binary_length(words).to_numpy() > sizes))
    marks = np.full(len(words), "", dtype=object)
    marks[marked] = [word[size:].decode() for word, size in zip(_listed(words.take(pa.array(marked))), sizes[marked].tolist())]
    return pc.if_else(pa.array(runs), pc.ascii_lower(letters), words), pa.array(marks, words.type)


def _gathered(codes: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a table, whose lengths are given by code, in the order of ``codes``; and the length of each."""
    starts, each = np.cumsum(lengths) - lengths, lengths[codes]
    place = np.repeat(starts[codes] - np.cumsum(each) + each, each) + np.arange(each.sum())
    return table[place], each


def _run_of_letters(word: bytes) -> bool:
    """Whether the tokenizer, which lower-cases and composes, sees letters only; some letters become a letter and a mark."""
    return word.isalpha() or (not word.isascii() and (_LATIN_BYTES.fullmatch(word) is not None or unicodedata.normalize("NFC", word.decode().lower()).isalpha()))


def worker_encoder(shared) -> Encoder:
    """The encoder of this Python worker: made from the broadcast definition, kept from task to task."""
    state = shared.value
    if "encoder" not in state:
        state["encoder"] = Encoder(state["definition"])
    return state["encoder"]


def to_planes(ids: bytes, bits: bool = False, level: int = LEVEL) -> list[bytes]:
    """The 4 byte planes, or the 32 bit planes, of 32-bit ids, each compressed."""
    import zstandard

    rows = np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4)
    planes = rows.T
    if bits:
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(np.ascontiguousarray(plane).tobytes()) for plane in planes]


def from_planes(planes: list[bytes], n_ids: int) -> bytes:
    """The ids that ``to_planes`` was given."""
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(unpacker.decompress(bytes(p)), dtype=np.uint8) for p in planes]
    if len(raw) == 4:
        return np.ascontiguousarray(np.stack(raw).T).tobytes()
    flat = np.unpackbits(np.stack(raw), axis=1, count=n_ids).T
    return np.packbits(np.ascontiguousarray(flat), axis=1, bitorder="little").tobytes()


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most TEXT_BYTES of text; a longer text is a slice of its own."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        before = sizes[begin - 1] if begin else 0
        stop = max(int(np.searchsorted(sizes, before + TEXT_BYTES, side="right")), begin + 1)
        yield batch.slice(begin, stop - begin)
        begin = stop


def _encode_shard(shared, end_id: int, block_ids: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encode, end = worker_encoder(shared).encoded, [int(end_id)]
        schema = pa.schema(
            [("kind", pa.int32()), ("shard", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()),
             ("offset", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.list_(pa.binary()))]
        )
        pending, row, offset, block = bytearray(), 0, 0, 0

        def cut(final: bool) -> list[dict]:
            nonlocal block
            made, at, size = [], 0, 4 * block_ids
            while len(pending) - at >= size or (final and at < len(pending)):
                ids = bytes(pending[at : at + size])
                at += len(ids)
                made.append({"kind": 1, "shard": shard, "row": block, "n_ids": len(ids) // 4, "planes": to_planes(ids, bits)})
                block += 1
            del pending[:at]
            return made

        for batch in batches:
            for rows in _bounded(batch):
                ids, sizes = encode(rows.column("text"), end)
                pending += ids.tobytes()
                n, stops = len(sizes), np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(row, row + n)), rows.column("doc_id"),
                     pa.array(offset + stops - sizes), pa.array(sizes), pa.nulls(n, schema.field("planes").type)],
                    schema=schema,
                )
                row, offset = row + n, offset + int(stops[-1])
                if len(pending) >= 4 * block_ids:
                    yield pa.RecordBatch.from_pylist(cut(False), schema)
        if pending:
            yield pa.RecordBatch.from_pylist(cut(True), schema)

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
    bits: bool = False,
) -> None:
    """Encode (doc_id, text) and write the two tables below ``path``."""
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    definition = Path(tokenizer or default_tokenizer()).read_text(encoding="utf-8")
    shared = spark.sparkContext.broadcast({"definition": definition})  # one vocabulary file
    records = ordered.mapInArrow(_encode_shard(shared, end_id, block_ids, bits), RECORDS)
    # One pass writes both: the table is split by kind, and each part is read with its own columns.
    records.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/records")
    spark.read.schema(RECORDS).parquet(f"{path}/records").where("kind = 0").groupBy("shard").agg(
        F.sum("n_ids").alias("n_ids"), F.count(F.lit(1)).alias("n_docs")
    ).coalesce(1).write.parquet(f"{path}/shards")


def index(spark: SparkSession, path: str) -> DataFrame:
    """shard, row, doc_id, offset, n_ids and start (ids of all documents before) per document."""
    shards = spark.read.parquet(f"{path}/shards")
    # One row per file of the output, as bounded as the file listing itself.
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    rows = spark.read.schema(RECORDS).parquet(f"{path}/records").where("kind = 0").drop("kind", "planes")
    return rows.join(F.broadcast(bases), "shard").select(
        "shard", "row", "doc_id", "offset", "n_ids", (F.col("base") + F.col("offset")).alias("start")
    )


def _crc_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block row with the documents in it: the crc32 and length of each document's piece."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = memoryview(from_planes(row["planes"], row["n_ids"]))
            spans = [(d["row"], max(d["offset"] - row["first"], 0), min(d["offset"] + d["n_ids"] - row["first"], row["n_ids"])) for d in row["docs"]]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * len(spans), pa.int32()),
                    "row": pa.array([r for r, _, _ in spans], pa.int64()),
                    "block": pa.array([row["block"]] * len(spans), pa.int64()),
                    "n": pa.array([stop - start for _, start, stop in spans], pa.int64()),
                    "crc": pa.array([zlib.crc32(ids[4 * start : 4 * stop]) for _, start, stop in spans], pa.int64()),
                }
            )


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the reflected crc32 polynomial."""
    product = 0
    while a:
        if a & 0x80000000:
            product ^= b
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
        a = (a << 1) & 0xFFFFFFFF
    return product


def combine_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings put together, from their crc32 and the length of the second."""
    shift, base, n = 0x80000000, 0x00800000, second_bytes  # x^0 and x^8
    while n:
        if n & 1:
            shift = _times(shift, base)
        base, n = _times(base, base), n >> 1
    return _times(shift, first) ^ second


@F.pandas_udf(LongType())
def _joined_crc(pieces: pd.Series) -> pd.Series:
    def one(rows) -> int:
        rows = sorted(rows, key=lambda r: r["block"])
        value = int(rows[0]["crc"])
        for r in rows[1:]:
            value = combine_crc(value, int(r["crc"]), 4 * int(r["n"]))
        return value

    return pieces.map(one)


def read(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 per document, all taken from the files.

    Blocks are decoded independently of each other. A document is listed with every block
    it lies in, and the checksums of its pieces are put together.
    """
    rows = index(spark, path)
    last = F.floor((F.col("offset") + F.col("n_ids") - 1) / block_ids)
    entries = rows.select(
        "shard", F.explode(F.sequence(F.floor(F.col("offset") / block_ids), last)).alias("block"),
        F.struct("row", "offset", "n_ids").alias("doc"),
    )
    listed = entries.groupBy("shard", "block").agg(F.collect_list("doc").alias("docs"))  # at most block_ids of them
    blocks = spark.read.schema(RECORDS).parquet(f"{path}/records").where("kind = 1").select(
        "shard", F.col("row").alias("block"), (F.col("row") * block_ids).alias("first"), "n_ids", "planes"
    )
    pieces = blocks.join(listed, ["shard", "block"]).mapInArrow(_crc_pieces, "shard int, row long, block long, n long, crc long")
    piece = F.struct("block", "n", "crc")
    whole = pieces.groupBy("shard", "row").agg(F.sum("n").alias("n_tokens"), F.collect_list(piece).alias("pieces"))
    sums = whole.select("shard", "row", "n_tokens", _joined_crc("pieces").alias("ids_crc32"))
    return rows.join(sums, ["shard", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to the shared folder and return what the files say of each."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-planes")
    write(docs, path, tokenizer)
    return read(spark, path)
