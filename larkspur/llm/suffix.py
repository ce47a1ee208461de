"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task cuts its documents into shards of a bounded number of words (a single longer
document is a shard of its own), builds the suffix array of the shard and binary-searches the test
suffixes in it. ``find``, and so the query and the pipeline, search the windows only: suffixes
cut to ``WINDOW`` words, which gives all places of every window. ``longest_matches`` searches
every whole suffix for its longest verbatim match; no query calls it. Words outside the test vocabulary end a match, so suffixes that
begin with one are not put into the array.

Documents are never shuffled. The test items are shipped to the tasks in blocks of at most
``BLOCK_CHARS`` characters; more items make more blocks, each one scan, whose hits are put
together per document.

Defined cases: a missing or empty text has no words, no hits and stays; a missing or empty
item has no window; an item without an id is named ``""``; items with equal ids count once;
repeated documents are judged row by row; empty tables give no hits. Extra columns are kept
by ``clean`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from larkspur.llm.shipping import opened, shipped
from larkspur.llm.text import as_bytes, carried, text_of

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_CHARS = 1 << 24

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: A-Z become a-z, every byte outside the words becomes a space.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all characters beyond ASCII."""
    return as_bytes(text).translate(_TABLE).split()


class TestSet:
    """The windows and suffixes of a block of items, as ids of the items' own words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        owners, starts, lengths, flat, item_at = [], [], [], [], 0
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for start in range(len(ids)):
                owners.append(place[name])
                starts.append(item_at + start)
                lengths.append(len(ids) - start)
            flat += ids
            item_at += len(ids)
        self.owner = np.array(owners, dtype=np.int64)
        self.start = np.array(starts, dtype=np.int64)
        self.length = np.array(lengths, dtype=np.int64)  # words from here to the end of the item
        self.longest = max(lengths, default=0)
        self.flat = np.array(flat + [0] * (self.longest + window), dtype=np.int64)
        first = np.concatenate([[True], self.start[1:] + self.length[1:] != self.start[:-1] + self.length[:-1]]) if lengths else np.zeros(0, bool)
        # A window begins where enough words follow; a short item is one window.
        self.is_window = (self.length >= window) | (first & (self.length > 0))
        self.window = np.minimum(self.length, window)
        self.item_start = self.start - np.maximum.accumulate(np.where(first, self.start, 0)) if lengths else self.start


class Shard:
    """The suffix array of some documents over the vocabulary of a test set."""

    def __init__(self, tests: TestSet, docs: list[list[bytes]]):
        self.tests = tests
        counts = np.array([len(d) for d in docs], dtype=np.int64)
        self.stops = np.cumsum(counts + 1)  # one 0 between documents
        self.starts = self.stops - counts - 1
        self.counts = counts
        get, ids = tests.vocabulary.get, []
        for doc in docs:
            ids += [get(w, 0) for w in doc]
            ids.append(0)
        self.total = len(ids)
        self.ids = np.array(ids + [0] * (tests.longest + 1), dtype=np.int64)
        self.order = self._sorted()

    def _sorted(self) -> np.ndarray:
        ids = self.ids
        stops = np.flatnonzero(ids == 0)
        at = np.flatnonzero(ids)
        if not len(at):
            return at
        run = stops[np.searchsorted(stops, at)] - at  # words until a match must end
        rank, depth = ids.copy(), 1
        most = min(int(run.max()), self.tests.longest)
        while depth < most:
            following = np.where(run > depth, rank[np.minimum(at + depth, len(ids) - 1)], 0)
            _, dense = np.unique(rank[at] * (int(rank.max()) + 1) + following, return_inverse=True)
            rank[at] = dense + 1
            depth *= 2
        return at[np.argsort(rank[at], kind="stable")]

    def _bound(self, start: np.ndarray, length: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of all patterns at once: the first suffix not below (above) each."""
        low, high = np.zeros(len(start), np.int64), np.full(len(start), len(self.order), np.int64)
        flat = self.tests.flat
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            at, begin, left = self.order[middle], start[open_], length[open_]
            sign = np.zeros(len(open_), np.int64)
            undecided = np.arange(len(open_))
            for j in range(int(left.max())):
                undecided = undecided[left[undecided] > j]
                if not undecided.size:
                    break
                difference = self.ids[at[undecided] + j] - flat[begin[undecided] + j]
                sign[undecided] = np.sign(difference)
                undecided = undecided[difference == 0]
            right = sign <= 0 if upper else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, place in the shard, length) of every occurrence of every window."""
        tests = self.tests
        chosen = np.flatnonzero(tests.is_window)
        start, length = tests.start[chosen], tests.window[chosen]
        low, high = self._bound(start, length, False), self._bound(start, length, True)
        n = high - low
        which = np.repeat(np.arange(len(chosen)), n)
        within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return tests.owner[chosen][which], self.order[low[which] + within], length[which]

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """Per test suffix: words of its longest verbatim match, and where that begins."""
        tests = self.tests
        best, place = np.zeros(len(tests.start), np.int64), np.zeros(len(tests.start), np.int64)
        if not len(self.order):
            return best, place
        near = self._bound(tests.start, tests.length, False)
        for side in (near - 1, near):
            at = self.order[np.clip(side, 0, len(self.order) - 1)]
            same = np.zeros(len(at), np.int64)
            going = np.arange(len(at))
            for j in range(tests.longest):
                going = going[tests.length[going] > j]
                going = going[self.ids[at[going] + j] == tests.flat[tests.start[going] + j]]
                if not going.size:
                    break
                same[going] = j + 1
            better = same > best
            best[better], place[better] = same[better], at[better]
        return best, place

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.stops, place, side="right")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Bounded groups of rows with the words of their texts."""
    for batch in batches:
        begin, size, docs = 0, 0, []
        for i, text in enumerate(text_of(batch)):
            docs.append(words(text.as_py()))
            size += len(docs[-1])
            if size >= SHARD_WORDS:
                yield batch.slice(begin, i + 1 - begin), docs
                begin, size, docs = i + 1, 0, []
        if docs:
            yield batch.slice(begin), docs


def _hits(shared, digests: bool = False):
    """Hits per row; with digests also 128 bits of each text, to put the blocks' hits together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = opened(shared)
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for rows, docs in _shards(batches):
            shard = Shard(tests, docs)
            owner, place, length = shard.occurrences()
            change = np.zeros(shard.total + 1, np.int64)
            np.add.at(change, place, 1)
            np.add.at(change, place + length, -1)
            covered = np.cumsum(change) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], covered])))
            begins, ends = edges[::2], edges[1::2]
            spans: list[list] = [[] for _ in docs]
            for doc, begin, end in zip(shard.document(begins).tolist(), begins.tolist(), ends.tolist()):
                spans[doc].append({"start": begin - int(shard.starts[doc]), "stop": end - int(shard.starts[doc])})
            found: list[list] = [[] for _ in docs]
            for doc, item in np.unique(np.stack([shard.document(place), owner], axis=1), axis=0).tolist():
                found[doc].append(tests.names[item])
            columns = {
                "row": rows.column("row"), "n_words": pa.array(shard.counts),
                "spans": pa.array(spans, spans_type), "items": pa.array(found, pa.list_(pa.string())),
            }
            if digests:
                columns["digest"] = pa.array([xxhash.xxh3_128_digest(as_bytes(text.as_py())) for text in text_of(rows)], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _longest(shared, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = opened(shared)
        for rows, docs in _shards(batches):
            shard = Shard(tests, docs)
            best, place = shard.longest()
            chosen = np.flatnonzero(best >= np.minimum(window, tests.length))
            chosen = chosen[best[chosen] > 0]
            doc = shard.document(place[chosen])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tests.names[i] for i in tests.owner[chosen]], pa.string()),
                    pa.array(tests.item_start[chosen], pa.int64()), pa.array(best[chosen], pa.int64()),
                    rows.column("row").take(pa.array(doc)), pa.array(place[chosen] - shard.starts[doc], pa.int64()),
                ],
                names=["item_id", "item_start", "n_words", "doc_id", "doc_start"],
            )

    return run


def _blocks(items: DataFrame, window: int, block_chars: int):
    """The test items as broadcast blocks of bounded size."""
    context = items.sparkSession.sparkContext
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").where(F.length("text") > 0)
    chars = named.agg(F.sum(F.length("text") + F.length("name"))).first()[0] or 0
    n = int(chars // block_chars) + 1
    if n == 1:
        return [shipped(context, TestSet([tuple(r) for r in named.collect()], window))]
    dealt = named.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(n)))
    return [
        shipped(context, TestSet([tuple(r) for r in dealt.where(F.col("block") == k).select("name", "text").collect()], window))
        for k in range(n)
    ]


def _schema(row: StructType) -> StructType:
    span = StructType([StructField("start", LongType()), StructField("stop", LongType())])
    return StructType(
        [StructField("row", row), StructField("n_words", LongType()), StructField("spans", ArrayType(span)),
         StructField("items", ArrayType(StringType()))]
    )


def _merged(spans):
    """Union of half-open spans, as sorted disjoint spans."""
    ordered = F.array_sort(spans)
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["start"] <= last["stop"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(ordered, empty, add)


def find(docs: DataFrame, items: DataFrame, carry: list[str] | None = None, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: ``row`` (the carried columns), n_words, hit spans of words, and item names."""
    plain = carried(docs, carry or docs.columns)
    schema = _schema(plain.schema["row"].dataType)
    blocks = _blocks(items, window, block_chars)
    if len(blocks) == 1:
        return plain.mapInArrow(_hits(blocks[0]), schema)
    scans = [plain.mapInArrow(_hits(block, True), StructType([*schema, StructField("digest", BinaryType())])) for block in blocks]
    # Equal rows with equal texts have equal hits, so one of them stands for all while blocks are put together.
    key = F.struct(F.to_json("row").alias("json"), "digest").alias("key")
    hits = None
    for scan in scans:
        part = scan.where(F.size("items") > 0).groupBy(key).agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
        hits = part if hits is None else hits.unionByName(part)
    joined = hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    base = scans[0].select("row", "n_words", key)
    spans = F.coalesce(_merged(F.col("spans")), F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    return base.join(joined, "key", "left").select(
        "row", "n_words", spans.alias("spans"), F.array_distinct(F.coalesce("items", F.array().cast("array<string>"))).alias("items")
    )


def longest_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, item_start, n_words, doc_id, doc_start: a longest verbatim match of each test suffix.

    Suffixes whose longest match is below the window are left out. Of equally long matches
    the one with the smallest doc_id and place counts.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("row"), "text")
    schema = "item_id string, item_start long, n_words long, doc_id long, doc_start long"
    found = None
    for block in _blocks(items, window, block_chars):
        part = plain.mapInArrow(_longest(block, window), schema)
        found = part if found is None else found.unionByName(part)
    best = F.min_by(F.struct("n_words", "doc_id", "doc_start"), F.struct(-F.col("n_words"), "doc_id", "doc_start"))
    return found.groupBy("item_id", "item_start").agg(best.alias("best")).select("item_id", "item_start", "best.*")


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any occurrence of a test window, with all their columns."""
    return find(docs, items, window=window).where(F.size("spans") == 0).select("row.*")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of ``find`` per document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    names = F.array_join(F.array_sort("items"), ",")
    return find(docs, items, carry=["doc_id"]).select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH item AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id, ws FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM item)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
place AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM doc),
gram AS (
  SELECT doc_id, p, n, array_to_string(ws[p:p + n - 1], ' ') AS gram FROM place, (SELECT DISTINCT n FROM win) WHERE p + n - 1 <= len(ws)),
hit AS (SELECT doc_id, p, gram.n, item_id FROM gram JOIN win ON gram.gram = win.gram AND gram.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS w FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered ON covered.doc_id = doc.doc_id LEFT JOIN named ON named.doc_id = doc.doc_id
"""
