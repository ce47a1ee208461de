"""How far each source of a language departs from the others, term by term.

Terms travel as digests of fixed width; their strings stay where they were found until the
last rows are known.

1. Tasks count the terms of their documents per (lang, source) and write the counts beside the
   digests, and each spelling once. Only numbers and digests are shuffled to sum them.
2. Digests with enough documents are kept. Their least and greatest spelling are compared: a
   digest with two spellings stands for several terms. The documents are counted once more, by
   spelling, for such digests only, so all later keys are (digest, part), where the part is
   empty unless the digest was split. A task compares the bytes of all terms it meets, so no
   second spelling stays unseen.
3. Pairs of sources are compared in tiles of ``TILE`` sources by buckets of terms. A task holds
   the probabilities of one tile and bucket and adds up all its pairs, so no pair is emitted per
   term. Terms that neither source has add the same number each and are multiplied out.
4. Strings are joined to the rows that can be among the ``TOP`` of their group, no others.

A source may hold most of the documents: counts meet per task before they are shuffled, and no
step puts the rows of a source together. All arithmetic is in integers.

Defined cases: a missing text has no terms, a missing lang or source is the empty one, and groups
without terms still take part; rows that repeat are documents of their own; a language without
kept terms gives pairs of value 0; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.bounds import checked_small
from larkspur.operators.ranks import running_totals
from larkspur.session import durable, scratch_path

MIN_DOCS = 10
TOP = 10
BASE = 1_000_000_000
#: Counts, and spellings, that a task holds before it writes or forgets them.
HELD = 1 << 19
SPELLED = 1 << 19
#: Rows of a batch that leaves a task.
BATCH_ROWS = 1 << 15
#: Bytes of text that a task works on at once, and the length from which a term is hashed as a whole.
PIECE, LONG = 1 << 18, 1 << 17
TILE = 256
BUCKET_ROWS = 200_000
#: Entries of the matrix that a task builds at once.
CELLS = 1 << 21
DIGEST_BITS = 64

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_GAP = re.compile(rb"[^a-z\x80-\xff]")
#: A random number for every byte of a term, and an odd step, for the digest and for its check.
_CODES = [np.where(_LETTER, np.random.default_rng(seed).integers(1, 1 << 64, 256, dtype=np.uint64), 0).astype(np.uint64) for seed in (13, 14)]
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_COUNTS = "g long, digest long, term string, n long, docs long"

Batches = Iterator[pa.RecordBatch]
Columns = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _narrowed(digests: np.ndarray, bits: int) -> np.ndarray:
    return (digests >> np.uint64(64 - bits)).view(np.int64)


class Terms:
    """The terms of lower-case texts put one after the other: place, number of the text, digest and check.

    Both hashes are polynomials over the bytes' codes, from running sums; those of long terms
    are a hash of the whole. Terms of one digest with different checks are different.
    """

    def __init__(self, texts: list[bytes], bits: int):
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(self.bytes)
        bounds = np.cumsum([0, *map(len, texts)])
        letter = _LETTER[self.bytes]
        first, last = letter.copy(), letter.copy()
        first[1:] &= ~letter[:-1]
        last[:-1] &= ~letter[1:]
        inner = bounds[(bounds > 0) & (bounds < n)]  # terms end with their text
        first[inner] = letter[inner]
        last[inner - 1] = letter[inner - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(bounds, self.start, side="right") - 1
        hashes = [self._hash(codes, step) for codes, step in zip(_CODES, _STEPS)]
        for i in np.flatnonzero(self.end - self.start > LONG).tolist():
            hashes[0][i], hashes[1][i] = whole_hash(self.bytes[self.start[i] : self.end[i]].tobytes())
        self.digest, self.check = _narrowed(hashes[0], bits), hashes[1]

    def _hash(self, codes: np.ndarray, step: int) -> np.ndarray:
        n = len(self.bytes)
        size = max(n, 2 * PIECE) + 1  # one size for all pieces but long ones
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes[self.bytes] * _powers(step, size)[:n], out=sums[1:])
        mixed = (sums[self.end] - sums[self.start]) * _powers(pow(step, -1, 1 << 64), size)[self.start]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ mixed >> np.uint64(29)

    def spellings(self, some: np.ndarray) -> pa.Array:
        start, size = self.start[some], self.end[some] - self.start[some]
        upto = np.concatenate([[0], np.cumsum(size)])
        data = self.bytes[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]
        return pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def whole_hash(term: bytes) -> tuple[int, int]:
    return divmod(xxhash.xxh3_128_intdigest(term), 1 << 64)


def _summed_by(group: np.ndarray, digests: np.ndarray, n: np.ndarray, docs: np.ndarray) -> Columns:
    """The same columns with one row per (group, digest)."""
    known, code = np.unique(digests, return_inverse=True)
    pairs, row = np.unique(group * len(known) + code, return_inverse=True)
    held = [np.bincount(row, weights=v).astype(np.int64) for v in (n, docs)]
    return pairs // len(known), known[pairs % len(known)], *held


def _rows(g, digests, terms, n, docs) -> pa.RecordBatch:
    size = len(digests)
    arrays = [pa.nulls(size, pa.int64()) if v is None else pa.array(v, pa.int64()) for v in (g, digests, n, docs)]
    arrays.insert(2, pa.nulls(size, pa.string()) if terms is None else pa.array(terms, pa.string()))
    return pa.RecordBatch.from_arrays(arrays, names=["g", "digest", "term", "n", "docs"])


class _Task:
    """Counts by group and digest, and the spellings that a task has passed on."""

    def __init__(self, bits: int):
        self.bits = bits
        self.parts: list[Columns] = []
        self.new: list[pa.RecordBatch] = []  # spellings to be written
        self.forget()

    def forget(self) -> None:
        self.seen, self.checks = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

    def unseen(self, digests: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Which of the distinct digests are new, or come with another spelling; they count as seen from now on."""
        place = np.searchsorted(self.seen, digests)
        near = np.minimum(place, max(len(self.seen) - 1, 0))
        known = self.seen[near] == digests if len(self.seen) else np.zeros(len(digests), dtype=bool)
        fresh = ~known
        other = known & (self.checks[near] != checks) if len(self.seen) else known
        self.seen, self.checks = np.insert(self.seen, place[fresh], digests[fresh]), np.insert(self.checks, place[fresh], checks[fresh])
        if len(self.seen) >= SPELLED:
            self.forget()
        return np.flatnonzero(fresh | other)

    def counted(self, group: np.ndarray, texts: list[bytes]) -> Columns | None:
        """Counts of the terms of texts, with one group number each; keeps spellings not passed on yet."""
        terms = Terms(texts, self.bits)
        if not len(terms.start):
            return None
        known, first, code = np.unique(terms.digest, return_index=True, return_inverse=True)
        pairs, n = np.unique(terms.text * len(known) + code, return_counts=True)  # one per text and term
        unlike = np.flatnonzero(terms.check != terms.check[first[code]])
        some = np.concatenate([first[self.unseen(known, terms.check[first])], unlike])
        if len(some):
            self.new.append(_rows(None, terms.digest[some], terms.spellings(some), None, None))
        return _summed_by(group[pairs // len(known)], known[pairs % len(known)], n, np.ones_like(n))

    def long_text(self, group: int, text: bytes) -> Columns | None:
        """The same for one text that is too long to be worked on at once."""
        parts, at, number = [], 0, np.array([group])
        while at < len(text):
            stop = min(at + PIECE, len(text))
            while at < stop < len(text) and _LETTER[text[stop]] and _LETTER[text[stop - 1]]:
                stop -= 1
            if stop > at:
                part = self.counted(number, [text[at:stop]])
            else:  # a single term fills the piece
                gap = _GAP.search(text, at)
                stop = gap.start() if gap else len(text)
                key, check = (np.array([h], dtype=np.uint64) for h in whole_hash(text[at:stop]))
                key, one = _narrowed(key, self.bits), np.ones(1, dtype=np.int64)
                if len(self.unseen(key, check)):
                    self.new.append(_rows(None, key, [text[at:stop].decode()], None, None))
                part = (number, key, one, one)
            parts += [part] if part else []
            at = stop
        if not parts:
            return None
        g, digests, n, docs = _summed_by(*[np.concatenate(c) for c in zip(*parts)])
        return g, digests, n, np.ones_like(docs)

    def add(self, part: Columns | None) -> None:
        if part is not None:
            self.parts.append(part)
            if len(self.parts) >= 16:
                self.merge()

    def merge(self) -> None:
        if self.parts:
            self.parts = [_summed_by(*[np.concatenate(c) for c in zip(*self.parts)])]

    def ready(self) -> Batches:
        """Spellings not passed on yet, and the counts if there are many."""
        yield from self.new
        self.new = []
        if self.parts and len(self.parts[0][0]) >= HELD:
            yield from self.taken()

    def taken(self) -> Batches:
        self.merge()
        for g, digests, n, docs in self.parts:
            for at in range(0, len(g), BATCH_ROWS):
                own = slice(at, at + BATCH_ROWS)
                yield _rows(g[own], digests[own], None, n[own], docs[own])
        self.parts = []


def _counted(bits: int) -> Callable[[Batches], Batches]:
    """Rows of counts (without term), and a row of every spelling of a digest (without counts)."""

    def run(batches: Batches) -> Batches:
        task = _Task(bits)
        for batch in batches:
            group = batch.column("g").to_numpy()
            waiting, at, size = [], [], 0
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                lowered = (text.as_py() or b"").translate(_LOWER)
                if len(lowered) > PIECE:
                    task.add(task.long_text(int(group[i]), lowered))
                    continue
                waiting.append(lowered)
                at.append(i)
                size += len(lowered)
                if size >= PIECE:
                    task.add(task.counted(group[at], waiting))
                    waiting, at, size = [], [], 0
                    yield from task.ready()
            if waiting:
                task.add(task.counted(group[at], waiting))
            yield from task.ready()
        yield from task.taken()

    return run


def _spelled(bits: int) -> Callable[[Batches], Batches]:
    """Counts by spelling, for digests that stand for several terms."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for g, text in zip(batch.column("g").to_pylist(), batch.column("text").cast(pa.binary())):
                lowered = (text.as_py() or b"").translate(_LOWER)
                own = Counter(m.group() for m in _TERM.finditer(lowered))
                for term, n in own.items():
                    one = _Task(bits).long_text(g, term)
                    yield _rows(one[0], one[1], [term.decode()], [n], one[3])

    return run


def _groups(docs: DataFrame) -> DataFrame:
    """lang, source, their number g, and the number l of the lang, which is its first g."""
    found = docs.select("lang", "source").distinct()
    numbered = durable(running_totals(found, [], [F.col("lang"), F.col("source")], {"g": F.lit(1).cast("long")}, max_rows=0))
    return numbered.join(numbered.groupBy("lang").agg(F.min("g").alias("l")), "lang")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"divergence-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def term_counts(numbered: DataFrame, groups: DataFrame, min_docs: int = MIN_DOCS, bits: int = DIGEST_BITS) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms, and their spellings, from (g, text) rows.

    The first frame has l, g, digest, part, n and c (the lang's count), the second one digest
    and term of the digests that were not split.
    """
    langs = checked_small(groups.select("g", "l"))
    partial = _stored(numbered.mapInArrow(_counted(bits), _COUNTS), "partial")
    counts = _kept(partial.where(F.col("g").isNotNull()).drop("term").join(langs, "g"), min_docs, "digest")
    counts = _stored(counts.withColumn("part", F.lit("")), "rows")

    spellings = partial.where(F.col("term").isNotNull()).select("digest", "term")
    spellings = spellings.join(counts.select("digest").distinct(), "digest", "left_semi").distinct()
    extremes = _stored(spellings.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("other")), "terms")
    split = durable(extremes.where(F.col("term") != F.col("other")).select("digest"))
    if split.isEmpty():
        return counts, extremes.select("digest", "term")
    small = checked_small(split)
    again = numbered.mapInArrow(_spelled(bits), _COUNTS).join(small, "digest", "left_semi").withColumnRenamed("term", "part")
    apart = _kept(again.join(langs, "g"), min_docs, "digest", "part")
    rows = counts.join(small, "digest", "left_anti").unionByName(apart.select(*counts.columns))
    return _stored(rows, "split"), extremes.join(small, "digest", "left_anti").select("digest", "term")


def _kept(counts: DataFrame, min_docs: int, *keys: str) -> DataFrame:
    """l, g, keys, n and c of the terms in enough documents; one shuffle, by lang and term, serves all of it."""
    dealt = counts.repartition("l", *keys)
    summed = dealt.groupBy("l", *keys, "g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("l", *keys)  # a row per source
    whole = summed.select("l", "g", *keys, "n", F.sum("n").over(term).alias("c"), F.sum("docs").over(term).alias("in_docs"))
    return whole.where(F.col("in_docs") >= min_docs).drop("in_docs")


def _share(count: str, total: str) -> Column:
    """1 + floor(BASE * (count + 2) / (total + 2 * v)), exactly; 0 without kept terms."""
    exact = f"cast({BASE} as decimal(10, 0)) * cast({count} + 2 as decimal(20, 0)) div cast({total} + 2 * v as decimal(20, 0))"
    return F.expr(f"case when v = 0 then 0 else 1 + {exact} end").cast("long")


def _gap(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def group_table(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Per (lang, source): its totals, the share p0 of a term it lacks, its place r, and the lang's tiles and buckets."""
    langs = rows.select("l", "digest", "part", "c").distinct().groupBy("l").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("lang_n"))
    sizes = rows.groupBy("g").agg(F.sum("n").alias("source_n"), F.count(F.lit(1)).alias("held"))
    full = groups.join(langs, "l", "left").join(sizes, "g", "left")
    full = full.na.fill(0, ["v", "lang_n", "source_n", "held"])
    sources = full.groupBy("l").agg(F.count(F.lit(1)).alias("sources"), F.sum("held").alias("lang_held"))
    return durable(
        full.withColumn("p0", _share("0", "source_n")).join(sources, "l").select(
            "l", "g", "lang", "source", "v", "lang_n", "source_n", "p0", (F.col("g") - F.col("l")).alias("r"), "sources", "lang_held"
        )
    )


def _pair_sums(tile: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Sums of one tile and bucket: a, b, total over the terms that either has, and their number."""

    def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = int(rows["i"].iat[0]), int(rows["j"].iat[0])
        bare = rows["digest"].isna()
        base = rows.loc[bare, ["r", "p"]].drop_duplicates("r").sort_values("r")
        places, p0 = base["r"].to_numpy(), base["p"].to_numpy()
        own = rows[~bare]
        at = np.searchsorted(places, own["r"].to_numpy())
        term = own.groupby(["digest", "part"], sort=False).ngroup().to_numpy()
        order = np.argsort(term, kind="stable")
        at, term, p = at[order], term[order], own["p"].to_numpy()[order]
        k, n_terms = len(places), int(term[-1]) + 1 if len(term) else 0
        one = np.zeros((k, k), dtype=np.int64)  # over the terms of the row's source
        both, shared = np.zeros_like(one), np.zeros_like(one)
        step = max(1, CELLS // max(k, 1))
        for start in range(0, n_terms, step):
            a, b = np.searchsorted(term, [start, start + step])
            matrix = np.repeat(p0[:, None], min(step, n_terms - start), axis=1)
            present = np.zeros(matrix.shape, dtype=bool)
            matrix[at[a:b], term[a:b] - start] = p[a:b]
            present[at[a:b], term[a:b] - start] = True
            for s in range(k):
                mine = np.flatnonzero(present[s])
                if not len(mine):
                    continue
                found, seen = gaps(matrix[s, mine], matrix[:, mine]), present[:, mine]
                one[s] += found.sum(axis=1)
                both[s] += np.where(seen, found, 0).sum(axis=1)
                shared[s] += seen.sum(axis=1)
        alone = np.diagonal(shared)
        first, second = np.triu_indices(k, 1)
        if left != right:  # pairs inside one block belong to its own tile
            cross = places[first] // tile != places[second] // tile
            first, second = first[cross], second[cross]
        return pd.DataFrame({
            "l": rows["l"].iat[0], "a": places[first], "b": places[second],
            "total": one[first, second] + one[second, first] - both[first, second],
            "terms": alone[first] + alone[second] - shared[first, second],
        })

    return run


def pair_values(rows: DataFrame, table: DataFrame, tile: int = TILE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """l, a, b (places of two sources, a < b) and value, the sum over all kept terms."""
    cut = table.withColumn("buckets", F.expr(f"lang_held div {bucket_rows} + 1")).withColumn("tiles", F.expr(f"(sources - 1) div {tile} + 1"))
    small = checked_small(cut.select("g", "r", "v", "source_n", "p0", "buckets", "tiles"))
    bucket = F.pmod(F.xxhash64("digest", "part"), F.col("buckets"))
    terms = rows.join(small, "g").select("l", "r", "tiles", bucket.alias("bucket"), _share("n", "source_n").alias("p"), "digest", "part")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))
    bare = cut.select("l", "r", "tiles", every.alias("bucket"), F.col("p0").alias("p"),
                      F.lit(None).cast("long").alias("digest"), F.lit("").alias("part"))
    met = terms.unionByName(bare).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    block = F.expr(f"r div {tile}")
    met = met.select("l", "bucket", F.least(block, "other").alias("i"), F.greatest(block, "other").alias("j"), "r", "p", "digest", "part")
    sums = met.groupBy("l", "bucket", "i", "j").applyInPandas(_pair_sums(tile), "l long, a long, b long, total long, terms long")
    sums = sums.groupBy("l", "a", "b").agg(F.sum("total").alias("total"), F.sum("terms").alias("terms"))

    ends = checked_small(table.select("l", "r", "v", "p0"))
    sums = sums.join(ends.select("l", F.col("r").alias("a"), "v", F.col("p0").alias("p")), ["l", "a"])
    sums = sums.join(ends.select("l", F.col("r").alias("b"), F.col("p0").alias("q")), ["l", "b"])
    rest = F.when(F.col("v") > F.col("terms"), (F.col("v") - F.col("terms")) * _gap("p", "q")).otherwise(F.lit(0).cast("long"))
    return sums.select("l", "a", "b", (F.col("total") + rest).alias("value"))


def pair_part(rows: DataFrame, table: DataFrame, tile: int = TILE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each source against each other one of its lang, ranked."""
    values = pair_values(rows, table, tile, bucket_rows)
    both = values.select("l", "value", F.explode(F.array(
        F.struct(F.col("a").alias("r"), F.col("b").alias("o")), F.struct(F.col("b").alias("r"), F.col("a").alias("o")))).alias("e"))
    names = checked_small(table.select("l", "r", "lang", "source"))
    named = both.select("l", "value", "e.*").join(names, ["l", "r"]).join(
        names.select("l", F.col("r").alias("o"), F.col("source").alias("item")), ["l", "o"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def term_part(rows: DataFrame, terms: DataFrame, table: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a source has more of than its lang, by how much, down to rank ``top``."""
    small = checked_small(table.select("g", "lang", "source", "v", "lang_n", "source_n"))
    over = rows.join(small, "g").select("l", "g", "lang", "source", "digest", F.col("part").alias("spelled"),
                                        _share("n", "source_n").alias("p"), _share("c", "lang_n").alias("q"))
    over = over.where("p > q").withColumn("value", _gap("p", "q"))
    # Ties at the last rank are settled by spelling, so all that reach it get their strings.
    by_digest = Window.partitionBy("g").orderBy(F.desc("value"), "digest", "spelled")
    least = over.select("g", "value", "digest", "spelled").withColumn("k", F.row_number().over(by_digest)).where(F.col("k") <= top)
    least = checked_small(least.groupBy("g").agg(F.min("value").alias("least")))
    reach = over.join(least, "g").where("value >= least")
    found = reach.join(terms, "digest", "left").withColumn("item", F.when(F.col("spelled") != "", F.col("spelled")).otherwise(F.col("term")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = DIGEST_BITS, tile: int = TILE, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = durable(_groups(plain))
    numbered = plain.join(checked_small(groups), ["lang", "source"]).select("g", "text")
    rows, terms = term_counts(numbered, groups, min_docs, bits)
    table = group_table(groups, rows)
    return pair_part(rows, table, tile, bucket_rows).unionByName(term_part(rows, terms, table, top))


def report(docs: DataFrame) -> DataFrame:
    return audit(docs)


ORACLE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
tok AS (SELECT d, lang, source, unnest(ws) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS c FROM tok GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY lang, source, term),
dense AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(n, 0) AS n, c FROM grp JOIN kept ON grp.lang = kept.lang
  LEFT JOIN cnt ON cnt.lang = grp.lang AND cnt.source = grp.source AND cnt.term = kept.term),
prob AS (
  SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER w + 2 * count(*) OVER w))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (c + 2) // (sum(c) OVER w + 2 * count(*) OVER w))::BIGINT AS q
  FROM dense WINDOW w AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM prob a JOIN prob b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM prob WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
