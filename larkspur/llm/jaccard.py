"""Jaccard self-join of word shingle sets with a token-group matrix, as components.

Texts with equal sets form one class. Classes whose rarest shingles are shared with another
class are put into groups of at most 64 similar classes; a group stores the union of its
members' shingles with a 64-bit row of members per shingle. A query's overlap with the
union bounds its overlap with every member, and only groups that pass the bound are opened.

1. One scan builds a sketch of which shingles occur twice (see ``countmin``) and a table of
   2 ** RARITY_BITS hashed counts. They order shingles, single and rare first; any fixed order
   would be right, this one lets most documents end here.
2. Per document: the class, the set size, and those of its first n - ceil(threshold * n) + 1
   shingles that may occur twice. Two sets above the threshold share at least one of them, so
   a document with none links with no other text and sends no set.
3. Classes that share such a shingle are ordered by their most common shared one and their
   size, and cut into groups. Groups are joined inside; the leaders of linked sets, and of what
   one shingle put into several groups, go on to the next level, where leaders are grouped again. So a family of n near copies falls
   together in n / 64 + n / 64^2 + ... groups and never makes n^2 pairs.
4. A group visits another one if a shared prefix shingle, the sizes, the numbers of stored
   shingles (no overlap is larger) and their linked sets allow it; a member is a query there if
   its own prefix, sizes and linked set do. Prefixes meet groups as a whole, one row per visit.
   Groups with many visitors are dealt out by salt. Only one link per visit and linked set is
   kept, so links grow with the rows.
5. Components by large-star and small-star steps over the links of leaders.

Shingles are compared by 64-bit hashes, classes by 128 bits. Classes are named by the number of
one of their rows.

Defined cases: a missing or empty text has an empty set, links with nothing and is its own
component; fewer words than a shingle are one shingle; documents without an id take part and
never name a component that has another one; equal rows share a class; an empty table gives
no rows. ``first_of_each`` keeps all columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.countmin import COUNTS, RECORD, collected, partial, record_batch, seen_twice, squeezed, width_bits
from larkspur.llm.text import WORD, as_bytes
from larkspur.session import durable, scratch_path

SHINGLE = 3
PERCENT = 90
RARITY_BITS = 20
GROUP = 64
GROUP_SHINGLES = 1 << 22
LEVELS = 3
VISITS = 4096
KEYS = 1 << 20
MEMO_WORDS = 1 << 17
COUNT_SLICES = 16
PIECE_SHINGLES = 1 << 19

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class WordHashes(dict):
    """A 64-bit hash per word; ``MEMO_WORDS`` bounds the look-up table only."""

    def __missing__(self, word: bytes) -> bytes:
        value = xxhash.xxh3_64_digest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _C
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = as_bytes(text).lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    values = np.frombuffer(b"".join(map(hashes.__getitem__, words)), dtype="<u8")
    width = min(size, len(values))
    mixed = np.full(len(values) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        mixed = mixed * _A + _scrambled(values[j : len(values) - width + 1 + j] ^ _B)
    return np.unique(_scrambled(mixed))


def set_class(tokens: np.ndarray) -> bytes | None:
    """128 bits that equal sets share."""
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def _prints(tokens: np.ndarray) -> np.ndarray:
    return np.stack([tokens, _scrambled(tokens * _A)], axis=1)


def _sketched(size: int, bits: int):
    """Records of the sketch, and per task how many documents have a shingle of each counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, pending, held = WordHashes(), np.zeros(1 << RARITY_BITS, np.int64), [], 0
        shift = np.uint64(64 - RARITY_BITS)
        for batch in batches:
            for text in batch.column("text"):
                pending.append(shingles(text.as_py(), hashes, size))
                held += len(pending[-1])
                if held > PIECE_SHINGLES:
                    tokens = np.concatenate(pending)
                    counts += np.bincount((tokens >> shift).astype(np.int64), minlength=len(counts))
                    yield record_batch(partial(_prints(tokens), bits))
                    pending, held = [], 0
        if held:
            tokens = np.concatenate(pending)
            counts += np.bincount((tokens >> shift).astype(np.int64), minlength=len(counts))
            yield record_batch(partial(_prints(tokens), bits))
        if counts.any():
            slices = np.split(counts.astype("<u8"), COUNT_SLICES)
            yield record_batch([{"row": COUNTS, "part": i, "slots": squeezed(c)} for i, c in enumerate(slices)])

    return run


def order_of_shingles(docs: DataFrame, size: int = SHINGLE) -> tuple[int, list[bytes], np.ndarray]:
    """The sketch, and the hashed counts as binary logarithms in steps of 1/8 (one byte each)."""
    entries = docs.agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("long"))).first()[0] or 0
    bits = width_bits(entries)
    bitmaps, sums = collected(docs.select("text").mapInArrow(_sketched(size, bits), RECORD), bits)
    totals = np.zeros((COUNT_SLICES, (1 << RARITY_BITS) // COUNT_SLICES))
    for part, counts in sums.items():
        totals[part] = counts
    return bits, bitmaps, np.minimum(np.log2(totals.ravel() + 1) * 8, 255).astype(np.uint8)


_PROFILE = "number long, doc_id long, tie long, class binary, n long, prefix array<long>, tokens binary"


def _profiled(shared, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        bits, bitmaps, weights = shared.value
        hashes = WordHashes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = batch.slice(begin, 256)
                found = [shingles(text.as_py(), hashes, size) for text in rows.column("text")]
                counts = np.array([len(t) for t in found], dtype=np.int64)
                flat = np.concatenate(found)
                maybe = seen_twice(_prints(flat), bits, bitmaps)
                weight = weights[(flat >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]
                owner = np.repeat(np.arange(len(found)), counts)
                order = np.lexsort((flat, weight, maybe, owner))  # the same order of shingles in every document
                place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
                length = counts - -(-percent * counts // 100) + 1
                kept = order[(place < length[owner]) & maybe[order]]
                cuts = np.searchsorted(owner[kept], np.arange(len(found) + 1))
                prefixes = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[kept].astype(np.int64)))
                # A shingle of one document is in no overlap, so only the others are stored, beside the full size.
                parts = np.split(maybe, np.cumsum(counts)[:-1])
                sets = [t[own].tobytes() if cuts[i + 1] > cuts[i] else None for i, (t, own) in enumerate(zip(found, parts))]
                numbers = np.arange(number, number + len(found))
                number += len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), rows.column("doc_id"), rows.column("tie"), pa.array([set_class(t) for t in found], pa.binary()),
                     pa.array(counts), prefixes, pa.array(sets, pa.binary())],
                    names=["number", "doc_id", "tie", "class", "n", "prefix", "tokens"],
                )

    return run


class Group:
    """The union of the members' stored shingles, with one bit per member for each of them, and the full sizes."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int):
        self.sizes = np.array(sizes, dtype=np.int64)
        self.percent = percent
        tokens = np.concatenate(sets)
        bits = np.repeat(np.uint64(1) << np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, bits = tokens[order], bits[order]
        new = np.ones(len(tokens), bool)
        new[1:] = tokens[1:] != tokens[:-1]
        self.union = tokens[new]
        self.rows = np.bitwise_or.reduceat(bits, np.flatnonzero(new))

    def linked(self, query: np.ndarray, size: int) -> np.ndarray:
        """Members that link with a set of that size, of which ``query`` is stored; only counted where the bound allows one."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        rows = self.rows[at[self.union[at] == query]]
        # overlap >= percent * (n + m) / (100 + percent), and m is at least percent of n
        least = max(int(self.sizes.min()), -(-self.percent * size // 100))
        if (100 + self.percent) * len(rows) < self.percent * (size + least):
            return np.zeros(0, dtype=np.int64)
        overlap = np.unpackbits(rows.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        overlap = overlap[: len(self.sizes)]
        union = self.sizes + size - overlap
        return np.flatnonzero(100 * overlap >= self.percent * union)


def _leaders(group: Group, sets: list[np.ndarray]) -> list[int]:
    """For each member, the first member of its linked set."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, tokens in enumerate(sets):
        for j in group.linked(tokens, int(group.sizes[i])).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def _grouped(percent: int):
    """Cut sorted classes into groups and join each group inside."""
    schema = pa.schema([("class", pa.int64()), ("group", pa.int64()), ("leader", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, names, sets, sizes, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def closed() -> pa.RecordBatch:
            leaders = _leaders(Group(sets, sizes, percent), sets)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array([number] * len(names), pa.int64()), pa.array([names[i] for i in leaders], pa.int64())], schema=schema
            )

        for batch in batches:
            for name, n, blob in zip(batch.column("class").to_pylist(), batch.column("n").to_pylist(), batch.column("tokens")):
                tokens = np.frombuffer(blob.as_py(), dtype="<u8")
                if names and (len(names) == GROUP or held + len(tokens) > GROUP_SHINGLES):
                    yield closed()
                    number, names, sets, sizes, held = number + 1, [], [], [], 0
                names.append(name)
                sets.append(tokens)
                sizes.append(n)
                held += len(tokens)
        if names:
            yield closed()

    return run


def _level(sets: DataFrame, percent: int) -> DataFrame:
    ordered = sets.repartitionByRange("top", "n", "class").sortWithinPartitions("top", "n", "class")
    return durable(ordered.select("class", "n", "tokens").mapInArrow(_grouped(percent), "class long, group long, leader long"))


def _few(keys: DataFrame) -> DataFrame:
    """Keys (one long each), broadcast if they are counted to be few."""
    keys = durable(keys)
    return F.broadcast(keys) if keys.count() <= KEYS else keys


def _beside(visits: DataFrame, able: DataFrame, sets: DataFrame) -> DataFrame:
    """The members (kind 0) and the visitors (kind 1) of each visited group with what ``sets`` has of them, sorted so."""
    salts = visits.groupBy("to").agg((F.floor(F.count(F.lit(1)) / VISITS) + 1).alias("salts"))
    members = able.join(salts, able["group"] == salts["to"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    members = members.select("class", "group", F.col("salt").cast("long").alias("salt"), F.lit(0).alias("kind"), "leader")
    visitors = visits.join(salts, "to").withColumn("salt", F.pmod(F.xxhash64("class"), F.col("salts")))
    visitors = visitors.select("class", F.col("to").alias("group"), "salt", F.lit(1).alias("kind"), "leader")
    rows = members.unionByName(visitors).join(sets, "class")
    return rows.repartition("group", "salt").sortWithinPartitions("group", "salt", "kind")


class Prefixes:
    """Per prefix shingle of a group the limits of the members that have it."""

    def __init__(self, members: list[tuple[int, int, int, np.ndarray]], percent: int):
        self.percent = percent
        leaders, sizes, stored = (np.array([m[i] for m in members], dtype=np.int64) for i in range(3))
        tokens = np.concatenate([m[3] for m in members])
        order = np.argsort(tokens, kind="stable")
        owner = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])[order]
        tokens = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        self.tokens = tokens[first]
        self.low, self.high = np.minimum.reduceat(sizes[owner], first), np.maximum.reduceat(sizes[owner], first)
        self.most = np.maximum.reduceat(stored[owner], first)
        self.one, self.other = np.minimum.reduceat(leaders[owner], first), np.maximum.reduceat(leaders[owner], first)

    def admits(self, leader: int, size: int, stored: int, prefix: np.ndarray) -> bool:
        """Whether a shingle of the prefix has a member that may link with such a set."""
        at = np.minimum(np.searchsorted(self.tokens, prefix), len(self.tokens) - 1)
        at = at[self.tokens[at] == prefix]
        low, percent = self.low[at], self.percent
        sizes = (100 * self.high[at] >= percent * size) & (100 * size >= percent * low)
        reach = (100 + percent) * np.minimum(self.most[at], stored) >= percent * (low + size)
        return bool((sizes & reach & ((self.one[at] != leader) | (self.other[at] != leader))).any())


def _met(percent: int):
    """Visitors that a group admits, one row each, from rows of prefixes sorted as for ``_visited``."""
    schema = pa.schema([("class", pa.int64()), ("leader", pa.int64()), ("to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, prefixes = None, [], None
        for batch in batches:
            out = []
            names = ("group", "salt", "kind", "class", "leader", "n", "stored", "prefix")
            for group, salt, kind, name, *limits, tokens in zip(*(batch.column(n) for n in names)):
                now, row = (group.as_py(), salt.as_py()), (*(x.as_py() for x in limits), tokens.values.to_numpy())
                if now != key:
                    key, members, prefixes = now, [], None
                if kind.as_py() == 0:
                    members.append(row)
                    continue
                prefixes = prefixes or Prefixes(members, percent)
                if prefixes.admits(*row):
                    out.append({"class": name.as_py(), "leader": row[0], "to": now[0]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _visited(percent: int):
    """Links of visitors, from rows sorted so that a group's members come before its visitors."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, sizes, leaders, group = None, [], [], [], None
        for batch in batches:
            out = []
            names = ("group", "salt", "kind", "leader", "n", "tokens")
            for now, salt, kind, leader, n, blob in zip(*(batch.column(n) for n in names)):
                now, tokens, leader = (now.as_py(), salt.as_py()), np.frombuffer(blob.as_py(), dtype="<u8"), leader.as_py()
                if now != key:
                    key, members, sizes, leaders, group = now, [], [], [], None
                if kind.as_py() == 0:
                    members.append(tokens)
                    sizes.append(n.as_py())
                    leaders.append(leader)
                    continue
                group = group or Group(members, sizes, percent)
                out += [{"a": leader, "b": other} for other in {leaders[j] for j in group.linked(tokens, n.as_py())} - {leader}]
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def components(links: DataFrame) -> DataFrame:
    """node and root (its smallest reachable node) for links (a, b), by star steps."""
    edges = durable(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = durable(small.where("a <> b").distinct())
        changed = new.exceptAll(edges).limit(1).count() or edges.exceptAll(new).limit(1).count()
        edges = new
        if not changed:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def profile(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """number, doc_id, tie (hash of the text), class, n, prefix and tokens per document, written once."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(order_of_shingles(docs, size))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    path = scratch_path(spark, "shingle-profile")
    plain.mapInArrow(_profiled(shared, size, percent), _PROFILE).write.parquet(path)
    return spark.read.parquet(path)


def classes_of(rows: DataFrame) -> DataFrame:
    """class, its number, and its first named row (doc_id, tie), or any row's tie without one."""
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tie"))
    found = rows.where("class is not null").groupBy("class").agg(
        F.min("number").alias("number"), F.min(named).alias("first"), F.min("tie").alias("any")
    )
    return durable(found)


def linked_classes(rows: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """class (by number) and root for the classes that link with another one."""
    active = rows.where("tokens is not null").join(classes.select("number"), "number", "left_semi")
    stored = (F.octet_length("tokens") / 8).cast("long").alias("stored")
    prefix = durable(active.select(F.col("number").alias("class"), "n", stored, F.explode("prefix").alias("token")))
    df = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = durable(prefix.join(df, "token"))
    tops = durable(shared.groupBy("class", "n").agg(F.max_by("token", F.struct("df", "token")).alias("top")))
    tokens = rows.where("tokens is not null").select(F.col("number").alias("class"), "tokens")
    sets = durable(tops.join(tokens, "class"))

    groups = _level(sets, percent)
    leader = groups.select("class", "group", "leader")
    # On go leaders of linked sets, and of what one shingle put into several groups. All others have met here whom it makes like them.
    placed = groups.join(tops.select("class", "top"), "class")
    parted = placed.groupBy("top").agg(F.min("group").alias("first"), F.max("group").alias("last")).where("first <> last").select("top")
    heads = placed.join(_few(parted), "top", "left_semi").select("leader").unionByName(groups.where("class <> leader").select("leader"))
    for _ in range(LEVELS - 1):
        heads = _few(heads.select(F.col("leader").alias("class")).distinct())
        heads = _level(sets.join(heads, "class", "left_semi"), percent)
        step = heads.select(F.col("class").alias("leader"), F.col("leader").alias("next"))
        leader = leader.join(step, "leader", "left").select("class", "group", F.coalesce("next", "leader").alias("leader"))
    leader = durable(leader)

    # Which groups may hold links between them: a shared prefix shingle, sizes and stored shingles that
    # allow a link, more than one linked set. Met as groups, so a family makes a 64th of its pairs squared.
    entry = shared.join(leader, "class").select("token", "class", "n", "stored", "group", "leader")
    limits = [F.min("n").alias("low"), F.max("n").alias("high"), F.max("stored").alias("most"), F.min("leader").alias("one"), F.max("leader").alias("other")]
    table = durable(entry.groupBy("token", "group").agg(*limits))
    # A shingle whose groups all have one leader, as in a family of near copies, holds no link that is not known.
    wide = table.groupBy("token").agg(F.min("one").alias("first"), F.max("other").alias("last")).where("first <> last").select("token")
    table = durable(table.join(wide, "token", "left_semi"))
    to = ("group", "low", "high", "most", "one", "other")
    right = table.select("token", *[F.col(c).alias(f"to_{c}") for c in to])
    sizes = (100 * F.col("to_high") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("to_low"))
    reach = (100 + percent) * F.least("most", "to_most") >= percent * (F.col("low") + F.col("to_low"))
    apart = F.least("one", "to_one") != F.greatest("other", "to_other")
    pairs = table.join(right, "token").where((F.col("group") < F.col("to_group")) & sizes & reach & apart).select("group", "to_group").distinct()
    # Only classes with a shingle of another linked set can have a link there.
    open_entry = entry.join(wide, "token", "left_semi")
    able = durable(open_entry.groupBy("class", "n", "stored", "group", "leader").agg(F.collect_list("token").alias("prefix")))
    whole = able.groupBy("group").agg(*limits)
    whole = pairs.join(whole.select(*[F.col(c).alias(f"to_{c}") for c in to]), "to_group")
    sizes = (100 * F.col("to_high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("to_low"))
    reach = (100 + percent) * F.least("stored", "to_most") >= percent * (F.col("n") + F.col("to_low"))
    apart = (F.col("to_one") != F.col("leader")) | (F.col("to_other") != F.col("leader"))
    visits = able.join(whole, "group").where(sizes & reach & apart).select(F.col("to_group").alias("to"), "class", "leader")
    # Of these, the ones that have themselves a shingle of the group, beside sizes and a linked set that allow a link.
    prefixes = able.select("class", "n", "stored", "prefix")
    visits = durable(_beside(durable(visits), able, prefixes).mapInArrow(_met(percent), "class long, leader long, to long"))

    links = _beside(visits, able, sets.select("class", "n", "tokens")).mapInArrow(_visited(percent), "a long, b long")
    roots = components(links)
    return leader.join(roots, leader["leader"] == roots["node"], "left").select("class", F.coalesce("root", "leader").alias("root"))


def memberships(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, tie, class, n_shingles, component_id and the component's first row, per document."""
    rows = profile(docs, size, percent)
    classes = classes_of(rows)
    roots = linked_classes(rows, classes, percent).select(F.col("class").alias("number"), "root")
    named = classes.join(roots, "number", "left").withColumn("root", F.coalesce("root", "number"))
    tops = named.groupBy("root").agg(F.min("first").alias("first"), F.min("any").alias("any"))
    member = named.select("class", "root").join(tops, "root").select(
        "class", F.col("first.doc_id").alias("component_id"), F.coalesce("first.tie", "any").alias("kept_tie")
    )
    known = rows.where("class is not null").drop("prefix", "tokens").join(member, "class")
    empty = rows.where("class is null").drop("prefix", "tokens").withColumns({"component_id": F.col("doc_id"), "kept_tie": F.col("tie")})
    return known.unionByName(empty).withColumnRenamed("n", "n_shingles")


def first_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, with one kept of each component; those without words all stay."""
    members = durable(memberships(docs, size, percent))
    same = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tie") == F.col("kept_tie"))
    kept = members.where(same).groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie"), "times", "n")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("tie"))
    joined = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")))
    if kept.where("times > 1 and n > 0").limit(1).count():  # repeated rows: one of them stays
        once = joined.where("times = 1 or n = 0").select("row")
        repeated = joined.where("times > 1 and n > 0").groupBy("kept_id", "kept_tie").agg(F.first("row").alias("row"))
        return once.unionByName(repeated.select("row")).select("row.*")
    return joined.select("row.*")


def report(docs: DataFrame) -> DataFrame:
    return memberships(docs).select("doc_id", "n_shingles", "component_id")
