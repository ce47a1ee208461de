"""Curve order, laws, files and edge rows of the sharding operator."""

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspur.llm import curve
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.documents(), brute.DOCUMENTS).repartition(5).cache()


@pytest.mark.parametrize("width,bits", [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_touch(spark, width, bits):
    points = list(itertools.product(range(1 << bits), repeat=width))
    names = [f"d{i}" for i in range(width)]
    frame = spark.createDataFrame(points, ", ".join(f"{n} int" for n in names))
    rows = frame.select(*names, curve.curve_index([F.col(n) for n in names], bits).alias("place")).collect()
    path = [r[:width] for r in sorted(rows, key=lambda r: r["place"])]
    assert sorted(r["place"] for r in rows) == list(range(len(points)))
    assert path[0] == (0,) * width
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_matches_sql_and_keeps_its_law(spark, docs):
    got = [tuple(r) for r in curve.report(docs).collect()]
    arrow = docs.select("doc_id", "text", "lang", "source").toArrow()
    assert brute.ordered(got) == brute.ordered(brute.duck({"documents": arrow}, curve.ORACLE))
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in docs.collect())
    assert Counter(r[:3] for r in got) == want
    held = Counter(r[4] for r in got)
    assert set(held) == set(range(8)) and max(held.values()) - min(held.values()) <= 1
    assert sorted((r[4], r[5]) for r in got) == [(s, i) for s in range(8) for i in range(held[s])]


def test_equal_bytes(spark):
    rows = [(i, "x" * (i % 50), "en", f"s{i % 7}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = curve.assign(docs, shards=5, law="bytes").collect()
    held = Counter()
    for r in placed:
        held[r["shard"]] += r["size"]
    assert set(held) == set(range(5)) and max(held.values()) - min(held.values()) <= 2 * 50
    for s in range(5):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sum(r["shard"] == s for r in placed)))
    with pytest.raises(ValueError):
        curve.assign(docs, law="weight")


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None, None)],
    [(7, "same", "en", "hot")] * 50 + [(None, "x", None, "hot"), (8, None, "en", None)],
    [(i, "same text", "en", "hot") for i in range(500)],
])
def test_few_and_repeated_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for law in ("rows", "bytes"):
        got = curve.assign(docs, law=law).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
        assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
        held = Counter(r["shard"] for r in got)
        assert all(0 <= s < 8 for s in held)
        assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in sorted(held) for i in range(held[s])]


def test_files_hold_the_rows_and_can_be_skipped(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    clash = docs.withColumn("shard", F.lit("mine"))
    manifest = {r["shard"]: r for r in curve.write(clash, path).collect()}
    back = spark.read.parquet(path)
    assert back.columns == [*clash.columns, "shard_"]
    assert Counter(tuple(r[:-1]) for r in back.collect()) == Counter(map(tuple, clash.collect()))
    assert {s: r["rows"] for s, r in manifest.items()} == {r[0]: r[1] for r in back.groupBy("shard_").count().collect()}
    unique = docs.dropDuplicates(["doc_id", "text"])
    placed = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in curve.assign(unique).collect()}
    curve.write(unique, f"{path}-unique")
    for r in spark.read.parquet(f"{path}-unique").select("doc_id", "text", "shard").collect():
        assert placed[(r["doc_id"], zlib.crc32((r["text"] or "").encode()))] == r["shard"]


def test_each_dimension_skips_shards(spark):
    rows = [(i, "w" * (1 + i * 7919 % 997), f"l{i % 4}", f"s{i * 31 % 16}") for i in range(4096)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = curve.assign(docs, shards=64).join(docs.select("doc_id", "lang", "source"), "doc_id")
    ranges = curve.manifest(placed).collect()
    by_id = curve.manifest(placed.withColumn("shard", F.expr("cast(doc_id div 64 as int)"))).collect()
    for name, value in (("lang", "l2"), ("source", "s5"), ("size", 500)):
        opened, plain = (sum(r[f"{name}_min"] <= value <= r[f"{name}_max"] for r in one) for one in (ranges, by_id))
        assert plain == 64 and opened <= 40
