"""The audit of sources against its SQL, with weak digests, small tiles and awkward rows."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from larkspur.llm import divergence
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, term string, digest string, n long, g long, part string"


def compare(frame, got):
    arrow = frame.select("doc_id", "text", "lang", "source").toArrow()
    assert brute.ordered(tuple(r) for r in got.collect()) == brute.ordered(brute.duck({"documents": arrow}, divergence.ORACLE))


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(9)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "Y", "é", "ß", "zz", "日本", "Q")] + ["it's", "a1b", "A_B", "ÉÉ", "[x]"]
    rows = []
    for i in range(260):
        lang = draw.choice(["en", "en", "en", "de", "", None, "fr"])
        source = draw.choice(["hot"] * 4 + [f"s{k}" for k in range(7)] + [None, "", "é"])
        some = words[: 20 + 10 * (len(source or "") % 3)]
        rows.append((i % 200, " ".join(draw.choice(some) for _ in range(draw.randint(0, 60))), lang, source))
    rows += [(None, None, "en", "none"), (1, "", "xx", "a"), (1, None, "xx", "b"), (2, "... 12 _", "yy", "only")]
    rows += [(3, "same Same SAME", "en", "hot")] * 15 + [(4, "ü" * 50_000 + " word" * 30_000, "en", "long")]
    return spark.createDataFrame([(*r, "t", "d", 1, 2, "p") for r in rows], SCHEMA).repartition(6).cache()


def test_equals_sql(docs):
    compare(docs, divergence.report(docs))


@pytest.mark.parametrize("bits,tile,bucket_rows", [(2, 256, 200_000), (5, 3, 20)])
def test_split_digests_and_small_tiles(docs, bits, tile, bucket_rows):
    compare(docs, divergence.audit(docs, bits=bits, tile=tile, bucket_rows=bucket_rows))


def test_counts_written_in_between(spark, docs, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "SPELLED", 3)
    monkeypatch.setattr(divergence, "CELLS", 16)
    compare(docs, divergence.report(docs))


def plain_counts(texts, groups):
    counts = {}
    for text, g in zip(texts, groups):
        own = Counter(re.findall(rb"[a-z\x80-\xff]+", text.encode().lower()))
        for term, n in own.items():
            total = counts.setdefault((g, term), [0, 0])
            total[0] += n
            total[1] += 1
    return counts


@pytest.mark.parametrize("bits", [64, 3])
@pytest.mark.parametrize("piece,long", [(1 << 21, 1 << 20), (40, 10), (7, 5)])
def test_tasks_count_and_spell(monkeypatch, piece, long, bits):
    """Short pieces, terms longer than a piece, and digests that stand for several terms."""
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "LONG", long)
    draw = random.Random(piece)
    words = ["a", "B", "é", "日本", "abcdefg" * 3, "ß" * 30, "x1y", "--", "The", "the"]
    texts = [draw.choice(["", " "]).join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(80)] + ["", "12"]
    groups = [draw.randrange(3) for _ in texts]
    batches = pa.table({"g": groups, "text": [*texts]}).to_batches(max_chunksize=30)
    rows = [r for b in divergence._counted(bits)(iter(batches)) for r in b.to_pylist()]
    spelled = {}
    for r in rows:
        if r["term"] is not None:
            spelled.setdefault(r["digest"], set()).add(r["term"].encode())
    want = plain_counts(texts, groups)
    of = {term: key for key, terms in spelled.items() for term in terms}
    assert set(of) == {term for _, term in want} and len(of) == sum(map(len, spelled.values()))
    summed = {}
    for (g, term), (n, docs) in want.items():
        total = summed.setdefault((g, of[term]), [0, 0])
        total[0] += n
        total[1] += docs if bits == 64 else 0
    got = {}
    for r in rows:
        if r["term"] is None:
            total = got.setdefault((r["g"], r["digest"]), [0, 0])
            total[0] += r["n"]
            total[1] += r["docs"] if bits == 64 else 0
    assert got == summed
    apart = {}
    for b in divergence._spelled(bits)(iter(batches)):
        for r in b.to_pylist():
            total = apart.setdefault((r["g"], r["term"].encode(), r["digest"]), [0, 0])
            total[0] += r["n"]
            total[1] += r["docs"]
    assert apart == {(g, term, of[term]): v for (g, term), v in want.items()}


def test_no_kept_terms(spark):
    frame = spark.createDataFrame([(1, "a b", "en", "x"), (2, "b c", "en", "y"), (3, "d", "de", "x")], "doc_id long, text string, lang string, source string")
    got = brute.ordered(tuple(r) for r in divergence.report(frame).collect())
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.report(frame.limit(0)).collect() == []


def test_ties_at_the_last_rank_go_by_spelling(spark):
    rare = [f"t{a}{b}" for a in "abcdefgh" for b in "abcde"]
    rows = [(i, " ".join([*rare, "common"]), "en", "x") for i in range(12)] + [(20 + i, "common " * 40, "en", "y") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = divergence.report(frame)
    assert [r["item"] for r in got.where("part = 'term' and source = 'x'").orderBy("rank").collect()] == sorted(rare)[:10]
    compare(frame, got)
