"""One JSON document: cut by many tasks, written in parts, against the json module."""

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from larkspur.sources import corpus, json_document
from larkspur.sources.json_document import read_document

HARD = ['"', "\\", "}", "{", "[", "]", ",", "\n", "\t", "é", " ", "plain ", '"}', '\\"', "\\\\"]


@pytest.fixture(params=[500, 1 << 27])
def split_bytes(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, value in keys.items():
        spark.conf.set(k, value)
    yield request.param
    for k, value in before.items():
        spark.conf.set(k, value)


def corpus_of(seed, n=6):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(HARD) for _ in range(draw.randrange(25)))

    documents = []
    for i in range(n):
        pages = [{"page_number": p, "text": text(), "character_count": p * 3, "extra": {"deep": [{"a": text()}, [1, {}]]}} for p in range(draw.randrange(5))]
        documents.append({
            "source": f"{text()}-{i}", "authors": [{"name": text()}, {"name": "x"}], "page_count": len(pages), "tags": ["a}", "b,"], "pages": pages,
            "total_character_count": i * 10, "note": {"pages": [{"page_number": -1}]},
        })
    return {
        "project": text(), "meta": {"list": [{"a": 1}, {"b": [2]}], "documents": []}, "others": [{"pages": [{"page_number": -5, "text": "no"}]}],
        "documents": documents, "document_count": n, "domain": "after the array",
    }


def expected(data):
    return sorted(
        (data["project"], data["domain"], data["document_count"], d["source"], d["page_count"], d["total_character_count"], p["page_number"],
         p["text"], p["character_count"])
        for d in data["documents"] for p in d["pages"]
    )


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_corpus_form(spark, tmp_path, split_bytes, seed, indent):
    data = [corpus_of(seed), corpus_of(seed + 50, 2)]
    for i, one in enumerate(data):
        (tmp_path / f"{i}.json").write_text("﻿" * i + json.dumps(one, ensure_ascii=i == 0, indent=indent) + "\n" * i, encoding="utf-8")
    got = corpus.read_corpus_document(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(data[0]) + expected(data[1]))
    if split_bytes < 1000:
        lines = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert lines.select(F.spark_partition_id()).distinct().count() > 5


def test_chunk_form_and_empty_arrays(spark, tmp_path, split_bytes):
    chunk = {"source": "s", "page_numbers": [1, 2], "text": 'a "}" b', "character_count": 7, "chunk_id": 4}
    data = {"project": "p", "domain": "d", "source_document_count": 1, "chunk_size": 10, "chunk_overlap": 2, "chunk_count": 1, "chunks": [chunk]}
    (tmp_path / "one.json").write_text(json.dumps(data, indent=2), encoding="utf-8")
    (tmp_path / "none.json").write_text(json.dumps({**data, "chunks": []}), encoding="utf-8")
    rows = [tuple(r) for r in corpus.read_chunk_document(spark, str(tmp_path)).collect()]
    assert rows == [("p", "d", 1, 10, 2, 1, "s", [1, 2], 'a "}" b', 7, 4)]


def test_no_object(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1, 2]", encoding="utf-8")
    with pytest.raises(Exception):
        read_document(spark, str(tmp_path), ["x"], ["a int", "b int"]).collect()


def test_written_parts_are_one_document(spark, tmp_path, split_bytes):
    draw = random.Random(4)
    rows = [(f"s{i % 4}", i, "".join(draw.choice(HARD) for _ in range(30))) for i in range(40)] + [("hot", i, f"page {i}") for i in range(60)]
    rows.append(('quo"ted}', 1, None))
    pages = spark.createDataFrame(rows, "source string, page_number int, text string").repartition(7)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus.write_corpus_document(pages, path, 'a "project"', "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(glob.glob(f"{path}/part-*"))
    assert len(parts) > 3
    data = json.loads("".join(open(p, encoding="utf-8").read() for p in parts))
    assert (data["project"], data["document_count"], [d["source"] for d in data["documents"]]) == ('a "project"', 6, ["hot", 'quo"ted}', "s0", "s1", "s2", "s3"])
    got = [(d["source"], p["page_number"], p["text"]) for d in data["documents"] for p in d["pages"]]
    assert got == sorted(rows)
    assert all(d["page_count"] == len(d["pages"]) and d["total_character_count"] == sum(len(p["text"] or "") for p in d["pages"]) for d in data["documents"])
    back = corpus.read_corpus_document(spark, path, in_parts=True)
    assert sorted((r["source"], r["page_number"], r["text"] or "") for r in back.collect()) == sorted((s, n, t or "") for s, n, t in rows)
    assert {r["document_count"] for r in back.collect()} == {6}


def test_nothing_to_write(spark, tmp_path):
    path = str(tmp_path / "none")
    corpus.write_corpus_document(spark.createDataFrame([], "source string, page_number int, text string"), path, "p", "d")
    data = json.loads("".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*"))))
    assert data == {"project": "p", "domain": "d", "document_count": 0, "documents": []}
    assert corpus.read_corpus_document(spark, path, in_parts=True).collect() == []


def test_brackets_follow_strings():
    draw = random.Random(2)
    for _ in range(500):
        text = json.dumps(["".join(draw.choice(HARD) for _ in range(6)), {"k": "}"}], ensure_ascii=False)
        for cut in range(len(text)):
            if text[:cut].endswith("\\"):
                continue  # pieces end in a brace
            first, inside = json_document.brackets(text[:cut], False)
            second, end = json_document.brackets(text[cut:], inside)
            assert [m for _, m in first + second] == ["[", "{", "}", "]"] and not end
