"""Chunking, answers and evaluation against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions import vectors
from larkspur.operators import answers, chunks, embed, rag_eval, search
from larkspur.plans import catalog, knowledge
from larkspur.session import scratch_path
from larkspur.sources import corpus


def chunk_by_hand(pages, size, overlap):
    """[(chunk_number, text, pages)] of one document."""
    whole, spans = "", []
    for number, text in sorted(pages):
        text = (text or "").strip()
        if text:
            whole += "\n\n" if whole else ""
            spans.append((number, len(whole), len(whole) + len(text)))
            whole += text
    out, at, k = [], 0, 0
    while at < len(whole):
        end = min(at + size, len(whole))
        if whole[at:end].strip():
            out.append((k, whole[at:end].strip(), [n for n, a, b in spans if b > at and a < end]))
        if end == len(whole):
            break
        at, k = end - overlap, k + 1
    return out


def check(spark, documents, configs):
    rows = [(s, n, t) for s, pages in documents.items() for n, t in pages]
    frame = spark.createDataFrame(rows, "source string, page_number long, text string").repartition(4)
    got = {}
    for r in chunks.chunk_pages(frame, configs).collect():
        got.setdefault((r["chunk_size"], r["source"]), []).append((r["chunk_number"], r["text"], r["page_numbers"]))
    for size, overlap in configs:
        for source, pages in documents.items():
            assert sorted(got.get((size, source), [])) == chunk_by_hand(pages, size, overlap), (source, size, overlap)


def test_chunks_at_the_edges(spark):
    documents = {f"len{n}": [(1, "abcdefghijklmnopqr"[:n])] for n in (0, 1, 10, 11, 17, 18)}
    documents["blank pages"] = [(1, " "), (2, "abc"), (3, None), (4, "  def \n")]
    documents["in the gap"] = [(1, "a" * 10), (2, "b" * 10), (3, "c" * 9)]
    documents["beyond the BMP"] = [(1, "😀x" * 9), (5000, "é😀" * 7), (99999, "z")]
    documents["spaces"] = [(1, "a" + " " * 30 + "b"), (2, "c")]
    check(spark, documents, [(10, 3), (4, 0), (5, 4), (100, 20)])


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_chunks_of_random_documents(spark, seed):
    rng = random.Random(seed)
    documents = {}
    for d in range(12):
        pages = range(rng.randint(0, 5) if d else 200)  # one document has most pages
        documents[f"d{d}"] = [
            (p * rng.choice([1, 3]) + 1000 * p, "".join(rng.choices("ab \n😀", k=rng.randint(0, 40)))) for p in pages
        ]
    size = rng.randint(2, 30)
    check(spark, documents, [(size, rng.randint(0, size - 1))])


@pytest.mark.parametrize("size, overlap", [(0, 0), (10, -1), (10, 10)])
def test_bad_windows(size, overlap):
    with pytest.raises(ValueError):
        chunks.check_window(size, overlap)


def test_chunk_ids_are_dense(spark):
    rows = [(f"s{i % 5}", i, "word " * (i % 40)) for i in range(200)]
    pages = spark.createDataFrame(rows, "source string, page_number long, text string")
    numbered = chunks.number_chunks(chunks.chunk_documents(pages, 50, 10), first_id=0).collect()
    ordered = sorted(numbered, key=lambda r: (r["source"], r["chunk_number"]))
    assert [r["chunk_id"] for r in ordered] == list(range(len(ordered)))


def test_embedders_give_unit_vectors(spark):
    import numpy as np

    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["a b b", "A, b!", "", None, "é ß"])], "i int, text string")
    hashed = {r["i"]: r["embedding"] for r in embed.HashedTokens(32).embed(texts, "text", "embedding").collect()}
    assert [round(sum(x * x for x in hashed[i]), 5) for i in range(5)] == [1, 1, 0, 0, 1]

    def load():
        return lambda batch: np.array([[len(t), 1.0] for t in batch])

    encoded = {r["i"]: r["embedding"] for r in embed.BatchEncoder(load, 2).embed(texts, "text", "embedding").collect()}
    assert encoded[0] == pytest.approx([5 / 26**0.5, 1 / 26**0.5])
    assert encoded[3] == pytest.approx([0, 1])


def hits_frame(spark, rows):
    return spark.createDataFrame(
        rows, "query_id int, rank int, similarity_score double, source string, page_numbers array<int>, text string"
    )


def test_verdicts(spark):
    questions = spark.createDataFrame([(i,) for i in range(1, 7)], "query_id int")
    expected = spark.createDataFrame(
        [(1, ["a"]), (2, ["b"]), (3, []), (4, []), (5, ["a"])], "query_id int, expected_sources array<string>"
    )
    hits = hits_frame(spark, [(q, 1, 0.5, "a", [1], "t") for q in (1, 2, 3, 6)])
    judged = {r["query_id"]: (r["passed"], r["hits"]) for r in rag_eval.judge(questions, hits, expected).collect()}
    assert judged == {1: (True, 1), 2: (False, 1), 3: (False, 1), 4: (True, 0), 5: (False, 0), 6: (False, 1)}
    lenient = rag_eval.judge(questions, hits.where("query_id < 6"), expected, undefined="unanswerable")
    assert {r["query_id"]: r["passed"] for r in lenient.collect()}[6] is True
    summary = rag_eval.pass_summary(rag_eval.judge(questions, hits, expected)).first()
    assert (summary["total"], summary["passed"], summary["failed"], round(summary["pass_rate"], 2)) == (6, 2, 4, 33.33)
    assert rag_eval.pass_summary(rag_eval.judge(questions.limit(0), hits, expected)).first()["pass_rate"] == 0


def test_prompt_and_citations(spark):
    hits = hits_frame(spark, [(1, 2, 0.4, "a", [6, 5], "second"), (1, 1, 0.6, "a", [1, 2], "first"), (1, 3, 0.4, "b", [9], "x")])
    questions = spark.createDataFrame([(1, "why?"), (2, "how?")], "query_id int, question string")
    prompts = answers.grounded_prompts(questions, hits).collect()
    assert [r["query_id"] for r in prompts] == [1]
    text = prompts[0]["prompt"]
    assert "why?" in text and text.index("SOURCE 1\nDocument: a\nPages: 1, 2\nText:\nfirst") < text.index("SOURCE 2")
    cited = {r["source"]: (r["page_list"], r["page_ranges"]) for r in answers.citations(hits).collect()}
    assert cited == {"a": ("1, 2, 5, 6", "1-2, 5-6"), "b": ("9", "9")}
    gate = {r["query_id"]: (r["hits"], r["answerable"]) for r in answers.evidence_gate(questions, hits).collect()}
    assert gate == {1: (3, True), 2: (0, False)}


def test_rubric(spark):
    rows = [("q", c, 2) for c in rag_eval.CRITERIA[:5]] + [("q", rag_eval.CRITERIA[5], 1), ("r", "relevance", 3)]
    scored = rag_eval.rubric_scores(spark.createDataFrame(rows, "question string, criterion string, score int"))
    got = {r["question"]: (r["points"], r["max_points"], r["invalid"], r["complete"]) for r in scored.collect()}
    assert got == {"q": (11, 12, 0, True), "r": (0, 12, 1, False)}


def test_sweep_against_separate_searches(spark):
    texts = {"s1": "alpha beta gamma " * 60, "s2": "delta epsilon " * 90, "s3": "zeta eta theta iota " * 40}
    pages = spark.createDataFrame([(s, 1, t) for s, t in texts.items()], "source string, page_number long, text string")
    questions = spark.createDataFrame(
        [(1, "alpha beta gamma"), (2, "delta epsilon"), (3, "nothing of it"), (4, "zeta eta")], "query_id int, question string"
    )
    expected = spark.createDataFrame([(1, ["s1"]), (2, ["s3"]), (3, [])], "query_id int, expected_sources array<string>")
    configs = [(100, 20), (300, 50), (300, 10)]
    swept = rag_eval.chunk_size_sweep(pages, questions, expected, embed.HashedTokens(), configs).collect()
    assert len(swept) == 12
    counts = {(s, o): sum(len(chunk_by_hand([(1, t)], s, o)) for t in texts.values()) for s, o in configs}
    for r in swept:
        assert r["chunks"] == counts[r["chunk_size"], r["chunk_overlap"]]
        assert r["passed"] == {1: True, 2: False, 3: True, 4: False}[r["query_id"]]
        assert r["top_source"] == {1: "s1", 2: "s2", 3: None, 4: "s3"}[r["query_id"]]
    total = {(r["chunk_size"], r["chunk_overlap"]): (r["passed"], r["total"]) for r in rag_eval.sweep_summary(spark.createDataFrame(swept)).collect()}
    assert total == dict.fromkeys(configs, (2, 4))


def test_knowledge_base_versions(spark):
    path = scratch_path(spark, "kb")
    one = spark.createDataFrame([("a", 1, "alpha beta"), ("b", 1, "gamma")], "source string, page_number long, text string")
    embedder = embed.HashedTokens(64)
    knowledge.build(one, path, "first", embedder)
    knowledge.build(one.where("source = 'a'"), path, "second", embedder)
    knowledge.build(one, path, "first", embedder)
    assert knowledge.load(spark, path, "first").count() == 2
    assert knowledge.load(spark, path, "second").count() == 1
    questions = spark.createDataFrame([(1, "Alpha beta?"), (2, "omega")], "query_id int, question string")
    asked = {r["query_id"]: r for r in knowledge.ask(questions, knowledge.load(spark, path, "first"), embedder).collect()}
    assert asked[1]["answerable"] and asked[1]["citations"] == "a | Pages: 1" and "alpha beta" in asked[1]["prompt"]
    assert not asked[2]["answerable"] and asked[2]["prompt"] is None


def test_nested_corpus_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        """{"project": "p", "domain": "d", "document_count": 1, "documents": [
        {"source": "s", "page_count": 2, "total_character_count": 3, "pages": [
          {"page_number": 1, "text": "ab", "character_count": 2}, {"page_number": 2, "text": "c", "character_count": 1}]}]}""",
        encoding="utf-8",
    )
    rows = corpus.read_corpus(spark, str(tmp_path)).orderBy("page_number").collect()
    assert [(r["source"], r["page_number"], r["text"]) for r in rows] == [("s", 1, "ab"), ("s", 2, "c")]


def test_damaged_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"source": "s", "page_number": 1, "text": "x"}\n{"source": \n', encoding="utf-8")
    good, bad = corpus.split_quarantine(corpus.read_pages(spark, str(tmp_path), bad_rows="quarantine"))
    assert good.count() == 1 and bad.select("file_name").first()[0] == "a.json"
    with pytest.raises(Exception):
        corpus.read_pages(spark, str(tmp_path)).collect()
    with pytest.raises(FileNotFoundError):
        corpus.read_pages(spark, str(tmp_path), "*.pdf.json")


def test_hashed_tokens_hash_each_distinct_token_once(monkeypatch):
    asked, plain = [], embed.slot
    monkeypatch.setattr(embed, "COUNTED", 2)
    monkeypatch.setattr(embed, "slot", lambda token, dimension: asked.append(token) or plain(token, dimension))
    lists = [["sea", "owl", "sea"], [], ["owl"], ["tax", "é"], ["sea"]]
    got = embed._unit_counts(pa.array([["cut off"], *lists], pa.list_(pa.string())).slice(1), 8).to_pylist()
    assert sorted(asked) == sorted({w for own in lists for w in own})
    for own, vector in zip(lists, got):
        want = np.zeros(8)
        for word in own:
            want[int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % 8] += 1
        assert vector == (want / (np.linalg.norm(want) or 1)).astype("float32").tolist()
    assert embed._unit_counts(pa.array([], pa.list_(pa.string())), 8).to_pylist() == []


def test_checked_vectors_are_counted_without_their_lengths(spark, monkeypatch):
    monkeypatch.setattr(vectors, "norm", lambda a: F.raise_error(F.lit("a length was taken")).cast("double"))
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "chunk_id long, embedding array<float>")
    assert knowledge.checked(rows) == {"chunks": 2, "dimension": 2}


def test_hash_embed_makes_each_vector_once(spark, sf_dir, capsys):
    catalog.builders()["hash_embed"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert plan.count("split(lower(") == 1


def test_search_leaves_out_rows_without_a_vector(spark):
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    rows = [(1, None), (2, [0.5, 0.5]), (3, None), (4, [0.9, 0.1])]
    stored = spark.createDataFrame(rows, "chunk_id long, embedding array<double>").coalesce(1)
    for values in (search.QUERY_VALUES, 1):
        got = search.search(asked, stored, 5, 0.0, query_values=values).orderBy("rank").collect()
        assert [r["chunk_id"] for r in got] == [4, 2]
