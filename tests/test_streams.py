"""A knowledge base that grows by pages equals one built at once."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import embed
from larkspur.plans import knowledge
from larkspur.session import scratch_path
from larkspur.streaming import jobs, pages

SCHEMA = "source string, page_number long, text string"
EMBEDDER = embed.HashedTokens(16)


def rows_of(frame):
    return sorted((r["chunk_id"], r["source"], r["chunk_number"], tuple(r["page_numbers"]), r["text"], tuple(r["embedding"])) for r in frame.collect())


def at_once(spark, rows, size, overlap):
    path = scratch_path(spark, "whole")
    knowledge.build(spark.createDataFrame(rows, SCHEMA), path, "kb", EMBEDDER, size, overlap)
    return rows_of(knowledge.load(spark, path, "kb"))


def published(spark, state):
    out = scratch_path(spark, "kb")
    pages.publish(spark, state, "kb", out)
    return rows_of(knowledge.load(spark, out, "kb"))


def text(draw):
    return " ".join("".join(draw.choice("abcé") for _ in range(draw.randint(1, 7))) for _ in range(draw.randint(0, 40)))


@pytest.fixture(scope="module")
def library():
    draw = random.Random(5)
    rows = [("hot", n, text(draw)) for n in range(120)]
    rows += [(f"s{n % 9}", n, text(draw)) for n in range(100)]
    return rows + [("blank", 1, " \n"), ("short", 7, "x"), ("long", 3, "word " * 900)]


@pytest.mark.parametrize("seed,size,overlap", [(1, 100, 20), (2, 64, 63), (3, 1000, 200)])
def test_pages_dealt_over_batches(spark, library, seed, size, overlap):
    """Random deals with drafts, repeats and pages that are taken away again, one file a batch, one restart."""
    draw = random.Random(seed)
    deals = {}
    for row in library:
        deals.setdefault(draw.randrange(5), []).append(row)
    again = draw.sample(library, 25)
    deals[0] = deals.get(0, []) + [(s, n, "draft " + t) for s, n, t in again if (s, n, t) not in deals.get(0, [])]
    deals[4] = deals.get(4, []) + [r for r in again if r not in deals.get(4, [])] * 2  # delivered twice
    gone = [("hot", 500 + n, "to be removed " * 9) for n in range(3)] + [("s1", 2, "gone")]
    deals[1] = deals.get(1, []) + gone
    deals[3] = deals.get(3, []) + [(s, n, None) for s, n, _ in gone]

    landing, state, checkpoint = (scratch_path(spark, n) for n in ("landing", "pages", "state"))
    for run in ((0, 1, 2), (3, 4)):
        for number in run:
            spark.createDataFrame(deals[number], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        arrived = jobs.file_stream(spark, landing, SCHEMA, files=1)
        pages.stream_knowledge(arrived, state, "kb", EMBEDDER, checkpoint, size, overlap).awaitTermination()
    assert published(spark, state) == at_once(spark, library, size, overlap)


def test_a_batch_that_runs_again_replaces_itself(spark, library):
    state = scratch_path(spark, "pages")
    half = len(library) // 2
    frames = [spark.createDataFrame(library[:half], SCHEMA), spark.createDataFrame(library[half:], SCHEMA)]
    pages.add_pages(frames[0], 0, state, "kb", EMBEDDER, 100, 20)
    first = published(spark, state)
    pages.add_pages(frames[1], 1, state, "kb", EMBEDDER, 100, 20)
    whole = published(spark, state)
    pages.add_pages(frames[1], 1, state, "kb", EMBEDDER, 100, 20)
    assert published(spark, state) == whole == at_once(spark, library, 100, 20) != first


def test_a_batch_without_its_cuts_does_not_count(spark, library, monkeypatch):
    state = scratch_path(spark, "pages")
    half = len(library) // 2
    pages.add_pages(spark.createDataFrame(library[:half], SCHEMA), 0, state, "kb", EMBEDDER, 100, 20)
    before = published(spark, state)
    write = pages._write

    def fails(rows, path, part, *others):
        if part == "cuts":
            raise RuntimeError("lost")
        write(rows, path, part, *others)

    monkeypatch.setattr(pages, "_write", fails)
    rest = spark.createDataFrame(library[half:], SCHEMA)
    with pytest.raises(RuntimeError):
        pages.add_pages(rest, 1, state, "kb", EMBEDDER, 100, 20)
    assert published(spark, state) == before
    monkeypatch.setattr(pages, "_write", write)
    pages.add_pages(rest, 1, state, "kb", EMBEDDER, 100, 20)
    assert published(spark, state) == at_once(spark, library, 100, 20)


def test_growth_at_the_end_reads_the_tail_only(spark):
    state = scratch_path(spark, "pages")
    grown = [("book", n, "some words of a page " * 5) for n in range(200)]
    pages.add_pages(spark.createDataFrame(grown[:190], SCHEMA), 0, state, "kb", EMBEDDER, 100, 20)
    pages.add_pages(spark.createDataFrame(grown[190:], SCHEMA), 1, state, "kb", EMBEDDER, 100, 20)
    cuts, tail = pages.place_changes(spark.read.parquet(f"{state}/pages"), 1, 100, 20)
    assert tail.count() <= 13 and cuts.first()["from_chunk"] > 200
    assert spark.read.parquet(f"{state}/chunks").where("batch = 1").count() < 20
    assert published(spark, state) == at_once(spark, grown, 100, 20)


def test_nothing_stored(spark):
    state = scratch_path(spark, "pages")
    with pytest.raises(ValueError):
        pages.publish(spark, state, "kb", scratch_path(spark, "kb"))
    pages.add_pages(spark.createDataFrame([], SCHEMA), 0, state, "kb", EMBEDDER)
    pages.add_pages(spark.createDataFrame([("a", 1, "x")], SCHEMA), 1, state, "kb", EMBEDDER)
    assert [r[4] for r in published(spark, state)] == ["x"]
    assert spark.read.parquet(f"{state}/cuts").where(F.col("batch") == 0).count() == 0


def test_first_records_with_repeats_late_ones_and_a_restart(spark):
    schema = "id long, at timestamp, value string"
    batches = [
        [(1, "2024-01-01 10:00:00", "a"), (2, "2024-01-01 11:00:00", "b"), (None, "2024-01-01 11:00:00", "no id"), (9, None, "no time")],
        [(1, "2024-01-01 10:30:00", "again"), (3, "2024-01-01 12:00:00", "c"), (2, "2024-01-01 09:00:00", "late again")],
        [(4, "2024-01-02 11:00:00", "d"), (3, "2024-01-01 12:00:00", "c")],
        [(5, "2024-01-01 06:00:00", "too late"), (4, "2024-01-02 11:30:00", "again"), (6, "2024-01-02 09:00:00", "late, in time")],
    ]
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "out", "state"))
    for rows in batches:  # each run is a restart
        frame = spark.createDataFrame(rows, "id long, at string, value string").withColumn("at", F.to_timestamp("at"))
        frame.coalesce(1).write.mode("append").parquet(landing)
        jobs.stream_first_records(jobs.file_stream(spark, landing, schema), "id", "at", "4 hours", out, state).awaitTermination()
    got = {(r["id"], r["value"]) for r in spark.read.parquet(out).collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c"), (4, "d"), (6, "late, in time")}


class Mixed:
    """Vectors of two widths."""

    def embed(self, df, text, output="embedding"):
        vector = F.when(F.col("chunk_id") % 2 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
        return df.withColumn(output, vector)


def test_versions_of_a_knowledge_base(spark, library):
    path = scratch_path(spark, "kb")
    frame = spark.createDataFrame(library, SCHEMA)
    half = spark.createDataFrame(library[:50], SCHEMA)
    assert knowledge.clean(spark, path, "kb") == [] and knowledge.versions(spark, path) is None
    with pytest.raises(ValueError, match="no version"):
        knowledge.load_version(spark, path, "kb")
    assert knowledge.publish(half, path, "kb", EMBEDDER, 100, 20) == 1
    reading = knowledge.load_version(spark, path, "kb")
    before = reading.count()
    for pages_, embedder in ((frame, Mixed()), (frame.limit(0), EMBEDDER)):
        with pytest.raises(ValueError):
            knowledge.publish(pages_, path, "kb", embedder, 100, 20)
        assert knowledge.load_version(spark, path, "kb").count() == before
    assert knowledge.publish(frame, path, "kb", EMBEDDER, 100, 20) == 2
    assert knowledge.publish(half, path, "other-kb", EMBEDDER, 100, 20) == 1
    assert reading.count() == before == knowledge.load_version(spark, path, "kb", 1).count()
    assert knowledge.load_version(spark, path, "kb").count() > before
    removed = knowledge.clean(spark, path, "kb", keep=1)  # version 1, and what the two refused builds left
    assert len(removed) == 3
    assert knowledge.load_version(spark, path, "kb").count() > before and knowledge.load_version(spark, path, "other-kb").count() == before
    with pytest.raises(Exception):
        knowledge.load_version(spark, path, "kb", 1).count()


def test_build_refuses_mixed_widths(spark, library):
    path = scratch_path(spark, "kb")
    frame = spark.createDataFrame(library, SCHEMA)
    knowledge.build(frame, path, "kb", EMBEDDER, 100, 20)
    before = knowledge.load(spark, path, "kb").count()
    with pytest.raises(ValueError, match="dimensions"):
        knowledge.build(frame, path, "kb", Mixed(), 100, 20)
    assert knowledge.load(spark, path, "kb").count() == before


def test_chunks_that_no_longer_count_leave_the_disk(spark, library, monkeypatch):
    """Batches that later ones cut anew are taken off the disk; rows, restarts and failures in between as before."""
    state, draw = scratch_path(spark, "pages"), random.Random(9)
    deals = [[], [], [], []]
    for row in library:
        deals[draw.randrange(4) if row[0] != "s3" else 0].append(row)  # s3 comes once and stays in its batch
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in deals]
    for number in (0, 1):
        pages.add_pages(frames[number], number, state, "k b=1", EMBEDDER, 100, 20)

    def fails(*_):
        raise RuntimeError("lost")

    def shown():
        out = scratch_path(spark, "kb")
        pages.publish(spark, state, "k b=1", out)
        return rows_of(knowledge.load(spark, out, "k b=1"))

    monkeypatch.setattr(pages, "_live", fails)
    with pytest.raises(RuntimeError):  # its cuts are there, so it counts
        pages.add_pages(frames[2], 2, state, "k b=1", EMBEDDER, 100, 20)
    monkeypatch.undo()
    for number in (2, 3, 3):
        pages.add_pages(frames[number], number, state, "k b=1", EMBEDDER, 100, 20)
    live = at_once(spark, library, 100, 20)
    assert shown() == live
    counted = [spark.read.parquet(f"{state}/{part}").groupBy("batch").count().collect() for part in ("chunks", "carried")]
    assert sum(r["count"] for r in counted[0]) < 1.3 * len(live) and {r["batch"] for r in counted[0]} == {3}
    assert sum(r["count"] for r in counted[1]) < len(live) / 2
    first = spark.read.parquet(f"{state}/moves").where("of = 0")
    assert first.count() >= 1 and first.where("kept > 0").count() >= 1


def test_a_batch_that_takes_everything_away(spark, library):
    state = scratch_path(spark, "pages")
    pages.add_pages(spark.createDataFrame(library, SCHEMA), 0, state, "kb", EMBEDDER, 100, 20)
    rest = [r for r in library if r[0] == "s1"]
    gone = spark.createDataFrame([(s, n, None) for s, n, _ in library if s != "s1"], SCHEMA)
    pages.add_pages(gone, 1, state, "kb", EMBEDDER, 100, 20)
    assert published(spark, state) == at_once(spark, rest, 100, 20)
    pages.add_pages(spark.createDataFrame(library, SCHEMA), 2, state, "kb", EMBEDDER, 100, 20)
    assert published(spark, state) == at_once(spark, library, 100, 20)
