"""The chunking table function and the interval join against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import chunks, intervals, windows


@pytest.mark.parametrize("size,overlap", [(50, 10), (30, 29), (1000, 200), (7, 0)])
def test_table_function_gives_the_chunks(spark, size, overlap):
    draw = random.Random(size)
    rows = [(f"s{i % 5}", i, draw.choice([None, " ", "x", "é " * draw.randrange(40), "word " * draw.randrange(60) + "　"])) for i in range(60)]
    rows += [("one", 1, "y" * 333), ("none", 1, "")]
    pages = spark.createDataFrame(rows, "source string, page_number bigint, text string")
    pages.createOrReplaceTempView("some_pages")
    windows.register(spark)
    got = spark.sql(f"SELECT * FROM chunk_pages(TABLE(some_pages) PARTITION BY source ORDER BY (page_number), {size}, {overlap})")
    want = chunks.chunk_documents(pages, size, overlap).select(*got.columns)
    key = ["source", "chunk_number"]
    assert [tuple(r) for r in got.orderBy(key).collect()] == [tuple(r) for r in want.orderBy(key).collect()]


def test_table_function_holds_a_window():
    cut, longest, n = windows.ChunkPages(), 0, 0
    for i in range(3000):
        n += len(list(cut.eval({"source": "s", "page_number": i, "text": "abc " * 20}, 100, 20)))
        longest = max(longest, len(cut.held) + 10 * len(cut.pages))
    assert n > 2900 and longest < 400
    with pytest.raises(ValueError):
        list(windows.ChunkPages().eval({"source": "s", "page_number": 1, "text": "a"}, 10, 10))


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_overlaps(spark, width):
    draw = random.Random(4)

    def some(n):
        rows = [(draw.choice(["hot", "hot", "hot", "a", None]), i, (s := draw.randrange(-20, 300)), s + draw.choice([0, 1, 5, 30])) for i in range(n)]
        return rows + [("hot", 900, 0, 300), ("hot", 901, 10, None), ("hot", 902, None, 5), ("hot", 903, 9, 3), ("hot", 900, 0, 300)]

    left, right = some(80), some(60)
    schema = "source string, id int, start long, end long"
    met = intervals.overlapping(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["source"], width)
    got = sorted((r["source"], r["left"]["id"], r["right"]["id"], r["shared"]) for r in met.collect())
    want = sorted(
        (a[0], a[1], b[1], min(a[3], b[3]) - max(a[2], b[2]))
        for a in left for b in right
        if a[0] is not None and a[0] == b[0] and None not in (a[2], a[3], b[2], b[3]) and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]
    )
    assert got == want


def test_one_long_source_is_spread_over_its_bins(spark):
    rows = spark.range(20_000).selectExpr("'book' as source", "id * 10 as start", "id * 10 + 15 as end", "id")
    listed = intervals.overlapping(rows, rows, ["source"], 500).groupBy(F.floor(F.col("left.start") / 500)).count()
    assert listed.agg(F.max("count")).first()[0] <= 50 * 3
