"""Merged profiles against exact ones."""

import random

import pytest

from larkspur.operators import sketches
from larkspur.session import scratch_path

SCHEMA = "day string, id long, amount double, kind string, empty int"


def rows_of(day, n, seed):
    draw = random.Random(seed)
    return [(day, draw.randrange(5000), draw.choice([draw.gauss(0, 10), None, float("nan")]), draw.choice("aaaabbc") if i % 9 else None, None) for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "profiles")
    days = {f"d{i}": rows_of(f"d{i}", 4000 * (i + 1), i) for i in range(3)}
    columns = ["id", "amount", "kind", "empty"]
    sketches.add_parts(spark.createDataFrame(days["d0"] + days["d1"], SCHEMA), path, "day", columns)
    sketches.add_parts(spark.createDataFrame(days["d2"], SCHEMA), path, "day", columns)
    return path, days


@pytest.mark.parametrize("parts", [None, ["d0"], ["d1", "d2"]])
def test_error_bounds(spark, stored, parts):
    path, days = stored
    rows = [r for d in (parts or days) for r in days[d]]
    found = {r["column"]: r for r in sketches.merged(spark, path, parts).collect()}
    for place, name in enumerate(("id", "amount", "kind", "empty"), 1):
        values = [r[place] for r in rows]
        known = [v for v in values if v is not None]
        r = found[name]
        assert r["rows"] == len(rows) and r["missing"] == len(values) - len(known)
        distinct = len({str(v) for v in known})
        assert abs(r["distinct"] - distinct) <= max(1, 0.03 * distinct)
        numbers = sorted(v for v in known if not isinstance(v, str) and v == v)
        if numbers:
            assert (r["min"], r["max"]) == (numbers[0], numbers[-1])
            for q, value in zip((0.25, 0.5, 0.75), r["quantiles"]):
                below, upto = sum(v < value for v in numbers) / len(numbers), sum(v <= value for v in numbers) / len(numbers)
                assert below - 0.03 <= q <= upto + 0.03
        else:
            assert r["min"] is None and r["quantiles"] is None
    exact = {k: sum(r[3] == k for r in rows) for k in "abc"}
    assert [(v["value"], v["n"], v["error"]) for v in found["kind"]["frequent"]] == [(k, exact[k], 0) for k in sorted(exact, key=lambda k: -exact[k])]
    counts = {}
    for r in rows:
        counts[str(r[1])] = counts.get(str(r[1]), 0) + 1
    for v in found["id"]["frequent"]:
        assert v["n"] <= counts[v["value"]] <= v["n"] + v["error"]


def test_a_part_is_replaced_alone(spark, stored):
    path, days = stored
    before = {r["column"]: r["rows"] for r in sketches.merged(spark, path, ["d0"]).collect()}
    copy = scratch_path(spark, "profiles")
    spark.read.parquet(path).write.partitionBy("part").parquet(copy)
    sketches.add_parts(spark.createDataFrame(days["d1"][:100], SCHEMA), copy, "day", ["id", "amount", "kind", "empty"])
    assert {r["column"]: r["rows"] for r in sketches.merged(spark, copy, ["d0"]).collect()} == before
    assert {r["rows"] for r in sketches.merged(spark, copy, ["d1"]).collect()} == {100}
