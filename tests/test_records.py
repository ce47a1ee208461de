"""Records over several lines, with splits that end anywhere, against the csv module."""

import csv
import io
import random

import pytest

from larkspur.sources import records
from larkspur.sources.delimited import read_dirty, read_plain, write_plain

MARKS = ["CustomerID", "Tenure Months", "Churn Label"]


def plain(text, separator=","):
    return list(csv.reader(io.StringIO(text), delimiter=separator))


@pytest.fixture(params=[150, 1 << 27])
def split_bytes(spark, request):
    """Splits of a few bytes, so that records run over many of them, and whole files."""
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, value in keys.items():
        spark.conf.set(k, value)
    yield request.param
    for k, value in before.items():
        spark.conf.set(k, value)


def test_the_state_after_a_line():
    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice('",ab\n') for _ in range(draw.randint(1, 14)))
        lines = text.split("\n")
        opened, found = False, [""]
        for i, line in enumerate(lines):
            if opened or i == 0:
                found[-1] += line + "\n"
            else:
                found.append(line + "\n")
            opened = records.ends_open(line, ",", opened)
        whole = plain(text + "\n")
        apart = [row for record in found for row in plain(record)]
        assert apart == whole and all(len(plain(record)) == 1 for record in found)


def field(draw):
    kind = draw.randrange(6)
    if kind == 0:
        return str(draw.randrange(1000))
    text = "".join(draw.choice(['"', "\n", ",", "x", "yz ", "é", "\n\n", ";"]) for _ in range(draw.randrange(25)))
    return f"v{text}w" if kind < 5 else "word"


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in '",\n;') else value


@pytest.mark.parametrize("seed", range(2))
def test_dirty_files(spark, tmp_path, split_bytes, seed):
    draw = random.Random(seed)
    want = []
    for n in range(4):
        rows = [[f"{n}-{i}", field(draw), field(draw), str(i)] for i in range(15)]
        if n == 3:
            rows = [[r[0], "a", "b", r[3]] for r in rows]  # no quotes at all
        lines = ['junk, "open', "", "CustomerID,Tenure Months,Churn Label,place"]
        for row in rows:
            lines += [",".join(map(quoted, row))] + [""] * draw.randrange(2)
        body = "\n".join(lines) + "\n"
        (tmp_path / f"f{n}.csv").write_text(body, encoding="utf-8")
        again = plain("\n".join(lines[3:]) + "\n")
        assert [r for r in again if r] == rows
        want += rows
    got = read_dirty(spark, str(tmp_path), MARKS)
    ordered = got.orderBy("row_id").collect()
    assert [[r["CustomerID"], r["Tenure Months"], r["Churn Label"], r["place"]] for r in ordered] == [
        [value.strip() for value in row] for row in sorted(want, key=lambda r: (int(r[0][0]), int(r[3])))
    ]


def test_plain_files(spark, tmp_path, split_bytes):
    draw = random.Random(8)
    rows = [(i, field(draw), field(draw)) for i in range(60)]
    path = str(tmp_path / "plain")
    write_plain(spark.createDataFrame(rows, "id long, a string, b string").repartition(3), path)
    back = read_plain(spark, path, "id long, a string, b string", multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == rows
    schema = spark.createDataFrame(rows, "id long, a string, b string").schema
    assert read_plain(spark, path, schema, multi_line=True).count() == 60


def test_one_record_over_many_splits_and_an_open_end(spark, tmp_path, split_bytes):
    long = "\n".join(f'line {i} with ""quotes"", and more' for i in range(40))
    body = f'CustomerID,Tenure Months,Churn Label\na,"{long}",Yes\nb,1,No\nc,"open\nto the end\n'
    (tmp_path / "f.csv").write_text(body, encoding="utf-8")
    rows = {r["CustomerID"]: r for r in read_dirty(spark, str(tmp_path), MARKS).collect()}
    assert rows["a"]["Tenure Months"] == long.replace('""', '"') and rows["a"]["Churn Label"] == "Yes"
    assert rows["b"]["Churn Label"] == "No" and set(rows) == {"a", "b", "c"}
    assert "to the end" in rows["c"]["Tenure Months"]


def test_many_files_without_a_broadcast(spark, tmp_path, split_bytes, monkeypatch):
    """Headers and states that reach the lines by a shuffle."""
    from larkspur.operators import bounds
    from larkspur.sources import delimited

    for module in (bounds, delimited, records):
        monkeypatch.setattr(module, "local_copy", lambda df, max_rows=0: None)
    want = set()
    for n in range(3):
        (tmp_path / f"f{n}.csv").write_text(f'CustomerID,Tenure Months,Churn Label\n{n},"a\nb,""{n}""\n\nc",x\n9{n},1,"y\nz"\n', encoding="utf-8")
        want |= {(str(n), f'a\nb,"{n}"\n\nc', "x"), (f"9{n}", "1", "y\nz")}
    got = read_dirty(spark, str(tmp_path), MARKS)
    assert {(r["CustomerID"], r["Tenure Months"], r["Churn Label"]) for r in got.collect()} == want


def test_unquoted_marks_do_not_join_lines(spark, tmp_path, split_bytes):
    (tmp_path / "f.csv").write_text('CustomerID,Tenure Months,Churn Label\na,5" pipe,x\nb, "y,z\nc,"1"2,w\n', encoding="utf-8")
    rows = sorted(r["CustomerID"] for r in read_dirty(spark, str(tmp_path), MARKS).collect())
    assert rows == ["a", "b", "c"]
