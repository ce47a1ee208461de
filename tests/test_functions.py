"""Edge rows of the row-wise functions."""

import pytest
from pyspark.sql import functions as F

from larkspur.functions import tabular as ft
from larkspur.functions.text import clean_text, flatten_blocks, page_ranges, strip, to_number


def values(spark, rows, schema, expression):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_strip_removes_what_python_removes(spark):
    texts = [chr(c) + "a b" + chr(c) for c in range(0x3100) if chr(c).isspace()] + ["​x​", " ", "", None]
    got = values(spark, [(t,) for t in texts], "t string", strip(F.col("t")))
    assert got == [None if t is None else t.strip() for t in texts]


def test_clean_text(spark):
    rows = [("a\r\nb\rc",), ("x \t  y",), ("p\n\n\n\n\nq",), (" \n a \n ",), ("",), (None,)]
    assert values(spark, rows, "t string", clean_text(F.col("t"))) == ["a\nb\nc", "x y", "p\n\nq", "a", "", ""]


def test_to_number(spark):
    rows = [(t,) for t in (" 12 ", "", "x", "1d", "NaN", "inf", None, "-.5e1", "1.", "+3", "1_0", "0x1")]
    want = [12.0, None, None, None, None, None, None, -5.0, 1.0, 3.0, None, None]
    assert values(spark, rows, "t string", to_number(F.col("t"))) == want


def test_tenure_bins(spark):
    tenures = [-1.0, 0.0, 6.0, 7.0, 12.0, 13.0, 24.0, 25.0, 48.0, 49.0, None]
    names = ["0-6 months", "7-12 months", "13-24 months", "25-48 months", "49+ months"]
    want = [None, names[0], names[0], names[1], names[1], names[2], names[2], names[3], names[3], names[4], None]
    rows = [(t,) for t in tenures]
    assert values(spark, rows, "t double", ft.tenure_group(F.col("t"))) == want
    assert values(spark, rows, "t double", ft.tenure_ordinal(ft.tenure_group(F.col("t")))) == [
        None if n is None else names.index(n) + 1 for n in want
    ]
    assert values(spark, rows, "t double", ft.is_new_customer(F.col("t"))) == ["Yes"] * 3 + ["No"] * 8


def test_risk_bands(spark):
    rows = [(p,) for p in (0.0, 0.2999, 0.30, 0.5999, 0.60, 1.0, None)]
    want = ["Low", "Low", "Medium", "Medium", "High", "High", None]
    assert values(spark, rows, "p double", ft.risk_band(F.col("p"))) == want


def test_performance_category_treats_nan_as_missing(spark):
    rows = [(70.0,), (69.99,), (50.0,), (49.0,), (None,), (float("nan"),)]
    want = ["High", "Medium", "Medium", "Low", "Unknown", "Unknown"]
    assert values(spark, rows, "s double", ft.performance_category(F.col("s"))) == want


def test_row_mean_skips_missing(spark):
    rows = [(1.0, None, 2.0), (None, None, None), (3.0, 3.0, 3.0)]
    got = values(spark, rows, "a double, b double, c double", ft.row_mean(F.col("a"), F.col("b"), F.col("c")))
    assert got == [1.5, None, 3.0]


def test_spend_falls_back_to_the_monthly_charge(spark):
    rows = [(10.0, 100.0, 7.0), (0.0, 100.0, 7.0), (None, 100.0, 7.0), (10.0, None, 7.0)]
    got = values(spark, rows, "t double, total double, m double", ft.avg_monthly_spend(F.col("t"), F.col("total"), F.col("m")))
    assert got == [10.0, 7.0, 7.0, None]


def test_count_yes(spark):
    got = values(spark, [("Yes", " yes "), ("no", None), ("YES", "Yes, a lot")], "a string, b string", ft.count_yes(F.col("a"), F.col("b")))
    assert got == [2, 0, 1]


@pytest.mark.parametrize(
    "pages, text",
    [([], ""), ([4], "4"), ([1, 2, 3, 5, 6], "1-3, 5-6"), ([6, 5, 5, 1], "1, 5-6"), ([2, 4, 6], "2, 4, 6")],
)
def test_page_ranges(spark, pages, text):
    assert values(spark, [(pages,)], "p array<int>", page_ranges(F.col("p"))) == [text]


def test_flatten_blocks(spark):
    rows = [
        (" plain ", None),
        (None, [("text", "a"), ("image", "x"), ("text", ""), ("text", "b")]),
        (None, [("text", "  ")]),
        (None, None),
    ]
    got = values(spark, rows, "t string, b array<struct<type: string, text: string>>", flatten_blocks(F.col("t"), F.col("b")))
    assert got == ["plain", "a\nb", None, None]
