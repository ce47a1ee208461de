"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
BOM = "﻿"

# Texts that a delimited file uses for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Drop all Unicode white space at both ends (SQL ``trim`` drops only spaces)."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """LF line ends, single blanks, at most one empty line in a row, no outer space."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip(out)


def to_number(text: Column) -> Column:
    """Text as double; what has not the shape of a finite number becomes NULL."""
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(NUMBER_SHAPE), trimmed.try_cast("double"))


def preview(text: Column, length: int = 500) -> Column:
    """The first ``length`` characters, for display."""
    return F.substring(text, 1, length)


def flatten_blocks(text: Column, blocks: Column) -> Column:
    """Answer text of a response given as plain text or as typed content blocks.

    Text blocks that are not empty are joined with line feeds; a blank answer is NULL.
    """
    texts = F.transform(
        F.filter(blocks, lambda b: (b["type"] == "text") & (b["text"] != "")), lambda b: b["text"]
    )
    answer = strip(F.coalesce(text, F.array_join(texts, "\n")))
    return F.when(answer != "", answer)


def page_ranges(pages: Column) -> Column:
    """Format an array of page numbers as in ``1-3, 5-6``; an empty array gives ``''``."""
    ordered = F.array_sort(F.array_distinct(F.filter(pages, lambda p: p.isNotNull())))
    starts = F.filter(ordered, lambda p: ~F.array_contains(ordered, p - 1))
    ends = F.filter(ordered, lambda p: ~F.array_contains(ordered, p + 1))
    spans = F.zip_with(
        starts,
        ends,
        lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat_ws("-", a.cast("string"), b.cast("string"))),
    )
    return F.array_join(spans, ", ")


def page_list(pages: Column) -> Column:
    """Format page numbers as in ``1, 2, 5``, in the order given."""
    return F.array_join(F.transform(pages, lambda p: p.cast("string")), ", ")
