"""Chunks as a table function: one page in, any number of chunks out, one window of text held.

``chunk_pages`` is called in SQL over pages partitioned by source and ordered by number:

    SELECT * FROM chunk_pages(TABLE(pages) PARTITION BY source ORDER BY (page_number), 1000, 200)

A chunk leaves as soon as the text reaches its end, and what lies before the next chunk is
forgotten, so the state is a chunk and a page, however long the source. A source is read by
one task in order; ``chunks.chunk_documents`` gives the same rows with a source over many tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from larkspur.operators.chunks import SEPARATOR, check_window

SCHEMA = "source string, chunk_number bigint, page_numbers array<bigint>, text string, character_count int"


class ChunkPages:
    """``eval`` takes a page (source, page_number, text); ``terminate`` ends the source."""

    def __init__(self):
        self.source, self.held, self.at = None, "", 0  # the text from character ``at`` of the source on
        self.number = 0
        self.pages: list[tuple[int, int, int]] = []  # pages that reach into the text held: number, start, end
        self.size = self.overlap = 0

    def eval(self, page: Row, size: int, overlap: int) -> Iterator[tuple]:
        if not self.size:
            check_window(size, overlap)
            self.size, self.overlap = size, overlap
        text = (page["text"] or "").strip()
        if not text:
            return
        self.source = page["source"]
        start = self.at + len(self.held) + (len(SEPARATOR) if self.at or self.held else 0)
        self.held += (SEPARATOR if self.at or self.held else "") + text
        self.pages.append((page["page_number"], start, start + len(text)))
        while len(self.held) >= self.size:
            yield from self._chunk()
            step = self.size - self.overlap
            self.held, self.at, self.number = self.held[step:], self.at + step, self.number + 1
            self.pages = [p for p in self.pages if p[2] > self.at]

    def terminate(self) -> Iterator[tuple]:
        if self.held and (self.number == 0 or len(self.held) > self.overlap):
            yield from self._chunk()

    def _chunk(self) -> Iterator[tuple]:
        text, end = self.held[: self.size].strip(), self.at + self.size
        if text:
            numbers = [n for n, first, last in self.pages if last > self.at and first < end]
            yield self.source, self.number, numbers, text, len(text)


def register(spark: SparkSession, name: str = "chunk_pages") -> None:
    """Make the function known to the session's SQL."""
    spark.udtf.register(name, udtf(ChunkPages, returnType=SCHEMA))


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
