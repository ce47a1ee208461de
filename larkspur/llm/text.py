"""Words and keys that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space are words; ``bytes.split()`` gives the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a missing key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the joined texts, the same in every engine with md5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def as_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def carried(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``row`` with the columns to carry, and the text beside it unless it is one of them."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    return docs.select(row) if "text" in columns else docs.select(row, "text")


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of a ``carried`` frame."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")
