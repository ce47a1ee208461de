"""Scoring on streams of files, each run taking what is new."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators import models
from larkspur.plans.churn import prepare


def file_stream(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """New Parquet files of a table that is a file or a folder of part files.

    ``files`` bounds the files of one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern, the path may be a single file


def first_records(records: DataFrame, id_column: str, time_column: str, delay: str) -> DataFrame:
    """The first record of each id to arrive; others of the id within ``delay`` of event time are dropped.

    The state store keeps an id until the watermark, ``delay`` behind the latest time seen, has
    passed its first record's time by ``delay``, so state is bounded by the ids of that span.
    Records older than the watermark are dropped, records without a time or an id as well.
    """
    known = records.where(F.col(id_column).isNotNull() & F.col(time_column).isNotNull())
    return known.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([id_column])


def stream_first_records(records: DataFrame, id_column: str, time_column: str, delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the first record of each id to ``out``; a restart goes on with the ids it knows."""
    kept = first_records(records, id_column, time_column, delay)
    return (
        kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_scores(
    records: DataFrame, model: PipelineModel, id_column: str, categorical: list[str], numeric: list[str],
    out: str, checkpoint: str,
) -> StreamingQuery:
    """Score a stream of raw records with a saved model and append the results to ``out``.

    Stateless: every record is scored once, the checkpoint makes restarts exact.
    """
    actions = models.action_table(records.sparkSession)
    scored = models.score(model, prepare(records), id_column, categorical, numeric, actions)
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
