"""Incremental runs: the batch transformations over a stream of files, with checkpoints in place of resume files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def clean_stream(rows: DataFrame, text: str = "text", time: str | None = None, delay: str = "30 days") -> DataFrame:
    """Cleaned rows, the first to arrive of equal texts. With a time column, hashes older than the delay are forgotten."""
    hashed = rows.withColumn(text, T.clean_text(F.col(text))).withColumn("text_hash", T.hash_strict(F.col(text)))
    if time:
        return hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_hash"])
    return hashed.dropDuplicates(["text_hash"])


def window_counts(events: DataFrame, time: str, window: str, slide: str | None, delay: str, *by: str) -> DataFrame:
    """Rows and summed values in windows of time, late data allowed by the delay."""
    span = F.window(time, window, slide) if slide else F.window(time, window)
    return events.withWatermark(time, delay).groupBy(span, *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Processes what has arrived, batch by batch, and stops; a later call goes on from there."""
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
