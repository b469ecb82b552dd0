"""Incremental ingestion: deduplicated raw documents, batchwise upserts, counts in time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, id_col: str, time_col: str, delay: str = "1 hour") -> DataFrame:
    """Each id once, as long as repeats come within the delay; state older than that is dropped."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def windowed_counts(stream: DataFrame, time_col: str, key: Column, width: str, delay: str = "0 seconds") -> DataFrame:
    """(window_start, key, n) in tumbling windows; rows later than the delay are left out."""
    g = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w"), key.alias("key")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "key", "n")


def upsert_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that hands every micro-batch to write(batch, number) once available data is read."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
