"""The row-wise operators on streams of cards: seen-before, batches, freshness."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def unseen(stream: DataFrame, keys: Sequence[str], time_col: str, within: str = "3 days") -> DataFrame:
    """Rows whose key was not seen within the watermark; state older than that is dropped."""
    return stream.withWatermark(time_col, within).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, by: Sequence[str], time_col: str, *, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Rows by group and window of event time; rows later than ``late`` are left out."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, window), *by).agg(F.count("*").alias("n"))


def persist(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Give each batch to ``write`` (which must bear a repeated batch number)."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
