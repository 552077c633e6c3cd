"""Stateful stream operators that also run unchanged on batch DataFrames.

Each function takes a DataFrame (streaming or not) and returns a lazy plan; the
watermark arguments are applied only when the input is streaming, so the same
code is the batch twin used for oracle checks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if (delay and df.isStreaming) else df


def tumbling_stats(df: DataFrame, ts: str, keys: Sequence[str], count_col: str, avg_col: str,
                   width: str = "5 minutes", watermark: str | None = "10 minutes") -> DataFrame:
    """Non-overlapping windows × keys: ``count(count_col)``, ``avg(avg_col)``.

    On a stream in append mode a window is emitted once the watermark passes
    its end; its state is then dropped.
    """
    src = _watermarked(df, ts, watermark)
    agg = (src.groupBy(F.window(ts, width).alias("time"), *keys)
           .agg(F.count(count_col).alias("orders_count"), F.avg(avg_col).alias("avg_value")))
    return agg.select(F.col("time.start").alias("window_start"), F.col("time.end").alias("window_end"),
                      *keys, "orders_count", F.round("avg_value", 4).alias("avg_value"))


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str | None = None,
                 watermark: str | None = "30 seconds") -> DataFrame:
    """Drop duplicate rows on ``keys`` (which should include the event time).

    On a stream the watermark bounds the state: keys older than the watermark
    are forgotten, and rows arriving later than it are dropped.
    """
    src = _watermarked(df, ts, watermark) if ts else df
    if src.isStreaming and ts and watermark:
        return src.dropDuplicatesWithinWatermark(list(keys)) if ts not in keys else src.dropDuplicates(list(keys))
    return src.dropDuplicates(list(keys))
