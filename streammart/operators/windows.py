"""Tumbling event-time aggregation, the core of all statistics tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions.times import as_stream_time, time_text


def tumbling_agg(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, Column],
    size: str = "2 seconds",
    event_time: str = "event_time",
    delay: str | None = None,
) -> DataFrame:
    """Aggregate by ``keys`` in epoch-aligned windows.

    Adds the window bounds as ``stt`` and ``edt`` text.  On a stream, rows older
    than the watermark (``delay`` behind the newest row) are dropped and each
    window is emitted once, when the watermark passes its end.  Groups are
    combined before the shuffle, so hot keys cost no more than others.
    """
    if df.isStreaming and delay is not None:
        df = as_stream_time(df, event_time).withWatermark(event_time, delay)
    window = F.window(event_time, size).alias("_window")
    grouped = df.groupBy(window, *keys).agg(*[c.alias(name) for name, c in aggs.items()])
    return grouped.select(
        time_text("_window.start").alias("stt"),
        time_text("_window.end").alias("edt"),
        *keys,
        *aggs,
    )


def union_feeds(
    feeds: Sequence[DataFrame], delay: str | None, own_watermarks: bool = False, event_time: str = "event_time"
) -> DataFrame:
    """Several feeds as one, streams under a watermark ``delay`` behind.

    By default the watermark follows the newest row of any feed: windows never wait, and a feed that runs
    more than ``delay`` behind another loses rows.  With ``own_watermarks`` each feed has its own and the
    slowest counts (``spark.sql.streaming.multipleWatermarkPolicy`` is ``min`` by default): a slow feed loses
    nothing, and ``delay`` need only cover the disorder within a feed.  Then a feed that has not sent a row
    yet, or falls silent, holds all windows back; use it where every feed keeps sending.
    """

    def marked(df: DataFrame) -> DataFrame:
        return as_stream_time(df, event_time).withWatermark(event_time, delay) if df.isStreaming and delay is not None else df

    union = None
    for df in feeds:
        df = marked(df) if own_watermarks else df
        union = df if union is None else union.unionByName(df)
    return union if own_watermarks else marked(union)


def running_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """The same without windows: totals so far.  On a stream use update mode."""
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all there, and the rows to keep aside."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(~missing), df.filter(missing)


def stamped(df: DataFrame, name: str = "ts") -> DataFrame:
    """Add the processing time in epoch milliseconds."""
    return df.withColumn(name, F.unix_millis(F.current_timestamp()))
