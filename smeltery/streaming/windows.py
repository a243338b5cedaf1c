"""Event-time windows per machine; the same code runs on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _statistics(sensors: Sequence[str]) -> list[Column]:
    parts = [F.count(F.lit(1)).alias("readings")]
    for s in sensors:
        parts += [F.avg(s).alias(f"{s}_mean"), F.min(s).alias(f"{s}_min"), F.max(s).alias(f"{s}_max")]
    return parts


def _by_window(df: DataFrame, window: Column, keys: Sequence[str], sensors: Sequence[str]) -> DataFrame:
    grouped = df.groupBy(window.alias("__window"), *keys).agg(*_statistics(sensors))
    return grouped.select(
        F.col("__window.start").alias("window_start"),
        F.col("__window.end").alias("window_end"),
        *[name for name in grouped.columns if name != "__window"],
    )


def _watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    return df.withWatermark(time, delay) if df.isStreaming else df


def tumbling(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    sensors: Sequence[str],
    length: str = "5 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    return _by_window(_watermarked(df, time, delay), F.window(time, length), keys, sensors)


def sliding(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    sensors: Sequence[str],
    length: str = "30 minutes",
    step: str = "5 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """Aligned sliding windows, the streaming form of the rolling statistics."""
    return _by_window(_watermarked(df, time, delay), F.window(time, length, step), keys, sensors)


def sessions(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    sensors: Sequence[str],
    gap: str = "30 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """Stretches of readings without a pause as long as ``gap``; the pauses are outages.

    With the session's setting ``LOCAL_SESSIONS`` a stream's readings are merged to sessions in
    their input partition first, so that a busy machine sends a row per session and partition.
    """
    return _by_window(_watermarked(df, time, delay), F.session_window(time, gap), keys, sensors)
