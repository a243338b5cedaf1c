"""Readings that a failure follows within a horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions.calendar import epoch_seconds

BUCKET = "__bucket"


def failures_ahead(
    readings: DataFrame,
    failures: DataFrame,
    machine: str,
    time: str,
    row_id: str,
    horizon: int = 4 * 3600,
    delay: str = "10 minutes",
) -> DataFrame:
    """The readings, once each, that a failure of their machine follows by at most ``horizon`` seconds.

    The join is on machine and time bucket, a quarter of the horizon long. The failures, which
    are few, are copied into the buckets they can be seen from, so a busy machine is spread
    over buckets and a reading meets only failures near it. A semi join gives no row per pair,
    however dense the failures are. On streams both sides carry a
    watermark and the condition bounds their distance, so what can no longer match is forgotten.
    """
    length = max(60, horizon // 4)
    left = readings.select(F.col(machine), F.col(row_id), F.col(time))
    right = failures.select(
        F.col(machine).alias("__machine"), F.col(time).alias("failure_time")
    )
    if readings.isStreaming:
        left = left.withWatermark(time, delay)
        right = right.withWatermark("failure_time", delay)
    at = epoch_seconds(F.col("failure_time"))
    seen_from = F.sequence(F.floor((at - horizon) / length), F.floor(at / length))
    left = left.withColumn(BUCKET, F.floor(epoch_seconds(F.col(time)) / length))
    right = right.withColumn("__seen_from", F.explode(seen_from))
    close = (F.col("failure_time") > F.col(time)) & (
        F.col("failure_time") <= F.col(time) + F.expr(f"INTERVAL {horizon} SECONDS")
    )
    same = (F.col(machine) == F.col("__machine")) & (F.col(BUCKET) == F.col("__seen_from"))
    return left.join(right, same & close, "left_semi").drop(BUCKET)
