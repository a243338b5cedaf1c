"""Event-time windows on a stream that lose no row: late ones are kept, with the windows they missed.

Spark's own windowed aggregation drops a row whose windows are closed without a trace. Here every
micro-batch is compared with the watermark that the batches before it set. Of each row and window it
lies in, open ones are aggregated and closed ones set aside, so every row is in the windows or in
the table of late rows.

A batch adds one partial row per window and key to a table; what the batches have of a window is put
together when it is read. There is no state to restore, a busy key is reduced before the shuffle,
and a replayed batch replaces what it wrote, because its watermark comes from earlier batches only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smeltery.sources import commits
from smeltery.sources.writers import with_trigger

WINDOW = ("window_start", "window_end")


def _folders(path: str) -> tuple[str, str, str]:
    return f"{path}/windows", f"{path}/late", f"{path}/times"


def _watermark(spark: SparkSession, times: str, batch_id: int | None, delay: str) -> Column:
    """The newest event time of the batches before ``batch_id`` (of all, for None) less the delay."""
    known = commits.commits(spark, times)
    if known.isEmpty():
        return F.lit(None).cast("timestamp")
    seen = commits.read_table(spark, times)
    newest = (seen if batch_id is None else seen.where(F.col("batch") < batch_id)).agg(F.max("newest")).first()[0]
    return F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")


def _partials(df: DataFrame, keys: Sequence[str], sensors: Sequence[str]) -> DataFrame:
    parts = [F.count(F.lit(1)).alias("readings")]
    for s in sensors:
        parts += [F.count(s).alias(f"{s}_n"), F.sum(F.col(s).cast("double")).alias(f"{s}_sum")]
        parts += [F.min(s).alias(f"{s}_min"), F.max(s).alias(f"{s}_max")]
    return df.groupBy(*WINDOW, *keys).agg(*parts)


def start_windows(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    sensors: Sequence[str],
    path: str,
    checkpoint: str,
    length: str = "5 minutes",
    step: str | None = None,
    delay: str = "10 minutes",
    every: str | None = "60 seconds",
) -> StreamingQuery:
    """Aggregate a stream by tumbling or, with ``step``, sliding windows, and keep late rows.

    A window is closed once its end is not after the newest event time of earlier batches less
    ``delay``. A row with a NULL time has no window and is late with NULL windows.
    """
    windows, late, times = _folders(path)
    spread = F.window(time, length, step) if step else F.window(time, length)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        watermark = _watermark(spark, times, batch_id, delay)
        timed = batch.where(F.col(time).isNotNull()).withColumn("__window", spread)
        placed = timed.select(
            "*", F.col("__window.start").alias(WINDOW[0]), F.col("__window.end").alias(WINDOW[1])
        ).drop("__window")
        closed = F.coalesce(F.col(WINDOW[1]) <= watermark, F.lit(False))
        nowhere = batch.where(F.col(time).isNull()).withColumns({name: F.lit(None).cast("timestamp") for name in WINDOW})
        commits.write_batch(_partials(placed.where(~closed), keys, sensors), batch_id, windows)
        commits.write_batch(placed.where(closed).unionByName(nowhere), batch_id, late)
        newest = batch.agg(F.max(time).alias("newest")).withColumn("batch", F.lit(batch_id))
        commits.write_batch(newest, batch_id, times)

    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def read_windows(
    spark: SparkSession, path: str, keys: Sequence[str], sensors: Sequence[str], delay: str | None = None
) -> DataFrame:
    """The windows as far as the batches have filled them; with ``delay`` only those that are closed."""
    windows, _, times = _folders(path)
    rows = commits.read_table(spark, windows)
    if delay is not None:
        rows = rows.where(F.col(WINDOW[1]) <= _watermark(spark, times, None, delay))
    parts = [F.sum("readings").alias("readings")]
    for s in sensors:
        parts.append(F.try_divide(F.sum(f"{s}_sum"), F.sum(f"{s}_n")).alias(f"{s}_mean"))
        parts += [F.min(f"{s}_min").alias(f"{s}_min"), F.max(f"{s}_max").alias(f"{s}_max")]
    return rows.groupBy(*WINDOW, *keys).agg(*parts)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, once for every window they missed, with that window."""
    return commits.read_table(spark, _folders(path)[1])


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """``batch, rows``: how many rows of each batch missed a window, from the commits alone."""
    return commits.current(spark, _folders(path)[1]).select("batch", "rows").where("rows > 0")


def compact(spark: SparkSession, path: str) -> None:
    """Bring the partial rows, late rows and times of past batches together."""
    for folder in _folders(path):
        commits.compact(spark, folder)
