"""Batch and streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from smeltery.sources.commits import write_batch


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A processing-time trigger, or one run over what is there when no interval is given."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = "30 seconds",
) -> StreamingQuery:
    """Append a stream to partitioned Parquet; the checkpoint makes the files exactly-once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, every).start()


def transform_stream(
    df: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    partition_by: Sequence[str],
    every: str | None = "60 seconds",
) -> StreamingQuery:
    """Run a batch transformation on every micro-batch and commit its result once.

    The table is read by ``commits.read_table``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch), batch_id, path, partition_by)

    writer = df.writeStream.foreachBatch(handle).outputMode("append").option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def _partitioned(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    return df.write.mode("overwrite").partitionBy(*partition_by)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str]) -> dict[str, int]:
    """Replace a table and report rows and columns.

    The rows are counted while they are written; the plan is not run a second time.
    """
    seen = Observation()
    (
        _partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows")), partition_by)
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def _files_of(df: DataFrame, path: str, condition: Column) -> set[str]:
    """The files below ``path`` with rows, shaped like ``df``, that meet a condition."""
    try:
        table = df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row[0] for row in table.where(condition).select("_metadata.file_path").distinct().collect()}


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], replaced: Column | None = None
) -> dict[str, int]:
    """Replace only the partitions that occur in ``df`` and report rows and columns.

    ``replaced`` is a condition on the partition columns; the rows stand for all partitions that
    meet it, and those of them that got no row become empty: the folders in which a file from
    before the write is still there. Files are compared, not values or folder names.
    """
    before = set() if replaced is None else _files_of(df, path, replaced)
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    _partitioned(rows, partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    if before:
        inside = T.StructType([f for f in df.schema if f.name not in partition_by])
        for folder in {unquote(file.rsplit("/", 1)[0]) for file in before & _files_of(df, path, replaced)}:
            df.sparkSession.createDataFrame([], inside).coalesce(1).write.mode("overwrite").parquet(folder)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as messages: the key column as text and the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(df: DataFrame, key: str, brokers: str, topic: str) -> None:
    """Send rows to a topic as keyed JSON. Needs the Kafka connector."""
    (
        keyed_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
