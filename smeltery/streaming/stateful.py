"""Row lags on a stream, with the last readings of every machine carried between batches.

``stream_lags`` keeps them as keyed state; one machine's share of a batch is handled by one
task, so bound the batch at the source. ``start_lag_batches`` keeps them in a table beside the
output and runs the sliced batch operator, which splits a busy machine over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from smeltery.operators.rolling import RollingSpec, lag_features
from smeltery.sources.commits import write_batch
from smeltery.sources.writers import with_trigger


class LagProcessor(StatefulProcessor):
    """Appends lag columns; keeps as many readings per machine as the longest lag.

    Readings of one batch are put in order of time and id. Readings that arrive in a later
    batch than newer ones get lags in order of arrival.
    """

    def __init__(self, machine: str, time: str, row_id: str, sensors: Sequence[str], lags: Sequence[int]):
        self._machine, self._time, self._row_id = machine, time, row_id
        self._sensors, self._lags, self._depth = list(sensors), list(lags), max(lags)

    def init(self, handle: StatefulProcessorHandle) -> None:
        values = T.StructType([T.StructField(s, T.ArrayType(T.DoubleType())) for s in self._sensors])
        self._recent = handle.getValueState("recent", values)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values([self._time, self._row_id])
        state = self._recent.get() if self._recent.exists() else None
        tails = []
        result = batch.reset_index(drop=True)
        for i, s in enumerate(self._sensors):
            before = pd.Series(list(state[i]) if state is not None else [], dtype="float64")
            joined = pd.concat([before, result[s].astype("float64")], ignore_index=True)
            for n in self._lags:
                result[f"{s}_lag{n}"] = joined.shift(n).iloc[len(before):].to_numpy()
            tails.append([None if pd.isna(v) else float(v) for v in joined.tail(self._depth)])
        self._recent.update(tuple(tails))
        yield result

    def close(self) -> None:
        pass


def stream_lags(
    df: DataFrame, machine: str, time: str, row_id: str, sensors: Sequence[str], lags: Sequence[int] = (1, 5, 10)
) -> DataFrame:
    """Lag columns on a stream. The query needs the RocksDB state store."""
    schema = T.StructType(
        list(df.schema.fields)
        + [T.StructField(f"{s}_lag{n}", T.DoubleType()) for s in sensors for n in lags]
    )
    return df.groupBy(machine).transformWithStateInPandas(
        statefulProcessor=LagProcessor(machine, time, row_id, sensors, lags),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )


def start_lag_batches(
    df: DataFrame,
    spec: RollingSpec,
    path: str,
    recent_path: str,
    checkpoint: str,
    every: str | None = "60 seconds",
    slices: int | None = None,
) -> StreamingQuery:
    """Append lag columns batch by batch.

    The last readings are written under the number of their batch and read by the next one,
    so a replayed batch sees what it saw before and replaces what it wrote.
    """
    columns = [spec.machine, spec.time, spec.row_id, *spec.sensors]
    schema = df.select(*columns).schema
    depth = max(spec.lags)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        recent = spark.createDataFrame([], schema)
        if batch_id > 0:
            recent = spark.read.schema(schema).parquet(f"{recent_path}/batch_id={batch_id - 1}")
        rows = batch.withColumn("__new", F.lit(True)).unionByName(recent, allowMissingColumns=True)
        lagged = lag_features(rows, spec, slices).filter("__new").drop("__new")
        write_batch(lagged, batch_id, path)
        newest = Window.partitionBy(spec.machine).orderBy(F.desc(spec.time), F.desc(spec.row_id))
        last = rows.select(*columns, F.row_number().over(newest).alias("__back")).filter(F.col("__back") <= depth)
        last.drop("__back").write.mode("overwrite").parquet(f"{recent_path}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()
