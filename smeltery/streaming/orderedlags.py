"""Row lags on a stream whose readings come out of order: the same lags as over the whole table.

A reading waits until the watermark, the newest time seen less ``delay``, has passed it; then no
reading that belongs before it can come any more, and it is lagged with all others that became
ready. A batch of ready readings goes through the sliced batch operator, so a busy machine is
spread over many tasks. What waits, the last readings of every machine and the newest time are
written under the number of the batch and read by the next one: a replayed batch sees what it saw
before and replaces what it wrote. Readings that come later than ``delay`` are set aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smeltery.operators.rolling import RollingSpec, lag_features
from smeltery.sources import commits
from smeltery.sources.schemas import schema_of
from smeltery.sources.writers import with_trigger

NEWEST = schema_of("newest timestamp, last_batch bigint")


def _lagged(ready: DataFrame, recent: DataFrame, spec: RollingSpec, slices: int | None) -> DataFrame:
    rows = ready.withColumn("__new", F.lit(True)).unionByName(recent, allowMissingColumns=True)
    return lag_features(rows, spec, slices).filter("__new").drop("__new")


def _history(spec: RollingSpec) -> list[str]:
    return [spec.machine, spec.time, spec.row_id, *spec.sensors]


def start_ordered_lags(
    df: DataFrame,
    spec: RollingSpec,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    every: str | None = "60 seconds",
    slices: int | None = None,
) -> StreamingQuery:
    """Lag columns of a stream in order of time and row id.

    Readings with a NULL time have no place and are set aside with the late ones.
    """
    depth, wait = max(spec.lags), F.expr(f"INTERVAL {delay}")
    schema, history = df.schema, df.select(*_history(spec)).schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        seen = commits.read_batch(spark, f"{path}/times", batch_id - 1, NEWEST).first()
        known = F.lit(seen and seen["newest"]).cast("timestamp")
        newest = F.lit(batch.agg(F.greatest(F.max(spec.time), known)).first()[0]).cast("timestamp")
        passed = F.coalesce(F.col(spec.time) <= known - wait, F.col(spec.time).isNull())
        waiting = commits.read_batch(spark, f"{path}/waiting", batch_id - 1, schema)
        still = batch.where(~passed).unionByName(waiting)
        is_ready = F.col(spec.time) <= newest - wait
        recent = commits.read_batch(spark, f"{path}/recent", batch_id - 1, history)
        commits.write_batch(_lagged(still.where(is_ready), recent, spec, slices), batch_id, f"{path}/rows")
        commits.write_batch(batch.where(passed), batch_id, f"{path}/late")
        commits.write_batch(still.where(~is_ready), batch_id, f"{path}/waiting")
        back = Window.partitionBy(spec.machine).orderBy(F.desc(spec.time), F.desc(spec.row_id))
        rows = still.where(is_ready).select(*_history(spec)).unionByName(recent)
        last = rows.withColumn("__back", F.row_number().over(back)).where(F.col("__back") <= depth).drop("__back")
        commits.write_batch(last, batch_id, f"{path}/recent")
        time = spark.range(1).select(newest.alias("newest"), F.lit(batch_id).cast("long").alias("last_batch"))
        commits.write_batch(time, batch_id, f"{path}/times")
        batch.unpersist()

    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def read_ordered_lags(
    spark: SparkSession, path: str, spec: RollingSpec, finish: bool = False, slices: int | None = None
) -> DataFrame:
    """The readings that are ready, with their lags; ``finish`` adds those that still wait.

    ``finish`` is for a stream that has ended: a reading still to come may belong before them.
    """
    rows = commits.read_table(spark, f"{path}/rows")
    if not finish:
        return rows
    last = commits.commits(spark, f"{path}/times").agg(F.max("batch")).first()[0]
    plain = rows.drop(*lag_columns(spec))
    waiting = commits.read_batch(spark, f"{path}/waiting", last, plain.schema)
    recent = commits.read_batch(spark, f"{path}/recent", last, rows.select(*_history(spec)).schema)
    return rows.unionByName(_lagged(waiting, recent, spec, slices))


def late_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings that came later than the delay, or without a time."""
    return commits.read_table(spark, f"{path}/late")


def lag_columns(spec: RollingSpec) -> list[str]:
    change = [f"{s}_roc" for s in spec.sensors] if 1 in spec.lags else []
    return [f"{s}_lag{n}" for s in spec.sensors for n in spec.lags] + change
