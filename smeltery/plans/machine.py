"""Sensor readings: bronze stream, silver stream, rolling gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smeltery.functions.calendar import shift_columns
from smeltery.functions.parsing import to_timestamp_or_null
from smeltery.functions.rules import above_limit_flags, any_of, is_true, outside_range_flag
from smeltery.operators.lookup import add_dimension
from smeltery.operators.quality import first_per_key, keep_required, reject_missing, trim_columns
from smeltery.operators.rolling import RollingSpec, machine_features
from smeltery.sources import commits, readers, schemas, writers
from smeltery.streaming.ingest import bronze_rows, drop_repeats, parse_messages, rejected_messages

# Topic, lineage label, column lists and the limit of each flag.
TOPIC = "iot.sensor.readings"
SOURCE_SYSTEM = "iot_kafka"
REQUIRED = ("reading_id", "machine_id", "temperature", "vibration", "pressure", "timestamp")
TRIMMED = ("machine_id", "machine_type", "location")
MASTER_COLUMNS = (
    "age_years", "criticality", "manufacturer", "temp_critical", "vibration_critical",
    "pressure_critical", "rpm_critical", "voltage_critical",
)
LIMITS = {
    "temp_anomaly": ("temperature", "temp_critical"),
    "vibration_anomaly": ("vibration", "vibration_critical"),
    "pressure_anomaly": ("pressure", "pressure_critical"),
    "rpm_anomaly": ("rpm", "rpm_critical"),
}
VOLTAGE_LIMIT = {"voltage_anomaly": ("voltage", "voltage_critical")}
NORMAL_RANGE = {
    "temperature": ("temp_min", "temp_max"),
    "vibration": ("vibration_min", "vibration_max"),
    "pressure": ("pressure_min", "pressure_max"),
    "rpm": ("rpm_min", "rpm_max"),
    "voltage": ("voltage_min", "voltage_max"),
}
PARTITIONS = ("year", "month")


def read_master(spark: SparkSession, folder: str) -> DataFrame:
    return readers.csv_dimension(spark, f"{folder}/machine_master.csv", schemas.MACHINE_MASTER)


def bronze(messages: DataFrame) -> DataFrame:
    return bronze_rows(parse_messages(messages, schemas.SENSOR_READING), SOURCE_SYSTEM)


def start_bronze(messages: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    return writers.append_stream(bronze(messages), path, checkpoint, ["ingestion_date"], every)


def start_quarantine(messages: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Messages the bronze table cannot take, or whose time cannot be read, with the reason."""
    rejects = rejected_messages(parse_messages(messages, schemas.SENSOR_READING))
    return writers.append_stream(rejects, path, checkpoint, (), every)


def typed(df: DataFrame) -> DataFrame:
    moment = to_timestamp_or_null(F.col("timestamp"))
    return df.withColumns({"timestamp": moment, "reading_date": moment.cast("date")})


def add_flags(df: DataFrame) -> DataFrame:
    """Sensor flags, their disjunction, and the anomaly flag that includes known degradation.

    Voltage has a flag of its own that is no part of the disjunction.
    """
    flagged = df.withColumns({**above_limit_flags(LIMITS), **above_limit_flags(VOLTAGE_LIMIT)})
    beyond = flagged.withColumn("sensor_out_of_range", any_of(F.col(flag) for flag in LIMITS))
    return beyond.withColumn("is_anomaly", is_true(F.col("sensor_out_of_range") | F.col("is_degrading")))


def enrich(df: DataFrame, master: DataFrame, normal_range: bool = False) -> DataFrame:
    """Typed, complete and distinct readings to silver rows; optionally with the range test."""
    known = master.withColumn("__known", F.lit(True))
    bounds = [bound for pair in NORMAL_RANGE.values() for bound in pair] if normal_range else []
    rows = add_dimension(trim_columns(df, TRIMMED), known, "machine_id", [*MASTER_COLUMNS, *bounds, "__known"])
    if normal_range:
        rows = rows.withColumn("outside_normal_range", outside_range_flag(NORMAL_RANGE)).drop(*bounds)
    return add_flags(rows).withColumns(
        {
            "master_missing": F.col("__known").isNull(),
            "silver_processed_at": F.current_timestamp(),
            "year": F.year("reading_date"),
            "month": F.month("reading_date"),
        }
    ).drop("__known")


def silver(bronze_rows: DataFrame, master: DataFrame) -> DataFrame:
    complete = keep_required(typed(bronze_rows), REQUIRED)
    order = [F.col("bronze_ingested_at"), F.col("timestamp"), F.xxhash64(*complete.columns)]
    return enrich(first_per_key(complete, ["reading_id"], order), master)


def start_rejects(
    bronze_stream: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """The bronze rows that silver leaves out, with the names of their missing fields."""
    return writers.append_stream(reject_missing(typed(bronze_stream), REQUIRED), path, checkpoint, (), every)


def start_silver(
    bronze_stream: DataFrame,
    master: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "1 day",
    every: str | None = "60 seconds",
) -> StreamingQuery:
    complete = keep_required(typed(bronze_stream), REQUIRED)
    distinct = drop_repeats(complete, ["reading_id"], delay)
    return writers.transform_stream(
        distinct, lambda batch: enrich(batch, master), path, checkpoint, PARTITIONS, every
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """What the silver stream has committed."""
    return commits.read_table(spark, path)


def compact_silver(spark: SparkSession, path: str) -> int | None:
    """Bring the small files of past batches together, month by month, beside the running stream."""
    return commits.compact(spark, path, PARTITIONS)


def gold(silver_rows: DataFrame, spec: RollingSpec = RollingSpec(), slices: int | None = None) -> DataFrame:
    features = machine_features(silver_rows, spec, slices)
    return features.withColumns(
        {**shift_columns(F.col(spec.time)), "gold_processed_at": F.current_timestamp()}
    )


def write_gold(silver_rows: DataFrame, path: str, slices: int | None = None) -> dict[str, int]:
    return writers.overwrite_table(gold(silver_rows, slices=slices), path, PARTITIONS)
