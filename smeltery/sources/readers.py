"""Batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a topic: binary key and value, topic, partition, offset, timestamp.

    Needs the Kafka connector of the same Spark version on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    file_pattern: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream, with a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    return reader.parquet(path)


def json_lines_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Text files with one message per line, shaped like the topic: value and timestamp."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).selectExpr("value", "_metadata.file_modification_time AS timestamp")


def parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with a declared schema no file is opened to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header row, typed by the declared schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
