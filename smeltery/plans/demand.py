"""Sales transactions: bronze stream, silver stream, monthly gold table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smeltery.functions.parsing import cast_or_null, to_timestamp_or_null
from smeltery.functions.rules import high_return
from smeltery.operators.intervals import flag_event_days
from smeltery.operators.lookup import add_dimension
from smeltery.operators.monthly import MonthlySpec, monthly_features
from smeltery.operators.quality import first_per_key, keep_required, reject_missing, trim_columns
from smeltery.sources import commits, readers, schemas, writers
from smeltery.streaming.ingest import bronze_rows, drop_repeats, parse_messages, rejected_messages

# Topic, lineage label and column lists.
TOPIC = "pharma.sales.transactions"
SOURCE_SYSTEM = "kafka"
REQUIRED = ("transaction_id", "drug_id", "region_id", "quantity_sold", "transaction_ts")
TRIMMED = ("drug_name", "region_name", "zone", "tier", "channel", "manufacturer")
DRUG_COLUMNS = ("shelf_life_months", "cold_chain_required", "is_generic")
REGION_COLUMNS = ("population_proxy", "num_hospitals", "num_clinics")
PARTITIONS = ("year", "month")
ATTRIBUTES = (
    "drug_name", "drug_category", "drug_type", "region_name", "zone", "tier", "manufacturer",
    "cold_chain_required", "is_generic", "population_proxy", "num_hospitals", "num_clinics",
)


@dataclass(frozen=True)
class Dimensions:
    drugs: DataFrame
    regions: DataFrame
    events: DataFrame


def read_dimensions(spark: SparkSession, folder: str) -> Dimensions:
    return Dimensions(
        readers.csv_dimension(spark, f"{folder}/drug_master.csv", schemas.DRUG_MASTER),
        readers.csv_dimension(spark, f"{folder}/region_master.csv", schemas.REGION_MASTER),
        readers.csv_dimension(spark, f"{folder}/seasonal_events.csv", schemas.SEASONAL_EVENTS),
    )


def bronze(messages: DataFrame) -> DataFrame:
    parsed = parse_messages(messages, schemas.SALES_TRANSACTION, broker_time="kafka_timestamp")
    return bronze_rows(parsed, SOURCE_SYSTEM)


def start_bronze(messages: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    return writers.append_stream(bronze(messages), path, checkpoint, ["ingestion_date"], every)


def start_quarantine(messages: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Messages the bronze table cannot take, or whose time cannot be read, with the reason."""
    rejects = rejected_messages(parse_messages(messages, schemas.SALES_TRANSACTION))
    return writers.append_stream(rejects, path, checkpoint, (), every)


def typed(df: DataFrame) -> DataFrame:
    """Event time and date, and numbers in their final types; money in exact cents."""
    moment = to_timestamp_or_null(F.col("timestamp"))
    return df.withColumns(
        {
            "transaction_ts": moment,
            "transaction_date": moment.cast("date"),
            "quantity_sold": cast_or_null(F.col("quantity_sold"), "int"),
            "unit_price": cast_or_null(F.col("unit_price"), "double"),
            "returns": cast_or_null(F.col("returns"), "int"),
            "revenue": cast_or_null(F.col("revenue"), "decimal(18,2)"),
        }
    )


def enrich(df: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Typed, complete and distinct rows to silver rows; one row in, one row out."""
    rows = trim_columns(df, TRIMMED)
    rows = add_dimension(rows, dimensions.drugs, "drug_id", DRUG_COLUMNS)
    rows = add_dimension(rows, dimensions.regions, "region_id", REGION_COLUMNS)
    rows = flag_event_days(rows, "transaction_date", dimensions.events)
    return rows.withColumns(
        {
            "high_return_flag": high_return(F.col("returns"), F.col("quantity_sold")),
            "silver_processed_at": F.current_timestamp(),
            "year": F.year("transaction_date"),
            "month": F.month("transaction_date"),
        }
    )


def silver(bronze_rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """The silver table of a bronze table: of several copies the first to arrive is kept."""
    complete = keep_required(typed(bronze_rows), REQUIRED)
    order = [F.col("bronze_ingested_at"), F.col("transaction_ts"), F.xxhash64(*complete.columns)]
    return enrich(first_per_key(complete, ["transaction_id"], order), dimensions)


def start_rejects(
    bronze_stream: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """The bronze rows that silver leaves out, with the names of their missing fields."""
    return writers.append_stream(reject_missing(typed(bronze_stream), REQUIRED), path, checkpoint, (), every)


def start_silver(
    bronze_stream: DataFrame,
    dimensions: Dimensions,
    path: str,
    checkpoint: str,
    delay: str = "1 day",
    every: str | None = "60 seconds",
) -> StreamingQuery:
    complete = keep_required(typed(bronze_stream), REQUIRED)
    distinct = drop_repeats(complete, ["transaction_id"], delay)
    return writers.transform_stream(
        distinct, lambda batch: enrich(batch, dimensions), path, checkpoint, PARTITIONS, every
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """What the silver stream has committed."""
    return commits.read_table(spark, path)


def compact_silver(spark: SparkSession, path: str) -> int | None:
    """Bring the small files of past batches together, month by month, beside the running stream."""
    return commits.compact(spark, path, PARTITIONS)


def gold(silver_rows: DataFrame, calendar_lags: bool = False) -> DataFrame:
    features = monthly_features(silver_rows, MonthlySpec(attributes=ATTRIBUTES), calendar_lags)
    return features.withColumn("gold_processed_at", F.current_timestamp())


def write_gold(silver_rows: DataFrame, path: str, calendar_lags: bool = False) -> dict[str, int]:
    return writers.overwrite_table(gold(silver_rows, calendar_lags), path, PARTITIONS)


def refresh_gold(silver_rows: DataFrame, path: str, first_month: str, last_month: str) -> dict[str, int]:
    """Recompute the months a change in ``first_month``..``last_month`` (yyyy-MM) reaches.

    A month feeds the lags of the twelve months after it, and its own need the twelve before
    it. Filters are on the partition columns, so other months are not read or written; a month
    of the range that has no sales any more is removed. Uses
    calendar lags: row lags may reach any distance back.
    """
    index = F.col("year") * 12 + F.col("month")
    first, last = (int(m[:4]) * 12 + int(m[5:7]) for m in (first_month, last_month))
    reach = max(MonthlySpec().lags)
    source = silver_rows.filter(index.between(first - reach, last + reach))
    changed = gold(source, calendar_lags=True).filter(index.between(first, last + reach))
    return writers.overwrite_partitions(changed, path, PARTITIONS, index.between(first, last + reach))
