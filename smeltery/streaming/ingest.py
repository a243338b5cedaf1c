"""Messages to bronze rows, and what is set aside on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.parsing import CORRUPT, parse_json, to_date_or_null, to_timestamp_or_null
from smeltery.operators.quality import quarantine


def parse_messages(messages: DataFrame, schema: T.StructType, broker_time: str | None = None) -> DataFrame:
    """Typed columns of the payload, the raw text if it was malformed, and the broker's time."""
    kept = [F.col("timestamp").alias(broker_time)] if broker_time else []
    payload = parse_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(payload, *kept).select("data.*", *[broker_time] if broker_time else [])


def bronze_rows(parsed: DataFrame, source_system: str, time: str = "timestamp") -> DataFrame:
    """Audit columns and the partition date, which is the date of the event's own time."""
    well_formed = parsed.filter(F.col(CORRUPT).isNull()) if CORRUPT in parsed.columns else parsed
    return well_formed.drop(CORRUPT).withColumns(
        {
            "bronze_ingested_at": F.current_timestamp(),
            "source_system": F.lit(source_system),
            "ingestion_date": to_date_or_null(F.col(time)),
        }
    )


def rejected_messages(parsed: DataFrame, time: str = "timestamp") -> DataFrame:
    """Malformed messages and messages whose event time cannot be read, with the reason."""
    unreadable = F.col(CORRUPT).isNull() & to_timestamp_or_null(F.col(time)).isNull()
    return quarantine(parsed, {"malformed message": F.col(CORRUPT).isNotNull(), "unreadable time": unreadable})


def drop_repeats(df: DataFrame, keys: list[str], delay: str, arrival: str = "bronze_ingested_at") -> DataFrame:
    """First arrival of every key, across micro-batches, in one stateful step.

    The watermark is on the time of arrival: a row may be years old by its own time and is still
    kept, and keys are remembered for the delay after they arrived. A copy that arrives later
    than that is seen as new. Rows are late only when their file is read more than the delay
    after files that arrived later, so the delay must cover the longest stay in the input folder.
    """
    return df.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(keys)
