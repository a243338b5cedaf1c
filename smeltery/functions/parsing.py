"""Parsing that yields NULL on bad input instead of failing the job (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def to_timestamp_or_null(text: Column) -> Column:
    return F.try_to_timestamp(text)


def to_date_or_null(text: Column) -> Column:
    return F.try_to_timestamp(text).cast("date")


def cast_or_null(value: Column, to: str) -> Column:
    return value.try_cast(to)


def parse_json(text: Column, schema: T.StructType) -> Column:
    """One struct per message; the raw text is kept beside it when it does not fit the schema."""
    with_raw = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, with_raw, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def split_list(text: Column) -> Column:
    """Pipe-separated text to an array of distinct values."""
    return F.array_distinct(F.split(text, r"\|"))
