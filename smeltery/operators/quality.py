"""Required fields, trimming, quarantine and deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASON = "reject_reason"


def keep_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column is present; a plain filter, pushed to the scan."""
    return df.na.drop(subset=list(columns))


def reject_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The complement of :func:`keep_required`, with the names of the missing columns."""
    return quarantine(df, {f"missing {name}": F.col(name).isNull() for name in columns})


def quarantine(df: DataFrame, faults: Mapping[str, Column]) -> DataFrame:
    """Rows showing at least one fault, with all their faults joined into one text."""
    found = [F.when(condition, F.lit(name)) for name, condition in faults.items()]
    return df.withColumn(REASON, F.concat_ws("; ", *found)).filter(F.col(REASON) != "")


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.trim(F.col(name)) for name in columns})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, chosen by ``order``; exact when the order leaves no ties.

    Comparing a row number with 1 lets Spark reduce every key to one row per input
    partition before the shuffle, so a key with very many copies sends one row per task.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
