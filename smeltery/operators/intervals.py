"""Joins of dates with calendar intervals, written as equi joins on days.

A comparison join with intervals would be a nested loop and would repeat a row for each
interval it lies in. Intervals are turned into days instead: one row per day (and zone and
category) to look up, so every input row stays one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions.parsing import split_list
from smeltery.functions.rules import is_true

# Order of the impact names.
IMPACT_RANK = {"High": 3, "Medium": 2, "Low": 1}


def interval_days(intervals: DataFrame, day: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Every day of every interval, both ends inside; intervals without a valid span have none."""
    valid = intervals.filter(F.col(start) <= F.col(end))
    return valid.withColumn(day, F.explode(F.sequence(start, end, F.expr("interval 1 day"))))


def flag_event_days(
    df: DataFrame,
    date: str,
    intervals: DataFrame,
    flag: str = "is_event_day",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """True where the date lies in any interval; a missing date gives false."""
    days = interval_days(intervals, date, start, end).select(date).distinct().withColumn(flag, F.lit(True))
    joined = df.join(days, date, "left")
    return joined.withColumn(flag, is_true(F.col(flag)))


def match_events(
    df: DataFrame,
    date: str,
    zone: str,
    category: str,
    intervals: DataFrame,
    start: str = "start_date",
    end: str = "end_date",
    zones: str = "affected_zones",
    categories: str = "affected_drug_categories",
    impact: str = "demand_impact",
) -> DataFrame:
    """Events active on the row's date for both its zone and its category.

    Adds ``active_events`` (their number), ``max_impact`` (the strongest) and ``event_match``.
    """
    rank = F.lit(0)
    for name, value in IMPACT_RANK.items():
        rank = F.when(F.col(impact) == name, value).otherwise(rank)
    active = (
        interval_days(intervals, date, start, end)
        .withColumn("__rank", rank)
        .withColumn(zone, F.explode(split_list(F.col(zones))))
        .withColumn(category, F.explode(split_list(F.col(categories))))
        .groupBy(date, zone, category)
        .agg(F.count(F.lit(1)).alias("active_events"), F.max("__rank").alias("__rank"))
    )
    names = F.create_map(*[F.lit(part) for name, value in IMPACT_RANK.items() for part in (value, name)])
    joined = df.join(active, [date, zone, category], "left")
    return joined.withColumns(
        {
            "active_events": F.coalesce("active_events", F.lit(0)).cast("long"),
            "max_impact": F.try_element_at(names, F.col("__rank")),
            "event_match": F.col("active_events").isNotNull(),
        }
    ).drop("__rank")
