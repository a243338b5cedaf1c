"""Calendar expressions shared by the monthly and the sensor features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season and of each calendar flag, and the night hours.
SEASON_MONTHS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Monsoon": [6, 7, 8, 9]}
OTHER_SEASON = "Autumn"
MONTH_FLAGS = {
    "is_flu_season": [11, 12, 1, 2],
    "is_monsoon": [6, 7, 8, 9],
    "is_festival_season": [10, 11],
    "is_summer": [4, 5, 6],
}
NIGHT_FROM, NIGHT_TO = 22, 6


def season(month: Column) -> Column:
    """Season name of a month number."""
    name = F.lit(OTHER_SEASON)
    for label, months in SEASON_MONTHS.items():
        name = F.when(month.isin(months), label).otherwise(name)
    return name


def month_columns(year: Column, month: Column) -> dict[str, Column]:
    """Quarter, season and the 0/1 month flags."""
    flags = {name: month.isin(months).cast("int") for name, months in MONTH_FLAGS.items()}
    return {"quarter": F.quarter(F.make_date(year, month, F.lit(1))), "season": season(month), **flags}


def shift_columns(ts: Column) -> dict[str, Column]:
    """Hour, day of week (Sunday is 1) and the night-shift flag.

    The shift spans midnight, so it is a union of two ranges; both ends are inside it.
    """
    hour = F.hour(ts)
    return {
        "hour": hour,
        "day_of_week": F.dayofweek(ts),
        "is_night_shift": ((hour >= NIGHT_FROM) | (hour <= NIGHT_TO)).cast("int"),
    }


def month_index(year: Column, month: Column) -> Column:
    """Consecutive month number, so that a calendar distance is a plain difference."""
    return year * 12 + month


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, the unit of every RANGE frame here."""
    return F.unix_timestamp(ts)
