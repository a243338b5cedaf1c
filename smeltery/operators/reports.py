"""Fleet reports on scored readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.rules import failure_probability, recommendation, risk_level
from smeltery.operators.quality import first_per_key
from smeltery.operators.quantiles import binned_quantiles

# Columns of the status table.
STATUS_COLUMNS = (
    "machine_id",
    "machine_type",
    "location",
    "temperature",
    "vibration",
    "pressure",
    "rpm",
    "failure_probability",
    "risk_level",
    "last_updated",
)


def add_risk(df: DataFrame, probability: Column) -> DataFrame:
    """Rounded probability, tier of the unrounded one, and the advice for the tier."""
    level = risk_level(probability)
    return df.withColumns(
        {
            "failure_probability": failure_probability(probability),
            "risk_level": level,
            "recommendation": recommendation(level),
        }
    )


def fleet_filter(
    df: DataFrame,
    location: str | None = None,
    machine_type: str | None = None,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """The dashboard's filters; None means all."""
    for name, wanted in (("location", location), ("machine_type", machine_type)):
        if wanted is not None:
            df = df.filter(F.col(name) == wanted)
    return df if levels is None else df.filter(F.col("risk_level").isin(list(levels)))


def fleet_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_machines"),
        F.count_if(F.col("risk_level") == "CRITICAL").alias("critical"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk"),
        F.avg("failure_probability").alias("avg_failure_probability"),
    )


def risk_distribution(df: DataFrame) -> DataFrame:
    """Rows per tier, most frequent first."""
    counted = df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "risk_level")


def risk_quantiles(df: DataFrame, group: str = "machine_type") -> DataFrame:
    """Box-plot values of the rounded probability, which has at most 10,001 levels."""
    return binned_quantiles(
        df,
        group,
        failure_probability(F.col("failure_probability")),
        (0.0, 0.25, 0.5, 0.75, 1.0),
        ("minimum", "lower_quartile", "median", "upper_quartile", "maximum"),
    )


def latest_status(
    df: DataFrame, machine: str, time: str, row_id: str, columns: Sequence[str] = STATUS_COLUMNS
) -> DataFrame:
    """The newest row of every machine, with its time as ``last_updated``."""
    newest = first_per_key(df, [machine], [F.desc(time), F.desc(row_id)])
    return newest.withColumn("last_updated", F.col(time)).select(*columns)


def sensor_trend(
    df: DataFrame,
    machine: str,
    time: str,
    sensors: Sequence[str],
    machine_id=None,
    minutes: int = 30,
    step: str = "1 minute",
) -> DataFrame:
    """Means per step over the last minutes of each machine's readings, or of one machine's."""
    own = df if machine_id is None else df.filter(F.col(machine) == machine_id)
    ends = own.groupBy(machine).agg(F.max(time).alias("__end"))
    recent = own.join(ends, machine).filter(
        F.col(time) > F.col("__end") - F.expr(f"INTERVAL {minutes} MINUTES")
    )
    means = recent.groupBy(machine, F.window(time, step).alias("__step")).agg(
        *[F.avg(s).alias(s) for s in sensors]
    )
    return means.select(machine, F.col("__step.start").alias("step_start"), *sensors)
