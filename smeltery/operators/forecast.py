"""Demand forecast per series: a direct target per horizon, boosted trees on gold lags.

A forecast made in month o for h months ahead is a row of its own: what is known in month o, the
calendar of month o + h, and, where it is known already, the demand of month o + h. One model is
trained per horizon over all series. Series differ in size, so demand and history are taken relative
to the seasonal-naive forecast; what the trees learn is by how much it will be off. A series that
has no value a season before the target has no such yardstick and is forecast by its last value.

Forecasts are judged by rolling origin: for each of the last months a model sees only targets up to
that month and forecasts from it. The yardstick is the seasonal-naive forecast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltery.operators.monthly import MONTH_INDEX, add_month_index

BASE, RATIO = "__base", "__ratio"


@dataclass(frozen=True)
class ForecastSpec:
    """Which gold columns play which part, how far ahead, and the settings of the trees."""

    series: Sequence[str] = ("drug_id", "region_id")
    value: str = "total_units_sold"
    #: Gold columns in units of the value; taken relative to the naive forecast.
    history: Sequence[str] = ("lag_1m", "lag_3m", "lag_6m", "lag_12m", "rolling_avg_3m", "rolling_avg_6m")
    #: Gold columns taken as they are.
    features: Sequence[str] = ("mom_growth_rate",)
    horizons: Sequence[int] = (1, 2, 3)
    season: int = 12
    folds: int = 3
    trees: int = 40
    depth: int = 4
    rate: float = 0.1
    seed: int = 42


def forecast_rows(gold: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """One row per series, month and horizon, with ``horizon, target, seasonal`` and ``naive``.

    ``target`` is the value ``horizon`` months on, NULL where that month has no row. ``seasonal``
    is the value of the same calendar month a season before the target, or the fewest seasons
    before it that are not after the month of the row; ``naive`` is that or, where it is missing,
    the row's own value. All horizons come from one pass over the series.
    """
    window = Window.partitionBy(*spec.series).orderBy(MONTH_INDEX)

    def at(months: int) -> Column:
        return F.max(spec.value).over(window.rangeBetween(months, months))

    ahead = [
        F.struct(
            F.lit(h).alias("horizon"), at(h).alias("target"), at(h - spec.season * -(-h // spec.season)).alias("seasonal")
        )
        for h in spec.horizons
    ]
    indexed = add_month_index(gold.drop("horizon", "target", "seasonal", "naive"))
    rows = indexed.withColumn("__ahead", F.array(*ahead)).select("*", F.inline("__ahead")).drop("__ahead")
    return rows.withColumn("naive", F.coalesce("seasonal", spec.value))


def _inputs(rows: DataFrame, spec: ForecastSpec) -> tuple[DataFrame, list[str]]:
    """Feature columns: relative history, plain features, month of the target; -1 for none."""
    base = F.greatest(F.col("naive").cast("double"), F.lit(1.0))
    parts = {name: F.col(name) / base for name in (spec.value, *spec.history)}
    parts |= {name: F.col(name).cast("double") for name in spec.features}
    parts["target_month"] = ((F.col(MONTH_INDEX) + F.col("horizon")) % 12).cast("double")
    named = {f"__in_{name}": F.coalesce(value, F.lit(-1.0)) for name, value in parts.items()}
    return rows.withColumns({BASE: base, **named}), list(named)


def fit(rows: DataFrame, spec: ForecastSpec = ForecastSpec()) -> dict[int, PipelineModel]:
    """One model per horizon that has rows with a target and a seasonal value. Give it a written table."""
    inputs, names = _inputs(rows.where("target IS NOT NULL AND seasonal IS NOT NULL"), spec)
    ready = inputs.withColumn(RATIO, F.col("target") / F.col(BASE)).select("horizon", RATIO, *names)
    known = {row[0] for row in ready.select("horizon").distinct().collect()}
    models = {}
    for h in spec.horizons:
        if h in known:
            trees = GBTRegressor(
                featuresCol="__features",
                labelCol=RATIO,
                predictionCol="__predicted",
                maxIter=spec.trees,
                maxDepth=spec.depth,
                stepSize=spec.rate,
                seed=spec.seed,
            )
            stages = [VectorAssembler(inputCols=names, outputCol="__features"), trees]
            models[h] = Pipeline(stages=stages).fit(ready.where(F.col("horizon") == h))
    return models


def predict(rows: DataFrame, models: dict[int, PipelineModel], spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """The rows with ``forecast`` in units, never below 0.

    Horizons without a model and rows without a seasonal value get the naive forecast.
    """
    inputs, names = _inputs(rows, spec)
    parts = []
    for h in spec.horizons:
        mine = inputs.where(F.col("horizon") == h)
        if h in models:
            corrected = F.greatest(F.col("__predicted") * F.col(BASE), F.lit(0.0))
            forecast = F.when(F.col("seasonal").isNotNull(), corrected).otherwise(F.col("naive").cast("double"))
            mine = models[h].transform(mine).withColumn("forecast", forecast)
        else:
            mine = mine.withColumn("forecast", F.col("naive").cast("double"))
        parts.append(mine.select(*rows.columns, "forecast"))
    return reduce(DataFrame.unionByName, parts)


def origins(rows: DataFrame, spec: ForecastSpec = ForecastSpec()) -> list[int]:
    """The last months (as month numbers) from which every horizon's target month has begun to be known."""
    last = rows.agg(F.max(MONTH_INDEX)).first()[0]
    return [] if last is None else [last - max(spec.horizons) - back for back in range(spec.folds)]


def origin_rows(rows: DataFrame, origin: int) -> tuple[DataFrame, DataFrame]:
    """What is known in a month, for training, and the rows forecast from it with their targets."""
    target_month = F.col(MONTH_INDEX) + F.col("horizon")
    return rows.where(target_month <= origin), rows.where((F.col(MONTH_INDEX) == origin) & F.col("target").isNotNull())


def backtest(rows: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame | None:
    """Forecasts from the last origins with their targets; None for an empty table."""
    scored = []
    for origin in origins(rows, spec):
        past, now = origin_rows(rows, origin)
        scored.append(predict(now, fit(past, spec), spec))
    return reduce(DataFrame.unionByName, scored) if scored else None


def errors(scored: DataFrame, forecasts: Sequence[str] = ("forecast", "naive")) -> DataFrame:
    """Per horizon: number of forecasts, and of each kind the mean absolute error, the root of the
    mean squared error and the absolute error as a share of the demand."""
    gap = {name: F.col(name) - F.col("target") for name in forecasts}
    measures = []
    for name in forecasts:
        measures += [
            F.avg(F.abs(gap[name])).alias(f"{name}_mae"),
            F.sqrt(F.avg(gap[name] * gap[name])).alias(f"{name}_rmse"),
            F.try_divide(F.sum(F.abs(gap[name])), F.sum("target")).alias(f"{name}_wape"),
        ]
    return scored.groupBy("horizon").agg(F.count(F.lit(1)).alias("forecasts"), *measures)


def newest_rows(rows: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """The rows of the last month of the whole table: what is forecast when nothing further is known."""
    last = rows.select(F.max(MONTH_INDEX)).scalar()
    return rows.where(F.col(MONTH_INDEX) == last)


def with_target_month(rows: DataFrame) -> DataFrame:
    """``target_year`` and ``target_month`` of each row."""
    index = F.col(MONTH_INDEX) + F.col("horizon")
    return rows.withColumns({"target_year": _year(index), "target_month": _month(index)})


def _year(index: Column) -> Column:
    return F.floor((index - 1) / 12).cast("int")


def _month(index: Column) -> Column:
    return (F.pmod(index - 1, F.lit(12)) + 1).cast("int")


def save_models(models: dict[int, PipelineModel], path: str) -> None:
    for horizon, model in models.items():
        model.write().overwrite().save(f"{path}/horizon={horizon}")


def load_models(spark: SparkSession, path: str, horizons: Sequence[int]) -> dict[int, PipelineModel]:
    return {h: PipelineModel.load(f"{path}/horizon={h}") for h in horizons}
