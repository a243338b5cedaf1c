"""Demand forecast on sales gold: the training job and the forecasting job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from smeltery.operators import forecast, learning
from smeltery.operators.forecast import ForecastSpec
from smeltery.session import scratch_dir


def written_rows(gold: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Forecast rows as a table, because trees read them many times."""
    path = scratch_dir(gold.sparkSession, "forecast-rows")
    rows = forecast.forecast_rows(gold, spec)
    rows.write.parquet(path)
    return gold.sparkSession.read.schema(rows.schema).parquet(path)


def evaluate(gold: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Errors per horizon of the model and of the seasonal-naive forecast, by rolling origin."""
    scored = forecast.backtest(written_rows(gold, spec), spec)
    if scored is None:
        raise ValueError("a forecast needs at least one month of gold")
    return forecast.errors(scored)


def train_forecast(gold: DataFrame, spec: ForecastSpec, model_path: str, runs_path: str) -> dict[str, float]:
    """Judge by rolling origin, then train on all of gold, save the models and log the run."""
    rows = written_rows(gold, spec)
    scored = forecast.backtest(rows, spec)
    found = forecast.errors(scored).collect() if scored is not None else []
    metrics = {f"{name}_h{row['horizon']}": float(row[name]) for row in found for name in row.asDict() if name != "horizon"}
    models = forecast.fit(rows, spec)
    forecast.save_models(models, model_path)
    learning.log_run(gold.sparkSession, runs_path, spec, metrics)
    return metrics


def forecast_demand(gold: DataFrame, spec: ForecastSpec, model_path: str) -> DataFrame:
    """Forecasts from the last month of gold, per series and horizon, by saved models."""
    rows = forecast.newest_rows(forecast.forecast_rows(gold, spec), spec)
    models = forecast.load_models(gold.sparkSession, model_path, spec.horizons)
    scored = forecast.with_target_month(forecast.predict(rows, models, spec))
    return scored.select(*spec.series, "year", "month", "horizon", "target_year", "target_month", "forecast", "naive")
