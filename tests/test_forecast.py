import math
import random

import pytest
from pyspark.sql import functions as F

from smeltery.operators import forecast, monthly
from smeltery.plans import forecast as jobs

SERIES = ("drug_id", "region_id")
SPEC = forecast.ForecastSpec(horizons=(1, 3, 12, 14), folds=2)


def sales(seed=1, series=12, months=48):
    """Series of different size with a season, a trend and gaps."""
    rng = random.Random(seed)
    rows = []
    for s in range(series):
        size = 10 ** rng.uniform(1, 4)
        for m in range(months):
            if rng.random() < 0.9 or s % 3:
                wave = 1 + 0.6 * math.sin(2 * math.pi * (m + s) / 12) + 0.01 * m
                rows.append((f"D{s}", "R", 2020 + m // 12, m % 12 + 1, int(size * wave * rng.uniform(0.9, 1.1))))
    return rows


def gold(spark, rows):
    totals = spark.createDataFrame(rows, "drug_id string, region_id string, year int, month int, total_units_sold long")
    return monthly.calendar_history(totals)


def test_targets_and_naive_forecasts(spark):
    rows = sales()
    value = {(d, y * 12 + m): v for d, _, y, m, v in rows}
    found = forecast.with_target_month(forecast.forecast_rows(gold(spark, rows), SPEC)).collect()
    assert len(found) == len(rows) * len(SPEC.horizons)
    for r in found:
        at = r["year"] * 12 + r["month"]
        seasonal = value.get((r["drug_id"], at + r["horizon"] - (24 if r["horizon"] > 12 else 12)))
        assert r["target"] == value.get((r["drug_id"], at + r["horizon"])) and r["seasonal"] == seasonal
        assert r["naive"] == (r["total_units_sold"] if seasonal is None else seasonal)
        assert r["target_year"] * 12 + r["target_month"] == at + r["horizon"] and 1 <= r["target_month"] <= 12


def test_training_never_sees_the_future(spark):
    rows = forecast.forecast_rows(gold(spark, sales()), SPEC)
    last = 2023 * 12 + 12
    assert forecast.origins(rows, SPEC) == [last - 14, last - 15]
    past, now = forecast.origin_rows(rows, last - 14)
    seen = past.agg(F.max(F.col("__month_index") + F.col("horizon"))).first()[0]
    assert seen == last - 14 and {r["__month_index"] for r in now.collect()} == {last - 14}


def test_the_model_beats_the_naive_forecast(spark):
    spec = forecast.ForecastSpec(horizons=(1, 3), trees=5, depth=2, folds=2)
    found = {r["horizon"]: r for r in jobs.evaluate(gold(spark, sales(2, 40, 60)), spec).collect()}
    assert sorted(found) == [1, 3]
    for r in found.values():
        assert 0 < r["forecast_wape"] < r["naive_wape"] and r["forecasts"] > 60


def test_errors_by_hand(spark):
    rows = [(1, 10.0, 8, 12), (1, 20.0, 20, 10), (2, 0.0, 0, 5)]
    scored = spark.createDataFrame(rows, "horizon int, forecast double, target long, naive long")
    found = {r["horizon"]: r.asDict() for r in forecast.errors(scored).collect()}
    assert found[1]["forecast_mae"] == 1.0 and found[1]["naive_mae"] == 7.0
    assert found[1]["forecast_rmse"] == pytest.approx(math.sqrt(2)) and found[1]["naive_wape"] == pytest.approx(0.5)
    assert found[2]["forecast_wape"] is None and found[2]["naive_rmse"] == 5.0


def test_jobs_save_log_and_forecast_the_next_months(spark, tmp_path):
    spec = forecast.ForecastSpec(trees=2, depth=2, folds=1)
    table = gold(spark, sales(3, 6, 30))
    metrics = jobs.train_forecast(table, spec, str(tmp_path / "models"), str(tmp_path / "runs"))
    assert {"forecast_wape_h1", "naive_wape_h3"} <= set(metrics)
    assert spark.read.parquet(str(tmp_path / "runs")).first()["metrics"] == pytest.approx(metrics)
    found = jobs.forecast_demand(table, spec, str(tmp_path / "models")).collect()
    assert {(r["target_year"], r["target_month"], r["horizon"]) for r in found} == {(2022, 7, 1), (2022, 8, 2), (2022, 9, 3)}
    assert all(r["forecast"] >= 0 for r in found)
    again = jobs.forecast_demand(table, spec, str(tmp_path / "models")).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_a_horizon_without_targets_falls_back(spark):
    rows = forecast.forecast_rows(gold(spark, [("D", "R", 2024, 1, 5), ("D", "R", 2024, 2, 7)]), forecast.ForecastSpec(trees=2, depth=1))
    models = forecast.fit(rows, forecast.ForecastSpec(trees=2, depth=1))
    assert models == {}
    assert {r["forecast"] for r in forecast.predict(rows, models).where("horizon = 2").collect()} == {5.0, 7.0}
    empty = gold(spark, [])
    assert forecast.backtest(forecast.forecast_rows(empty)) is None
