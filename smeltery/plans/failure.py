"""Failure prediction on machine gold: the training job and the scoring job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from smeltery.operators import learning

LABEL = "will_fail_in_4hrs"


def training_spec(gold: DataFrame, label: str = LABEL, **settings) -> learning.TrainingSpec:
    """Features of a gold table: its numbers and flags without ids, audit columns and label, and its categories."""
    features = learning.drop_columns(gold)
    left_out = {label, *learning.CATEGORIES}
    numbers = [f.name for f in features.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in left_out]
    categories = [name for name in learning.CATEGORIES if name in gold.columns]
    return learning.TrainingSpec(numbers, categories, label=label, **settings)


def train_model(gold: DataFrame, spec: learning.TrainingSpec, model_path: str, runs_path: str) -> dict[str, float]:
    """Train on a written gold table, save the model, add the run to the table of runs, return its metrics."""
    model, metrics = learning.train(gold, spec)
    learning.save_model(model, model_path)
    learning.log_run(gold.sparkSession, runs_path, spec, metrics)
    return metrics


def score_readings(
    readings: DataFrame, spec: learning.TrainingSpec, model_path: str, keep: Sequence[str] = ("reading_id", "machine_id")
) -> DataFrame:
    """Probability, tier and advice of readings, a table or a stream, by a saved model.

    Optional inputs that are missing get their defaults; features the readings lack altogether
    are NULL and filled by the model, unknown categories have a code of their own.
    """
    model = learning.load_model(model_path)
    filled = learning.fill_scoring_defaults(readings)
    absent = {name: "double" for name in spec.numeric} | {name: "string" for name in spec.categorical}
    filled = filled.selectExpr("*", *[f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in absent.items() if name not in filled.columns])
    return learning.score(filled, model, keep)
