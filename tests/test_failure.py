import pytest
from pyspark.sql import functions as F

from smeltery.plans import failure


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "rows")
    spark.range(600).select(
        F.concat(F.lit("r"), "id").alias("reading_id"),
        F.concat(F.lit("m"), F.col("id") % 7).alias("machine_id"),
        F.when(F.col("id") % 2 == 0, "Pump").otherwise("Motor").alias("machine_type"),
        F.current_timestamp().alias("gold_processed_at"),
        (F.col("id") % 100).cast("double").alias("temperature"),
        (F.col("id") % 3).cast("int").alias("a__b"),
        (F.col("id") % 5 == 0).alias("is_anomaly"),
        (F.col("id") % 100 >= 80).alias("will_fail_in_4hrs"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_from_gold_to_scores(spark, gold, tmp_path):
    spec = failure.training_spec(gold, trees=3, depth=3, row_share=1.0, feature_share=1.0)
    assert set(spec.numeric) == {"temperature", "a__b", "is_anomaly"}
    assert list(spec.categorical) == ["machine_id", "machine_type"]
    metrics = failure.train_model(gold, spec, str(tmp_path / "model"), str(tmp_path / "runs"))
    assert metrics["roc_auc"] > 0.99 and metrics["recall_class_1"] > 0.9 and metrics["support_class_0"] > 0
    failure.train_model(gold, spec, str(tmp_path / "model"), str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert len(runs) == 2 and runs[0].parameters["trees"] == "3" and "roc_auc" in runs[0].metrics
    scored = failure.score_readings(gold, spec, str(tmp_path / "model"))
    by_tier = scored.join(gold, "reading_id").groupBy("will_fail_in_4hrs").agg(F.avg("failure_probability").alias("p")).collect()
    chance = {r.will_fail_in_4hrs: r.p for r in by_tier}
    assert scored.count() == 600 and chance[True] > chance[False] + 0.3


def test_missing_inputs_get_defaults(spark, gold, tmp_path):
    spec = failure.training_spec(gold, trees=2, depth=2)
    failure.train_model(gold, spec, str(tmp_path / "model"), str(tmp_path / "runs"))
    bare = spark.createDataFrame([("x", "new machine", 95.0), ("y", None, None)], "reading_id string, machine_id string, temperature double")
    rows = {r.reading_id: r.failure_probability for r in failure.score_readings(bare, spec, str(tmp_path / "model")).collect()}
    assert set(rows) == {"x", "y"} and all(0 <= p <= 1 for p in rows.values())
