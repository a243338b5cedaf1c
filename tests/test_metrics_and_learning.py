import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from smeltery.operators import evaluation, learning, quantiles, reports
from smeltery.plans import catalogue


def test_medians(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, rng.random(), 5.0]), float("nan") if i % 9 == 0 else rng.gauss(0, 9), None) for i in range(501)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = quantiles.medians(df, ["a", "b", "c"])
    want_a = statistics.median(r[0] for r in rows if r[0] is not None)
    want_b = statistics.median(r[1] for r in rows if r[1] == r[1])
    assert out == {"a": pytest.approx(want_a), "b": pytest.approx(want_b)}
    filled = quantiles.fill_with_medians(df, ["a", "b", "c"])
    assert filled.filter("a IS NULL OR isnan(b) OR c IS NOT NULL").count() == 0


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [2.0, 2.0, 2.0, 9.0], [1.0, 1.0, 2.0, 2.0]])
def test_small_medians(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert quantiles.medians(df, ["a"])["a"] == statistics.median(values)


def test_class_balance(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,), (False,)], "y boolean")
    assert tuple(evaluation.class_balance(df, "y").first()) == (4, 1, 0.25, 3.0)


def test_class_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0), (2, 0)], "y int, p int")
    out = {r["class"]: (r.precision, r.recall, r.support) for r in evaluation.class_report(df, "y", "p").collect()}
    assert out == {0: (0.25, 1.0, 1), 1: (0.0, 0.0, 2), 2: (0.0, 0.0, 1)}


def test_binary_metrics_count_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, s double")
    out = evaluation.binary_metrics(df, "y", "s").first().asDict()
    assert out == {"roc_auc": 0.875, "f1_score": 0.8, "precision": 0.6667, "recall": 1.0}


def test_area_of_scores_that_differ_by_very_little(spark):
    df = spark.range(1000).selectExpr("CAST(id >= 500 AS INT) AS y", "id * 1e-8 AS s")
    assert evaluation.binary_metrics(df, "y", "s").first().roc_auc == 1.0
    mixed = spark.range(3000).selectExpr("CAST(id % 7 = 0 AS INT) AS y", "(id * 7919 % 1009) * 1e-9 AS s")
    rows = [(r.y, r.s) for r in mixed.collect()]
    good, bad = [s for y, s in rows if y], [s for y, s in rows if not y]
    area = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert evaluation.binary_metrics(mixed, "y", "s", ranges=8).first().roc_auc == round(area, 4)


def test_category_codes_are_alphabetical_and_complete(spark):
    words = ["b", "a", "", "ab", "aa", "aaz", "é", "zz", None, "b"]
    codes = {r.value: r.code for r in learning.category_codes(spark.createDataFrame([(w,) for w in words], "c string"), "c").collect()}
    assert codes == {w: i for i, w in enumerate(sorted({w for w in words if w is not None}, key=str.encode))}


def test_reports(spark):
    rows = [("m1", "Pump", "A", 0.9), ("m2", "Pump", "B", 0.6), ("m3", "Motor", "A", 0.1)]
    df = reports.add_risk(spark.createDataFrame(rows, "machine_id string, machine_type string, location string, p double"), F.col("p"))
    kpis = reports.fleet_kpis(df).first()
    assert (kpis.total_machines, kpis.critical, kpis.high_risk) == (3, 1, 1)
    assert kpis.avg_failure_probability == pytest.approx(1.6 / 3)
    assert reports.fleet_filter(df, "A", "Pump", ["CRITICAL"]).count() == 1
    assert reports.fleet_filter(df).count() == 3
    box = {r.machine_type: (r.minimum, r.median, r.maximum, r.rows) for r in reports.risk_quantiles(df).collect()}
    assert box == {"Pump": (0.6, 0.75, 0.9, 2), "Motor": (0.1, 0.1, 0.1, 1)}


def test_status_and_trend(spark):
    start = dt.datetime(2024, 1, 1, 10)
    rows = [("m1", i, start + dt.timedelta(minutes=m), float(m)) for i, m in enumerate((0, 31, 59, 59, 60))] + [("m2", 9, start, 5.0)]
    df = spark.createDataFrame(rows, "machine_id string, reading_id int, timestamp timestamp, temperature double").withColumns(
        {c: F.lit(None).cast("string") for c in ("machine_type", "location", "vibration", "pressure", "rpm", "failure_probability", "risk_level")}
    )
    status = {r.machine_id: r for r in reports.latest_status(df, "machine_id", "timestamp", "reading_id").collect()}
    assert tuple(status["m1"].asDict()) == reports.STATUS_COLUMNS
    assert (status["m1"].temperature, status["m1"].last_updated) == (60.0, start + dt.timedelta(minutes=60))
    one = reports.sensor_trend(df, "machine_id", "timestamp", ["temperature"], machine_id="m1")
    assert [r.temperature for r in one.orderBy("step_start").collect()] == [31.0, 59.0, 60.0]
    assert reports.sensor_trend(df, "machine_id", "timestamp", ["temperature"]).count() == 4


def test_split_keeps_the_share_of_both_classes(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 20 == 0).cast("int").alias("y"))
    out = learning.mark_training_rows(df, "id", "y")
    shares = {r.y: r.s for r in out.groupBy("y").agg(F.avg(F.col("is_training").cast("int")).alias("s")).collect()}
    assert shares == {0: pytest.approx(0.8, abs=0.01), 1: pytest.approx(0.8, abs=0.02)}
    again = learning.mark_training_rows(df.repartition(3), "id", "y")
    assert out.exceptAll(again).count() == 0 and out.count() == 20_000


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "k string")
    out = [r.k for r in learning.encode_categories(df, ["k"]).collect()]
    assert sorted(out, key=str) == [0, 1, 1, 2, None]


@pytest.fixture(scope="module")
def data(spark):
    rows = spark.range(600).select(
        F.col("id").alias("reading_id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 100).cast("double")).alias("x"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 2 == 0, "p").otherwise("q").alias("kind"),
        (F.col("id") % 100 > 80).alias("will_fail_in_4hrs"),
    )
    return rows


@pytest.fixture(scope="module")
def fitted(data):
    spec = learning.TrainingSpec(("x", "empty"), ("kind",), trees=4, depth=3)
    return spec, *learning.train(data, spec)


def test_training_separates_and_repeats(spark, data, fitted, tmp_path):
    spec, model, metrics = fitted
    assert metrics["roc_auc"] > 0.9
    assert learning.train(data, spec)[1] == metrics
    learning.save_model(model, str(tmp_path / "model"))
    loaded = learning.load_model(str(tmp_path / "model"))
    first, second = (learning.score(data, m, ["reading_id"]) for m in (model, loaded))
    assert first.exceptAll(second).count() == 0
    top = learning.feature_importance(spark, model)
    assert top.first().feature == "x" and top.count() == 2


def test_split_by_a_condition(data):
    spec = learning.TrainingSpec(("x",), trees=2, depth=2)
    _, metrics = learning.train(data, spec, training=F.col("reading_id") < 400)
    assert metrics["roc_auc"] > 0.9


def test_scoring_takes_an_unseen_category_and_missing_values(spark, fitted):
    _, model, _ = fitted
    rows = spark.createDataFrame([(1, 95.0, None, "new"), (2, None, None, None)], "reading_id int, x double, empty double, kind string")
    out = {r.reading_id: r for r in learning.score(rows, model, ["reading_id"]).collect()}
    assert len(out) == 2 and out[1].failure_probability > out[2].failure_probability
    assert out[1].risk_level in ("HIGH", "CRITICAL", "MEDIUM")


def test_run_log_and_defaults(spark, fitted, tmp_path):
    spec, _, metrics = fitted
    for _ in range(2):
        learning.log_run(spark, str(tmp_path / "runs"), spec, metrics)
    logged = spark.read.parquet(str(tmp_path / "runs"))
    assert logged.count() == 2 and logged.first().parameters["trees"] == "4"
    df = spark.createDataFrame([(None,), (3,)], "hour int")
    filled = learning.fill_scoring_defaults(df).collect()
    assert [r.hour for r in filled] == [12, 3] and filled[0].day_of_week == 1 and filled[0].is_anomaly is False


@pytest.mark.parametrize("kind", ["spread", "ties", "two", "one", "tails"])
@pytest.mark.parametrize("few", [1, 50])
def test_ranks_are_exact_however_the_values_lie(spark, monkeypatch, kind, few):
    """Brackets close in on a rank from both sides, through ties and far tails."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "SKETCH", 20)
    rng = random.Random(kind)
    values = {
        "spread": [rng.gauss(0, 1) for _ in range(700)],
        "ties": [float(rng.randint(0, 6)) for _ in range(700)],
        "two": [0.0] * 350 + [1.0] * 350,
        "one": [5.0] * 301,
        "tails": [1e300 * rng.random() ** 40 for _ in range(600)] + [float("inf"), float("-inf")],
    }[kind]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None), (float("nan"), None)], "a double, `b.c` double")
    ranks = [1, 2, len(values) // 2, len(values) - 1, len(values)]
    found = quantiles.ranked_values(df, {"a": ranks, "b.c": [1]})
    assert found == {("a", r): sorted(values)[r - 1] for r in ranks}
    assert quantiles.medians(df, ["a", "b.c"]) == {"a": statistics.median(values)}


def test_a_median_moves_no_values(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).cast("double").alias("x"))
    with_counts = quantiles.medians(df, ["x"])
    assert with_counts == {"x": 24_999.5}


def test_codes_of_values_that_share_their_start(spark):
    """Many values with the same first characters are numbered by several tasks."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = [f"M{i:04d}" for i in range(500)] + ["", "é", "Z"]
        codes = learning.category_codes(spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "c string"), "c")
        found = {r.value: r.code for r in codes.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found == {v: i for i, v in enumerate(sorted(values))}


def test_drop_and_label(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", None)], "reading_id int, kind string, y boolean")
    assert learning.drop_columns(df).columns == ["kind", "y"]
    assert [r.y for r in learning.labelled(df, "y").collect()] == [1.0]
    with pytest.raises(ValueError):
        learning.train(df.withColumn("x", F.lit(1.0)), learning.TrainingSpec(("x",), label="y"))


def test_held_out_rows_are_scored_once(spark, monkeypatch):
    """Metrics read written scores; they do not run the model again."""
    read = []
    for name in ("binary_metrics", "class_report"):
        measure = getattr(learning, name)
        monkeypatch.setattr(learning, name, lambda df, *more, measure=measure: read.append(df) or measure(df, *more))
    rows = [(i, float(i % 7), int(i % 7 > 3)) for i in range(200)]
    spec = learning.TrainingSpec(["x"], (), label="y", row_id="id", trees=2, depth=2)
    learning.train(spark.createDataFrame(rows, "id int, x double, y int"), spec)
    assert len(read) == 2
    for df in read:
        assert df.columns == ["y", "__score", "prediction"]
        assert all("held-out-scores" in file for file in df.inputFiles()) and df.inputFiles()


class Asked(Exception):
    """Ends a query where it would train."""


@pytest.mark.parametrize("name", ["feature_importance_top10", "gbt_train_score", "stream_scoring"])
def test_queries_train_the_whole_model(spark, monkeypatch, tmp_path, name):
    """All trees in their whole depth, on every reading."""

    def asked(df, spec, training=None):
        raise Asked(spec, df.count())

    monkeypatch.setattr(learning, "train", asked)
    events = spark.range(30).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
        (F.col("id") % 3).alias("user_id"),
        F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.format_string('{"k": %d}', "id").alias("props"),
    )
    customers = spark.range(3).selectExpr(
        "id AS c_custkey", "'' AS c_name", "CAST(id AS INT) AS c_nationkey", "0D AS c_acctbal", "'BUILDING' AS c_mktsegment"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    with pytest.raises(Asked) as found:
        catalogue.QUERIES[name](spark, str(tmp_path))
    spec, rows = found.value.args
    assert (spec.trees, spec.depth, rows) == (200, 6, 30)
    assert spec == learning.TrainingSpec(spec.numeric, spec.categorical)
