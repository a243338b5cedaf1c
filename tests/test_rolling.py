import datetime as dt
import statistics

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from smeltery.operators import frames, rolling

START = dt.datetime(2024, 1, 1)
COLUMNS = "machine_id string, timestamp timestamp, reading_id int, x double, is_anomaly boolean, failed boolean"
SPEC = rolling.RollingSpec(
    sensors=("x",),
    lags=(1, 2, 3),
    frames={"5m": (300, ("mean", "std", "min", "max"))},
    counts={"anomaly_count_5m": ("is_anomaly", 300)},
)
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    """Rows of (machine, seconds after the start, value, anomaly, failure)."""
    return spark.createDataFrame(
        [(m, START + dt.timedelta(seconds=s), i, v, a, f) for i, (m, s, v, a, f) in enumerate(rows)], COLUMNS
    )


def model(rows):
    """The same features by a plain search over all rows."""
    out = {}
    for i, (machine, s, value, _, _) in enumerate(rows):
        mine = [(int(t // 1), t, j, v, a, f) for j, (m, t, v, a, f) in enumerate(rows) if m == machine]
        before = sorted(r for r in mine if (r[0], r[1], r[2]) < (int(s // 1), s, i))
        lags = [before[-n][3] if len(before) >= n else None for n in SPEC.lags]
        inside = [r for r in mine if int(s // 1) - 300 <= r[0] <= int(s // 1)]
        values = [r[3] for r in inside if r[3] is not None]
        out[i] = (
            *lags,
            (value - lags[0]) / lags[0] if lags[0] and value is not None else (None if lags[0] else 0.0),
            statistics.mean(values) if values else None,
            statistics.stdev(values) if len(values) > 1 else None,
            min(values, default=None),
            max(values, default=None),
            sum(bool(r[4]) for r in inside),
        )
    return out


NAMES = ["x_lag1", "x_lag2", "x_lag3", "x_roc", "x_mean_5m", "x_std_5m", "x_min_5m", "x_max_5m", "anomaly_count_5m"]


def check(spark, rows, slices):
    expected = model(rows)
    out = rolling.machine_features(frame(spark, rows), SPEC, slices).select("reading_id", *NAMES).collect()
    assert len(out) == len(rows)
    for row in out:
        for name, got, want in zip(NAMES, row[1:], expected[row.reading_id]):
            assert (got is None) == (want is None), (name, row, want)
            if want is not None:
                assert got == pytest.approx(want, rel=1e-9, abs=1e-6), (name, row, want)


reading = st.tuples(
    st.sampled_from("ab"),
    st.one_of(st.integers(0, 1500), st.floats(0, 1500).map(lambda t: round(t, 3))),
    st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e3, 1e3).map(lambda v: round(v, 2))),
    st.booleans(),
    st.booleans(),
)


@SLOW
@given(st.lists(reading, min_size=1, max_size=25), st.sampled_from([60, 301, 1000]))
def test_features_equal_a_plain_search(spark, rows, slices):
    check(spark, rows, slices)


def test_without_given_slices(spark):
    check(spark, [("a", i * 50, float(i % 7), i % 3 == 0, False) for i in range(40)], None)


def test_frame_ends(spark):
    rows = [("a", 0, 1.0, True, False), ("a", 300, 3.0, False, False), ("a", 301, 5.0, False, False)]
    out = {r.reading_id: r for r in rolling.rolling_features(frame(spark, rows), SPEC).collect()}
    assert [out[i].x_mean_5m for i in range(3)] == [1.0, 2.0, 4.0]
    assert [out[i].anomaly_count_5m for i in range(3)] == [1, 1, 0]
    assert out[0].x_std_5m is None


def test_readings_of_one_second_share_a_frame(spark):
    rows = [("a", 10.1, 1.0, False, False), ("a", 10.9, 3.0, False, False)]
    out = rolling.rolling_features(frame(spark, rows), SPEC).collect()
    assert {r.x_mean_5m for r in out} == {2.0}


def test_equal_values_have_no_spread(spark):
    rows = [("a", i, 0.1, False, False) for i in range(50)] + [("a", 2000 + i, 999.7, False, False) for i in range(50)]
    out = rolling.rolling_features(frame(spark, rows), SPEC).filter("x_std_5m IS NOT NULL")
    assert {r.x_std_5m for r in out.select("x_std_5m").collect()} == {0.0}


def test_nan_and_infinity_count_in_their_own_frames_only(spark):
    """As plain window frames have it, with NaN, both infinities and NULL among the readings."""
    odd = {10: float("nan"), 40: float("inf"), 41: float("-inf"), 80: None, 81: float("inf")}
    df = frame(spark, [("m", 60 * i, odd.get(i, float(i % 9)), False, False) for i in range(120)])
    names = [f"x_{stat}_5m" for stat in ("mean", "std", "min", "max")]
    got = {r.reading_id: r[1:] for r in rolling.rolling_features(df, SPEC).select("reading_id", *names).collect()}
    window = Window.partitionBy("machine_id").orderBy(F.unix_timestamp("timestamp")).rangeBetween(-300, 0)
    plain = df.select("reading_id", *[f("x").over(window).alias(n) for f, n in zip((F.avg, F.stddev, F.min, F.max), names)])
    for row in plain.collect():
        for name, a, b in zip(names, got[row.reading_id], row[1:]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-9, nan_ok=True)), (name, row, a)


def test_change_after_zero_is_zero(spark):
    rows = [("a", 0, 0.0, False, False), ("a", 1, 5.0, False, False)]
    out = {r.reading_id: r.x_roc for r in rolling.lag_features(frame(spark, rows), SPEC).collect()}
    assert out == {0: 0.0, 1: 0.0}


def test_history_crosses_empty_slices(spark):
    rows = [("a", i * 5000, float(i), False, False) for i in range(6)]
    out = {r.reading_id: (r.x_lag1, r.x_lag3) for r in rolling.lag_features(frame(spark, rows), SPEC, 60).collect()}
    assert out[5] == (4.0, 2.0) and out[1] == (0.0, None)


def fleet(spark, busy=7200, others=300):
    """One machine with a reading per second, and many with a reading per day."""
    hot = spark.range(busy).selectExpr("'hot' AS machine_id", "timestamp_seconds(id) AS timestamp", "id AS reading_id")
    rest = spark.range(others * 20).selectExpr(
        f"'m' || id % {others} AS machine_id", f"timestamp_seconds(86400 * (id div {others})) AS timestamp", "-1 - id AS reading_id"
    )
    rows = hot.unionByName(rest).unionByName(hot.limit(3).selectExpr("CAST(NULL AS STRING) AS machine_id", "timestamp", "reading_id + 9000 AS reading_id"))
    return rows.selectExpr("*", "CAST(hash(reading_id) % 100 AS DOUBLE) AS x", "false AS is_anomaly")


def test_only_busy_machines_are_cut(spark):
    """Each by its own readings; an empty table has none."""
    rows = fleet(spark)
    assert [tuple(r) for r in rolling.slice_lengths(rows, SPEC, rows=600).collect()] == [("hot", 600)]
    assert rolling.slice_lengths(rows.limit(0), SPEC).count() == 0
    sliced = rolling.cut_slices(rows, SPEC, rolling.slice_lengths(rows, SPEC, rows=600))
    per_slice = {r[0]: (r[1], r[2]) for r in sliced.groupBy("machine_id").agg(F.countDistinct("__slice"), F.count("*")).collect()}
    assert per_slice["hot"] == (12, 7200) and {v for k, v in per_slice.items() if k not in ("hot", None)} == {(1, 20)}
    assert per_slice[None] == (1, 3)
    assert rolling._history_rows(sliced, SPEC).count() == 11 * max(SPEC.lags)


def test_uneven_machines_have_the_lags_of_one_window(spark, monkeypatch):
    monkeypatch.setattr(rolling.slice_lengths, "__defaults__", (600, 60))
    rows = fleet(spark)
    window = Window.partitionBy("machine_id").orderBy("timestamp", "reading_id")
    plain = rows.select("reading_id", *[F.lag("x", n).over(window).alias(f"x_lag{n}") for n in SPEC.lags])
    got = rolling.lag_features(rows, SPEC).select(*plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    full = rolling.machine_features(rows, SPEC)
    frame = Window.partitionBy("machine_id").orderBy(F.unix_timestamp("timestamp")).rangeBetween(-300, 0)
    counted = rows.select("reading_id", F.round(F.avg("x").over(frame), 6).alias("m"), F.max("x").over(frame).alias("h"))
    both = full.select("reading_id", F.round("x_mean_5m", 6).alias("m"), F.col("x_max_5m").alias("h"))
    assert both.exceptAll(counted).count() == 0


@SLOW
@given(st.lists(reading, min_size=1, max_size=20), st.sampled_from([60, 250, None]))
def test_failure_within_equals_a_plain_search(spark, rows, slices):
    out = rolling.failure_within(frame(spark, rows), SPEC, F.col("failed"), 500, "soon", slices).collect()
    want = {
        i: any(m == r[0] and f and int(r[1]) < int(t) <= int(r[1]) + 500 for m, t, _, _, f in rows)
        for i, r in enumerate(rows)
    }
    assert {r.reading_id: r.soon for r in out} == want and len(out) == len(rows)


def test_readings_are_shuffled_once(spark):
    rows = [("a", 0, 1.0, False, False)]
    plan = rolling.machine_features(frame(spark, rows), SPEC, 600)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("Union")[0]
    assert top.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("rows", [1, 50, 10**6])
def test_frames_do_not_depend_on_how_rows_arrive(rows):
    """Batches of any size, groups longer than a batch, blocks of one second and of all."""
    rng = np.random.default_rng(3)
    group = np.sort(rng.integers(0, 5, 400))
    second = np.concatenate([np.sort(rng.choice(3000, (group == g).sum(), False)) for g in range(5)]) - 1000
    value, weight = rng.normal(1e6, 1, 400), rng.integers(0, 3, 400)
    names = {"machine": group, "slice": group // 2, "second": second, "__n_x": weight, "__mean_x": value, "__dev_x": 0.0 * value}
    extreme = np.where(weight == 0, np.nan, value)
    table = pa.table({k: pa.array(v) for k, v in (names | {"__min_x": extreme, "__max_x": extreme}).items()})
    for length in (0, 1, 300, 10**5):
        wanted = {stat: ("x", length, stat) for stat in ("count", "mean", "std", "min", "max")}
        found = []
        for part, number in frames.whole_groups(iter(table.to_batches(max_chunksize=37)), ["machine", "slice"], rows):
            found += zip(*[c.to_pylist() for c in frames.columns_of(part, number, part.column("second").to_numpy(), wanted).values()])
        for i, got in enumerate(found):
            mine = (group == group[i]) & (second <= second[i]) & (second >= second[i] - length)
            values = np.repeat(value[mine], weight[mine])
            want = (len(values), *[f(values) if len(values) else None for f in (np.mean, np.std, np.min, np.max)])
            want = (*want[:2], np.std(values, ddof=1) if len(values) > 1 else None, *want[3:])
            assert list(got) == [x if x is None else pytest.approx(x, rel=1e-9, abs=1e-9) for x in want], (i, length)


def test_a_far_value_leaves_no_trace():
    """Frames after a spike are as exact as if it had never been."""
    n = 400
    value = np.full(n, 0.25)
    value[100] = 1e15
    table = {"n": np.ones(n, np.int64), "mean": value, "dev": np.zeros(n), "min": value, "max": value}
    found = frames.frame_summaries(table, np.zeros(n, np.int64), np.arange(n), 20)
    assert set(frames.statistic(found, "std").to_pylist()[121:]) == {0.0}


def test_a_task_of_frames_holds_few_rows_at_once():
    """Groups of some rows are worked on in blocks of bounded size, however many rows a task reads."""
    keys = np.repeat(np.arange(6_000), 50)
    batches = pa.Table.from_arrays([pa.array(keys)], names=["machine"]).to_batches(max_chunksize=10_000)
    tables = [table for table, _ in frames.whole_groups(iter(batches), ["machine"])]
    assert sum(map(len, tables)) == len(keys) and max(map(len, tables)) <= 60_000
    starts = [table.column(0)[0].as_py() for table in tables]
    assert len(set(starts)) == len(tables) and all(len(table) % 50 == 0 for table in tables)
