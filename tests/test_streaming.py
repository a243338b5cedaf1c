import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from smeltery.operators import rolling
from smeltery.session import LOCAL_SESSIONS, ROCKSDB
from smeltery.sources import commits, readers, writers
from smeltery.sources.schemas import schema_of
from smeltery.streaming import horizon, ingest, latewindows, orderedlags, stateful, windows

START = dt.datetime(2024, 1, 1)
SCHEMA = schema_of("machine_id string, timestamp timestamp, reading_id bigint, x double")
SPEC = rolling.RollingSpec(sensors=("x",), lags=(1, 3), frames={}, counts={})


def put(spark, folder, rows):
    """One file of (machine, minutes after the start, id, value)."""
    table = [(m, START + dt.timedelta(minutes=t), i, v) for m, t, i, v in rows]
    spark.createDataFrame(table, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def source(spark, folder):
    return readers.parquet_stream(spark, str(folder / "in"), SCHEMA, max_files_per_trigger=1)


def run(df, folder, name="out"):
    writers.append_stream(df, str(folder / name), str(folder / f"{name}-check"), every=None).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(folder / name))


def test_repeats_are_dropped_across_batches_within_the_delay(spark, tmp_path):
    for rows in ([("a", 0, 1, 1.0), ("a", 1, 1, 9.0)], [("a", 2, 1, 2.0), ("a", 3, 2, 3.0)]):
        put(spark, tmp_path, rows)
        out = run(ingest.drop_repeats(source(spark, tmp_path), ["reading_id"], "1 hour", arrival="timestamp"), tmp_path)
    assert sorted(r.reading_id for r in out.collect()) == [1, 2]


def test_rows_far_behind_by_their_own_time_are_kept(spark, tmp_path):
    year = 366 * 24 * 60
    for rows in ([("a", year, 1, 1.0), ("a", year + 1, 2, 1.0)], [("a", i, 10 + i, 0.0) for i in range(100)] + [("a", year, 1, 1.0)]):
        put(spark, tmp_path, rows)
        arriving = source(spark, tmp_path).withColumn("arrived", F.current_timestamp())
        out = run(ingest.drop_repeats(arriving, ["reading_id"], "1 hour", arrival="arrived"), tmp_path)
    assert sorted(r.reading_id for r in out.collect()) == [1, 2, *range(10, 110)]


def test_late_rows_inside_the_delay_count_and_later_ones_do_not(spark, tmp_path):
    grouped = lambda: windows.tumbling(source(spark, tmp_path), "timestamp", ["machine_id"], ["x"], "5 minutes", "10 minutes")
    for rows in (
        [("a", 0, 1, 1.0), ("a", 20, 2, 2.0)],
        [("a", 12, 3, 4.0), ("a", 1, 4, 100.0)],
        [("a", 60, 5, 0.0)],
    ):
        put(spark, tmp_path, rows)
        out = run(grouped(), tmp_path)
    got = {(r.window_start - START).seconds // 60: (r.readings, r.x_max) for r in out.collect()}
    assert got == {0: (1, 1.0), 10: (1, 4.0), 20: (1, 2.0)}


def test_windows_of_a_table(spark):
    rows = [("a", 0, 1, 1.0), ("a", 4, 2, 3.0), ("a", 50, 3, 5.0)]
    df = spark.createDataFrame([(m, START + dt.timedelta(minutes=t), i, v) for m, t, i, v in rows], SCHEMA)
    parts = ("timestamp", ["machine_id"], ["x"])
    assert sorted(r.readings for r in windows.tumbling(df, *parts).collect()) == [1, 2]
    assert sorted(r.readings for r in windows.sessions(df, *parts).collect()) == [1, 2]
    assert windows.sliding(df, *parts).agg(F.sum("readings")).first()[0] == 3 * 6


def batches():
    return (
        [("a", 0, 1, 1.0), ("a", 1, 2, None), ("b", 1, 3, 7.0)],
        [("a", 3, 5, 4.0), ("a", 2, 4, 3.0)],
        [("b", 4, 6, 8.0), ("a", 5, 7, 5.0)],
    )


def expected(spark, tmp_path):
    return rolling.lag_features(spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")), SPEC)


def test_keyed_state_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for rows in batches():
            put(spark, tmp_path, rows)
            out = run(stateful.stream_lags(source(spark, tmp_path), "machine_id", "timestamp", "reading_id", ["x"], (1, 3)), tmp_path)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    wanted = expected(spark, tmp_path).select(out.columns)
    assert out.count() == 7 and out.exceptAll(wanted).count() == 0


@pytest.mark.parametrize("slices", [None, 60])
def test_lag_batches_equal_batch(spark, tmp_path, slices):
    paths = [str(tmp_path / name) for name in ("rows", "recent", "check")]
    for rows in batches():
        put(spark, tmp_path, rows)
        stateful.start_lag_batches(source(spark, tmp_path), SPEC, *paths, every=None, slices=slices).awaitTermination()
    out = commits.read_table(spark, paths[0])
    wanted = expected(spark, tmp_path)
    assert out.count() == 7 and out.select(wanted.columns).exceptAll(wanted).count() == 0


def test_failures_ahead_of_a_table(spark):
    at = lambda m: START + dt.timedelta(minutes=m)
    df = spark.createDataFrame([("a", at(0), 1, 0.0), ("a", at(240), 2, 1.0), ("a", at(241), 3, 1.0), ("b", at(5), 4, 1.0)], SCHEMA)
    ahead = horizon.failures_ahead(df, df.filter("x = 1"), "machine_id", "timestamp", "reading_id")
    assert sorted(r.reading_id for r in ahead.collect()) == [1, 2]


def late_run(spark, tmp_path, step=None, checkpoint="late-check"):
    latewindows.start_windows(
        source(spark, tmp_path), "timestamp", ["machine_id"], ["x"], str(tmp_path / "late"), str(tmp_path / checkpoint),
        "10 minutes", step, "10 minutes", every=None,
    ).awaitTermination()


LATE = (
    [("a", 0, 1, 1.0), ("a", 25, 2, 2.0), ("b", 1, 3, None)],
    [("a", 1, 4, 50.0), ("a", 21, 5, 4.0), ("b", 4, 6, 7.0), ("b", 16, 7, 8.0)],
    [("a", 90, 8, 0.0)],
    [("a", 26, 9, 9.0), ("c", 80, 10, 3.0), ("c", 200, 11, 3.0)],
)


@pytest.mark.parametrize("step", [None, "5 minutes"])
def test_every_row_is_in_a_window_or_among_the_late(spark, tmp_path, step):
    for rows in LATE:
        put(spark, tmp_path, rows)
        late_run(spark, tmp_path, step)
    width, hop = 10, 5 if step else 10
    expected, late, newest = {}, [], None
    for rows in LATE:
        for m, t, i, v in rows:
            for start in range(t // hop * hop - width + hop, t + 1, hop):
                if newest is not None and start + width <= newest - 10:
                    late.append((i, start))
                else:
                    expected.setdefault((m, start), []).append(v)
        newest = max([newest or 0] + [t for _, t, _, _ in rows])
    minutes = lambda ts: int((ts - START).total_seconds()) // 60
    found = latewindows.read_windows(spark, str(tmp_path / "late"), ["machine_id"], ["x"]).collect()
    assert {(r.machine_id, minutes(r.window_start)): (r.readings, r.x_max) for r in found} == {
        k: (len(v), max((x for x in v if x is not None), default=None)) for k, v in expected.items()
    }
    set_aside = latewindows.late_rows(spark, str(tmp_path / "late")).collect()
    assert sorted((r.reading_id, minutes(r.window_start)) for r in set_aside) == sorted(late) and late
    assert latewindows.late_counts(spark, str(tmp_path / "late")).agg(F.sum("rows")).first()[0] == len(late)
    closed = latewindows.read_windows(spark, str(tmp_path / "late"), ["machine_id"], ["x"], "10 minutes")
    assert closed.count() == sum(start + width <= newest - 10 for _, start in expected)


def test_a_replay_of_all_batches_changes_nothing(spark, tmp_path):
    """A lost checkpoint makes the stream write every batch again."""
    for rows in LATE:
        put(spark, tmp_path, rows)
    found = []
    for name in ("first", "second"):
        late_run(spark, tmp_path, checkpoint=name)
        windows_now = latewindows.read_windows(spark, str(tmp_path / "late"), ["machine_id"], ["x"]).collect()
        found.append((sorted(map(str, windows_now)), latewindows.late_rows(spark, str(tmp_path / "late")).count()))
    assert found[0] == found[1]
    latewindows.compact(spark, str(tmp_path / "late"))
    after = latewindows.read_windows(spark, str(tmp_path / "late"), ["machine_id"], ["x"]).collect()
    assert sorted(map(str, after)) == found[0][0]


def test_sessions_are_merged_before_they_move(spark, tmp_path):
    """One machine has nearly all rows: each input partition sends a row per session."""
    put(spark, tmp_path, [("busy", i / 10, i, float(i)) for i in range(3000)] + [("other", 0, -1, 1.0)])
    put(spark, tmp_path, [("busy", 10_000, 9999, 0.0)])
    assert spark.conf.get(LOCAL_SESSIONS) == "true"
    grouped = windows.sessions(source(spark, tmp_path), "timestamp", ["machine_id"], ["x"], "30 minutes", "1 minute")
    query = grouped.writeStream.format("memory").queryName("sessions").outputMode("append")
    query = query.option("checkpointLocation", str(tmp_path / "sessions")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.readings for r in spark.table("sessions").collect()) == [1, 3000]
    plan = query._jsq.explainInternal(False)
    assert "MergingSessions" in plan.split("Exchange hashpartitioning")[-1]


def ordered(spark, tmp_path, checkpoint="ordered-check", slices=None):
    orderedlags.start_ordered_lags(
        source(spark, tmp_path), SPEC, str(tmp_path / "ordered"), str(tmp_path / checkpoint), "20 minutes", every=None, slices=slices
    ).awaitTermination()


@pytest.mark.parametrize("slices", [None, 120])
def test_lags_of_readings_out_of_order(spark, tmp_path, slices):
    """Readings up to the delay late are put in their place; later ones are set aside."""
    rng = random.Random(7)
    rows = [(rng.choice("aaaab"), t + rng.random(), i, None if i % 9 == 0 else float(i)) for i, t in enumerate(range(90))]
    rows += [("a", rows[3][1], 200, 1.0), ("a", rows[3][1], 199, 2.0)]
    arrival = sorted(rows, key=lambda r: r[1] + rng.uniform(0, 18))
    for start in range(0, len(arrival), 24):
        put(spark, tmp_path, arrival[start : start + 24])
        ordered(spark, tmp_path, slices=slices)
    wanted = expected(spark, tmp_path)
    ready = orderedlags.read_ordered_lags(spark, str(tmp_path / "ordered"), SPEC).select(wanted.columns)
    newest = max(r[1] for r in rows)
    assert ready.count() == sum(r[1] <= newest - 20 for r in rows) and ready.exceptAll(wanted).count() == 0
    whole = orderedlags.read_ordered_lags(spark, str(tmp_path / "ordered"), SPEC, finish=True, slices=slices).select(wanted.columns)
    assert whole.count() == len(rows) and whole.exceptAll(wanted).count() == 0
    assert orderedlags.late_readings(spark, str(tmp_path / "ordered")).count() == 0
    put(spark, tmp_path, [("a", 1, 300, 0.0)])
    ordered(spark, tmp_path, slices=slices)
    assert [r.reading_id for r in orderedlags.late_readings(spark, str(tmp_path / "ordered")).collect()] == [300]


def test_ordered_lags_replayed(spark, tmp_path):
    for minutes in ((0, 30, 5), (31, 12, 60), (45, 90)):
        put(spark, tmp_path, [("a", t, t, float(t)) for t in minutes])
    found = []
    for name in ("one", "two"):
        ordered(spark, tmp_path, checkpoint=name)
        found.append(sorted(map(str, orderedlags.read_ordered_lags(spark, str(tmp_path / "ordered"), SPEC, finish=True).collect())))
    assert found[0] == found[1] and len(found[0]) == 8
