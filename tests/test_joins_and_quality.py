import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smeltery.operators import intervals, lookup, quality

DAY = dt.date(2024, 1, 1)
SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def test_required_and_rejects_are_complements(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, None, 2), (3, None, None)], "id int, a string, b int")
    assert [r.id for r in quality.keep_required(df, ["a", "b"]).collect()] == [1]
    rejected = {r.id: r.reject_reason for r in quality.reject_missing(df, ["a", "b"]).collect()}
    assert rejected == {2: "missing a", 3: "missing a; missing b"}


def test_trim(spark):
    df = spark.createDataFrame([("  x ", " y")], "a string, b string")
    assert tuple(quality.trim_columns(df, ["a"]).first()) == ("x", " y")


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7)], "k int, v int")
    first = quality.first_per_key(df, ["k"], [F.desc("v")])
    assert sorted(map(tuple, first.collect())) == [(1, 499), (2, 7)]
    assert sorted(map(tuple, quality.first_per_key(first, ["k"], [F.desc("v")]).collect())) == [(1, 499), (2, 7)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_dimension_value_wins_and_unknown_keys_keep_theirs(spark):
    facts = spark.createDataFrame([(1, True), (2, True), (3, False)], "k int, cold boolean")
    dims = spark.createDataFrame([(1, False, "x"), (2, None, "y")], "k int, cold boolean, name string")
    out = {r.k: (r.cold, r.name) for r in lookup.add_dimension(facts, dims, "k", ["cold", "name"]).collect()}
    assert out == {1: (False, "x"), 2: (True, "y"), 3: (False, None)}


def test_building_a_plan_starts_no_job(spark):
    facts, dims = spark.range(10).withColumnRenamed("id", "k"), spark.range(10).selectExpr("id AS k", "id AS v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    joined = lookup.add_dimension(facts, dims, "k", ["v"])
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("running", "running")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString() and joined.count() == 10


def test_orphans(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    dims = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in lookup.orphan_keys(facts, dims, "k").collect()] == [(1, 2)]


def events(spark, rows):
    return spark.createDataFrame(
        rows, "start_date date, end_date date, demand_impact string, affected_zones string, affected_drug_categories string"
    )


def test_event_days_keep_one_row_each(spark):
    at = lambda n: DAY + dt.timedelta(days=n)
    dims = events(spark, [(at(0), at(2), "High", "N", "A"), (at(2), at(4), "Low", "N", "A"), (at(9), at(8), "Low", "N", "A")])
    df = spark.createDataFrame([(at(n),) for n in (-1, 0, 2, 4, 5, 8, 9)] + [(None,)], "d date")
    flagged = {r.d: r.is_event_day for r in intervals.flag_event_days(df, "d", dims).collect()}
    assert flagged == {at(-1): False, at(0): True, at(2): True, at(4): True, at(5): False, at(8): False, at(9): False, None: False}
    plan = intervals.flag_event_days(df, "d", dims)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_event_match_needs_zone_category_and_date(spark):
    dims = events(spark, [(DAY, DAY, "Low", "N|S", "A"), (DAY, DAY, "High", "N", "A|B")])
    df = spark.createDataFrame([(DAY, "N", "A"), (DAY, "S", "A"), (DAY, "S", "B"), (DAY, "E", "A")], "d date, z string, c string")
    out = {(r.z, r.c): (r.active_events, r.max_impact, r.event_match) for r in intervals.match_events(df, "d", "z", "c", dims).collect()}
    assert out == {("N", "A"): (2, "High", True), ("S", "A"): (1, "Low", True), ("S", "B"): (0, None, False), ("E", "A"): (0, None, False)}


@SLOW
@given(
    st.lists(st.tuples(st.integers(0, 20), st.integers(0, 6)), max_size=6),
    st.lists(st.integers(-3, 30), min_size=1, max_size=20),
)
def test_event_days_equal_a_plain_search(spark, spans, days):
    at = lambda n: DAY + dt.timedelta(days=n)
    dims = events(spark, [(at(a), at(a + n), "High", "N", "A") for a, n in spans])
    df = spark.createDataFrame([(i, at(n)) for i, n in enumerate(days)], "i int, d date")
    out = {r.i: r.is_event_day for r in intervals.flag_event_days(df, "d", dims).collect()}
    assert out == {i: any(a <= n <= a + k for a, k in spans) for i, n in enumerate(days)}
