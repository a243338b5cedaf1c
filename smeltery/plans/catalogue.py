"""The operators applied to the star-schema and event tables, one named query each.

Sales are line items with their order, customer, part and supplier; readings are events,
with the customer table as machine master. Doubles that depend on the order of addition
are rounded to six digits.
"""

from __future__ import annotations

import dataclasses
import datetime
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions import calendar, parsing, rules
from smeltery.operators import forecast as forecasting
from smeltery.operators import (
    boosting, evaluation, intervals, learning, lookup, monthly, quality, quantiles, reports, rolling,
)
from smeltery.session import LOCAL_SESSIONS, ROCKSDB, scratch_dir, setting
from smeltery.plans import failure, forecast
from smeltery.sources import commits, readers, schemas, writers
from smeltery.streaming import horizon, ingest, latewindows, orderedlags, stateful, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Calendar intervals for the star schema: id, impact, zones, categories, first and last day.
EVENTS_DIM = [
    ("E01", "High", "AFRICA|ASIA", "ECONOMY|PROMO", "1995-03-01", "1995-03-12"),
    ("E02", "Low", "ASIA", "PROMO", "1995-03-08", "1995-03-20"),
    ("E03", "Medium", "EUROPE|AMERICA", "SMALL|LARGE", "1996-06-15", "1996-06-29"),
    ("E04", "High", "MIDDLE EAST", "STANDARD", "1997-01-01", "1997-01-10"),
    ("E05", "Medium", "AFRICA|AMERICA|ASIA", "MEDIUM|SMALL", "1997-10-20", "1997-11-03"),
    ("E06", "Low", "AFRICA|EUROPE", "MEDIUM", "1997-11-01", "1997-11-09"),
    ("E07", "High", "AMERICA", "LARGE|ECONOMY", "1998-12-20", "1999-01-02"),
    ("E08", "Low", "EUROPE", "ECONOMY|STANDARD", "1999-04-05", "1999-04-05"),
    ("E09", "Medium", "ASIA|MIDDLE EAST", "PROMO|LARGE", "2000-08-10", "2000-08-24"),
    ("E10", "High", "AFRICA|AMERICA|ASIA|EUROPE|MIDDLE EAST", "SMALL", "2000-08-20", "2000-09-01"),
]
EVENT_COLUMNS = ["event_id", "demand_impact", "affected_zones", "affected_drug_categories", "start_date", "end_date"]

# Limits by machine type: type, first sensor, second sensor.
LIMITS = [
    ("AUTOMOBILE", 90.0, 70.0),
    ("BUILDING", 130.0, 75.0),
    ("FURNITURE", 170.0, 80.0),
    ("HOUSEHOLD", 210.0, 85.0),
    ("MACHINERY", 250.0, 90.0),
]

TABLES = {
    name: schemas.schema_of(columns)
    for name, columns in {
        "region": "r_regionkey int, r_name string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
            p_retailprice double""",
        "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
            o_orderdate timestamp_ntz, o_orderpriority string""",
        "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
            l_quantity double, l_extendedprice double, l_discount double, l_tax double,
            l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
        "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
            props string""",
        "labels": "doc_id bigint, quality int, toxic int",
    }.items()
}
SENSORS = ("temperature", "vibration")
HOURS = {"6h": 6 * 3600, "24h": 24 * 3600, "72h": 72 * 3600}
CHANNELS = {"building_qty": "BUILDING", "machinery_qty": "MACHINERY", "household_qty": "HOUSEHOLD"}
DELAY = "10 minutes"


def query(function: Query) -> Query:
    """Register a query under its own name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.parquet_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def rounded(df: DataFrame, names) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), 6) for name in names})


def events_dim(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"({', '.join(map(repr, row))})" for row in EVENTS_DIM)
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(EVENT_COLUMNS)})")
    return rows.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Line items with what they refer to, money in cents.

    Base tables are joined one by one, so Spark knows the size of each it may broadcast.
    """
    lines = table(spark, d, "lineitem")
    return (
        lines.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("line"),
            F.col("p_brand").alias("drug_id"),
            F.col("p_type").alias("drug_category"),
            F.col("n_name").alias("region_id"),
            F.col("r_name").alias("zone"),
            F.col("c_mktsegment").alias("channel"),
            F.to_date("l_shipdate").alias("transaction_date"),
            F.col("l_quantity").cast("int").alias("quantity_sold"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("unit_price"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("revenue"),
            F.round(F.col("l_discount") * 100).cast("int").alias("returns"),
        )
    )


def as_readings(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("machine_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("vibration"),
        "event_type",
        *more,
    )


def readings(spark: SparkSession, d: str) -> DataFrame:
    return as_readings(table(spark, d, "events"))


def reading_stream(spark: SparkSession, d: str) -> DataFrame:
    return as_readings(event_stream(spark, d))


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    return readers.parquet_stream(spark, d, TABLES["events"], file_pattern="events.parquet")


def machine_master(spark: SparkSession, d: str) -> DataFrame:
    first, second = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, a, b in LIMITS:
        first = F.when(F.col("c_mktsegment") == name, a).otherwise(first)
        second = F.when(F.col("c_mktsegment") == name, b).otherwise(second)
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("machine_id"),
        F.col("c_mktsegment").alias("machine_type"),
        F.col("c_nationkey").alias("location"),
        first.alias("temp_critical"),
        second.alias("vibration_critical"),
    )


def with_probability(df: DataFrame) -> DataFrame:
    return reports.add_risk(df, F.col("temperature") / 500.0)


def monthly_spec(**changes) -> monthly.MonthlySpec:
    return monthly.MonthlySpec(**{"channels": CHANNELS, "attributes": ("zone",), **changes})


def sensor_spec(frames, counts=None, lags=(1, 5, 10)) -> rolling.RollingSpec:
    return rolling.RollingSpec(sensors=SENSORS, frames=frames, counts=counts or {}, lags=lags)


MINUTE_FRAMES = rolling.RollingSpec().frames
HOUR_FRAMES = {
    "6h": (HOURS["6h"], ("mean", "std", "min", "max")),
    "24h": (HOURS["24h"], ("mean", "std")),
    "72h": (HOURS["72h"], ("mean", "std")),
}


def frame_columns(frames) -> list[str]:
    return [f"{s}_{stat}_{suffix}" for suffix, (_, stats) in frames.items() for s in SENSORS for stat in stats]


# ---- sales --------------------------------------------------------------------------------


@query
def monthly_demand_features(spark, d):
    flagged = intervals.flag_event_days(sales(spark, d), "transaction_date", events_dim(spark))
    features = monthly.monthly_features(flagged, monthly_spec())
    money = features.withColumns({c: F.col(c) / 100 for c in ("total_revenue", "avg_unit_price")})
    return rounded(money, ["avg_unit_price", "rolling_avg_3m", "rolling_avg_6m"])


@query
def monthly_calendar_lag(spark, d):
    flagged = sales(spark, d).withColumn("is_event_day", F.lit(False))
    totals = monthly.monthly_totals(flagged, monthly_spec(attributes=()))
    kept = totals.select("drug_id", "region_id", "year", "month", "total_units_sold")
    return rounded(monthly.calendar_history(kept), ["rolling_avg_3m", "rolling_avg_6m"])


FORECAST = forecasting.ForecastSpec(trees=5, depth=3)


def month_gold(spark, d) -> DataFrame:
    flagged = sales(spark, d).withColumn("is_event_day", F.lit(False))
    totals = monthly.monthly_totals(flagged, monthly_spec(attributes=()))
    return monthly.calendar_history(totals.select("drug_id", "region_id", "year", "month", "total_units_sold"))


@query
def forecast_targets(spark, d):
    """What each month would be judged by, one to three months ahead, and the naive forecasts."""
    rows = forecasting.with_target_month(forecasting.forecast_rows(month_gold(spark, d), FORECAST))
    return rows.select(
        "drug_id", "region_id", "year", "month", "horizon", "target_year", "target_month", "target", "seasonal", "naive"
    )


@query
def forecast_naive_errors(spark, d):
    """Errors of the seasonal-naive forecast from the last three origins."""
    rows = forecasting.forecast_rows(month_gold(spark, d), FORECAST)
    held_out = [forecasting.origin_rows(rows, origin)[1] for origin in forecasting.origins(rows, FORECAST)]
    found = forecasting.errors(functools.reduce(DataFrame.unionByName, held_out), ["naive"])
    return rounded(found, ["naive_mae", "naive_rmse", "naive_wape"])


@query
def forecast_backtest(spark, d):
    """Errors of the model and of the naive forecast, by rolling origin."""
    spec = dataclasses.replace(FORECAST, folds=1)
    return forecast.evaluate(month_gold(spark, d), spec)


@query
def demand_forecast(spark, d):
    """Models trained and saved by the training job, applied to the last month of gold."""
    folder = scratch_dir(spark, "forecast")
    month_gold(spark, d).write.parquet(f"{folder}/gold")
    gold = spark.read.parquet(f"{folder}/gold")
    forecast.train_forecast(gold, dataclasses.replace(FORECAST, folds=1), f"{folder}/models", f"{folder}/runs")
    return forecast.forecast_demand(gold, FORECAST, f"{folder}/models")


@query
def channel_breakdown(spark, d):
    spec = monthly_spec()
    sums = [F.sum(value).alias(name) for name, value in monthly.channel_quantities(spec).items()]
    return sales(spark, d).groupBy("drug_id").agg(F.sum("quantity_sold").alias("total_units_sold"), *sums)


@query
def event_day_flag(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    flagged = intervals.flag_event_days(orders, "order_date", events_dim(spark))
    return flagged.select("o_orderkey", F.col("order_date").cast("string").alias("order_date"), "is_event_day")


@query
def event_match(spark, d):
    lines = sales(spark, d).select("transaction_id", "line", "transaction_date", "zone", "drug_category")
    matched = intervals.match_events(lines, "transaction_date", "zone", "drug_category", events_dim(spark))
    return matched.withColumn("transaction_date", F.col("transaction_date").cast("string"))


@query
def high_return_flag(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity_sold"),
        F.round(F.col("l_discount") * 100).cast("int").alias("returns"),
    )
    return lines.withColumn("high_return_flag", rules.high_return(F.col("returns"), F.col("quantity_sold")))


@query
def net_revenue_check(spark, d):
    quantity, price = F.col("l_quantity").cast("int"), F.col("l_extendedprice").cast("decimal(18,2)")
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        quantity.alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("int").alias("returns"),
        price.alias("unit_price"),
        (quantity * price).cast("decimal(18,2)").alias("revenue"),
    )
    measures = (F.col("quantity"), F.col("returns"), F.col("unit_price"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("revenue").cast("double").alias("revenue"),
        rules.net_revenue(*measures).cast("double").alias("net_revenue"),
        rules.revenue_mismatch(F.col("revenue"), *measures).alias("revenue_mismatch"),
    )


@query
def dedup_line_items(spark, d):
    lines = table(spark, d, "lineitem")
    plain = lines.withColumns({c: F.col(c) + 0.0 for c in ("l_discount", "l_tax")})
    others = [F.col(c) for c in plain.columns if c not in ("l_orderkey", "l_linenumber")]
    first = quality.first_per_key(plain, ["l_orderkey", "l_linenumber"], others)
    return first.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


@query
def orphan_keys(spark, d):
    known = table(spark, d, "part").filter(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"))
    return lookup.orphan_keys(table(spark, d, "lineitem"), known, "l_partkey")


@query
def required_fields_and_trim(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"),
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
    )
    padded = orders.withColumn("o_orderpriority", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))
    required = ["o_orderpriority", "o_orderstatus"]
    kept = quality.trim_columns(quality.keep_required(padded, required), required)
    rejected = quality.reject_missing(padded, required)
    both = kept.unionByName(quality.trim_columns(rejected, required), allowMissingColumns=True)
    return both.withColumn("reject_reason", F.coalesce("reject_reason", F.lit("")))


@query
def machine_age(spark, d):
    """Age in years at shipping, of an item installed on its order date."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    age = rules.machine_age_years(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return lines.select("l_orderkey", "l_linenumber", age.alias("age_years"))


@query
def gold_write_and_read(spark, d):
    """Monthly totals written as a table partitioned by year and month, and read back."""
    flagged = sales(spark, d).withColumn("is_event_day", F.lit(False))
    totals = monthly.monthly_totals(flagged, monthly_spec(attributes=()))
    kept = totals.select("drug_id", "region_id", "year", "month", "total_units_sold", "num_transactions")
    path = scratch_dir(spark, "gold")
    writers.overwrite_table(kept, path, ["year", "month"])
    return readers.parquet_table(spark, path)


def order_batches(spark, d) -> tuple[DataFrame, list[DataFrame]]:
    """Orders with texts that a folder name cannot hold, in three batches."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", F.lit(None)).when(priority == "2-HIGH", "").when(priority == "3-MEDIUM", "b:c")
        .when(priority == "5-LOW", "d/e=%f {g}").otherwise(priority).alias("region"),
        F.when(status != "P", F.year("o_orderdate")).alias("year"),
    )
    return orders, [orders.where(F.col("o_orderkey") % 3 == i) for i in range(3)]


@query
def batch_replay(spark, d):
    """Batches partitioned by any text, one of them first written with other rows and partitions."""
    orders, batches = order_batches(spark, d)
    path = f"{scratch_dir(spark, 'replay')}/orders"
    commits.write_batch(batches[0], 0, path, ["region", "year"])
    commits.write_batch(orders.withColumn("region", F.lit("gone:")), 1, path, ["region", "year"])
    commits.write_batch(batches[1], 1, path, ["region", "year"])
    for _ in range(2):
        commits.write_batch(batches[2], 2, path, ["region", "year"])
    return commits.read_table(spark, path)


@query
def batch_compaction(spark, d):
    """Batches compacted, a late replay of one of them, and a batch after that."""
    _, batches = order_batches(spark, d)
    path = f"{scratch_dir(spark, 'compaction')}/orders"
    for number in (0, 1):
        commits.write_batch(batches[number], number, path, ["year"])
    commits.compact(spark, path, ["year"])
    for number in (0, 1, 2):
        commits.write_batch(batches[number], number, path, ["year"])
    commits.compact(spark, path, ["year"])
    return commits.read_table(spark, path)


# ---- messages -----------------------------------------------------------------------------


@query
def json_round_trip(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    messages = writers.keyed_messages(events, "event_id").withColumn("timestamp", F.current_timestamp())
    parsed = ingest.parse_messages(messages, events.schema)
    return parsed.filter(F.col(parsing.CORRUPT).isNull()).drop(parsing.CORRUPT)


@query
def safe_parse_quarantine(spark, d):
    """Errors carry cut-off JSON, sign-ups an unreadable time, and views text for a number."""
    kind = F.col("event_type")
    payload = F.to_json(
        F.struct(
            "event_id",
            F.when(kind == "signup", "no time").otherwise(F.col("ts").cast("string")).alias("timestamp"),
            F.when(kind == "view", "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        )
    )
    value = F.when(kind == "error", F.expr("left(payload, 20)")).otherwise(F.col("payload"))
    events = table(spark, d, "events").withColumn("payload", payload)
    schema = schemas.schema_of("event_id bigint, timestamp string, user_id string")
    parsed = ingest.parse_messages(events.select(value.alias("value"), F.current_timestamp().alias("timestamp")), schema)
    number = parsing.cast_or_null(F.col("user_id"), "bigint")
    unread = F.col(parsing.CORRUPT).isNull()
    faults = {
        "malformed message": ~unread,
        "unreadable time": unread & parsing.to_timestamp_or_null(F.col("timestamp")).isNull(),
        "unreadable number": unread & number.isNull(),
    }
    rejected = quality.quarantine(parsed, faults)
    return rejected.groupBy(quality.REASON).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.col(parsing.CORRUPT)).alias("raw_kept")
    )


# ---- sensors ------------------------------------------------------------------------------


@query
def dimension_enrichment(spark, d):
    enriched = lookup.add_dimension(
        readings(spark, d), machine_master(spark, d), "machine_id", ["machine_type", "location", "temp_critical"]
    )
    return enriched.select("reading_id", "machine_id", "machine_type", "location", "temp_critical")


def flagged_readings(df: DataFrame, master: DataFrame) -> DataFrame:
    """Limits, one flag per sensor, their disjunction, and the anomaly flag."""
    limits = {
        "temp_anomaly": ("temperature", "temp_critical"),
        "vibration_anomaly": ("vibration", "vibration_critical"),
    }
    known = master.filter(F.col("machine_type") != "BUILDING")
    joined = lookup.add_dimension(df, known, "machine_id", ["machine_type", "temp_critical", "vibration_critical"])
    flagged = joined.withColumns(rules.above_limit_flags(limits)).withColumn(
        "sensor_out_of_range", rules.any_of(F.col(flag) for flag in limits)
    )
    degrading = F.expr("nullif(event_type, 'click')") == "error"
    return flagged.withColumns(
        {
            "is_anomaly": rules.is_true(F.col("sensor_out_of_range") | degrading),
            "master_missing": F.col("machine_type").isNull(),
        }
    )


FLAG_COLUMNS = [
    "reading_id", "machine_id", "temp_anomaly", "vibration_anomaly", "sensor_out_of_range", "is_anomaly", "master_missing",
]


@query
def anomaly_flags(spark, d):
    return flagged_readings(readings(spark, d), machine_master(spark, d)).select(*FLAG_COLUMNS)


@query
def threshold_labels(spark, d):
    """Degradation labels of a factor, and the test against the normal range of the type."""
    factor = F.col("temperature") / 500
    limits = lookup.add_dimension(readings(spark, d), machine_master(spark, d), "machine_id", ["temp_critical"])
    ranged = limits.withColumn("temp_min", F.lit(10.0))
    return ranged.select(
        "reading_id",
        rules.is_degrading(factor).alias("is_degrading"),
        rules.is_failing(factor).alias("will_fail_in_4hrs"),
        rules.outside_range_flag({"temperature": ("temp_min", "temp_critical")}).alias("outside_normal_range"),
    )


@query
def sensor_lags_and_change(spark, d):
    lagged = rolling.lag_features(readings(spark, d), sensor_spec({}))
    return lagged.drop("timestamp", "event_type")


@query
def rolling_5_15_30m(spark, d):
    rolled = rolling.rolling_features(readings(spark, d), sensor_spec(MINUTE_FRAMES))
    return rolled.select("reading_id", *map(r6, frame_columns(MINUTE_FRAMES)))


@query
def rolling_6_24_72h(spark, d):
    rolled = rolling.rolling_features(readings(spark, d), sensor_spec(HOUR_FRAMES))
    return rolled.select("reading_id", *map(r6, frame_columns(HOUR_FRAMES)))


@query
def anomaly_count_frame(spark, d):
    marked = readings(spark, d).withColumn("is_anomaly", F.col("temperature") > 90)
    counts = {f"anomaly_count_{suffix}": ("is_anomaly", seconds) for suffix, seconds in HOURS.items()}
    rolled = rolling.rolling_features(marked, rolling.RollingSpec(sensors=(), frames={}, counts=counts))
    return rolled.select("reading_id", *counts)


@query
def calendar_and_shift(spark, d):
    ts = F.col("timestamp")
    columns = {**calendar.month_columns(F.year(ts), F.month(ts)), **calendar.shift_columns(ts)}
    return readings(spark, d).select("reading_id", *[value.alias(name) for name, value in columns.items()])


@query
def failure_within_horizon(spark, d):
    marked = rolling.failure_within(readings(spark, d), sensor_spec({}), F.col("event_type") == "error")
    return marked.select("reading_id", "machine_id", "will_fail_in_4hrs")


@query
def machine_features_full(spark, d):
    marked = readings(spark, d).withColumn("is_anomaly", F.col("temperature") > 90)
    spec = sensor_spec(HOUR_FRAMES, {"anomaly_count_6h": ("is_anomaly", HOURS["6h"])})
    features = rolling.machine_features(marked, spec)
    with_shift = features.withColumns(calendar.shift_columns(F.col("timestamp")))
    return rounded(with_shift, frame_columns(HOUR_FRAMES)).drop("timestamp", "event_type")


# ---- reports ------------------------------------------------------------------------------


@query
def risk_tier(spark, d):
    return with_probability(readings(spark, d)).select(
        "reading_id", "failure_probability", "risk_level", "recommendation"
    )


def fleet(spark, d) -> DataFrame:
    """The newest reading of every machine, with type and location."""
    columns = ["machine_id", "failure_probability", "risk_level"]
    newest = reports.latest_status(with_probability(readings(spark, d)), "machine_id", "timestamp", "reading_id", columns)
    return lookup.add_dimension(newest, machine_master(spark, d), "machine_id", ["machine_type", "location"])


@query
def fleet_kpis(spark, d):
    return rounded(reports.fleet_kpis(fleet(spark, d)), ["avg_failure_probability"])


@query
def fleet_kpis_filtered(spark, d):
    chosen = reports.fleet_filter(fleet(spark, d), location=7, machine_type="BUILDING")
    return rounded(reports.fleet_kpis(chosen), ["avg_failure_probability"])


@query
def risk_distribution(spark, d):
    return reports.risk_distribution(reports.fleet_filter(fleet(spark, d), levels=["MEDIUM", "HIGH", "CRITICAL"]))


@query
def risk_quantiles_by_type(spark, d):
    return rounded(
        reports.risk_quantiles(fleet(spark, d)),
        ["minimum", "lower_quartile", "median", "upper_quartile", "maximum"],
    )


@query
def latest_status(spark, d):
    newest = reports.latest_status(
        with_probability(readings(spark, d)),
        "machine_id",
        "timestamp",
        "reading_id",
        ["machine_id", "reading_id", "temperature", "vibration", "failure_probability", "risk_level", "last_updated"],
    )
    return newest.withColumn("last_updated", F.unix_timestamp("last_updated"))


@query
def sensor_trend_30m(spark, d):
    trend = reports.sensor_trend(readings(spark, d), "machine_id", "timestamp", SENSORS)
    return rounded(trend.withColumn("step_start", F.unix_timestamp("step_start")), SENSORS)


@query
def sensor_trend_72h(spark, d):
    trend = reports.sensor_trend(
        readings(spark, d), "machine_id", "timestamp", SENSORS, minutes=72 * 60, step="6 hours"
    )
    return rounded(trend.withColumn("step_start", F.unix_timestamp("step_start")), SENSORS)


# ---- learning -----------------------------------------------------------------------------


def labelled_readings(spark, d) -> DataFrame:
    return readings(spark, d).withColumn("failed", (F.col("event_type") == "error").cast("int"))


@query
def class_balance(spark, d):
    return evaluation.class_balance(labelled_readings(spark, d), "failed")


@query
def median_fill(spark, d):
    gaps = readings(spark, d).select(
        "reading_id",
        F.when(F.col("event_type") != "click", F.col("temperature")).alias("temperature"),
        F.expr("nullif(vibration, 50.0D)").alias("vibration"),
    )
    return rounded(quantiles.fill_with_medians(gaps, SENSORS), SENSORS)


@query
def label_encode(spark, d):
    rows = readings(spark, d).select("reading_id", "event_type")
    return learning.encode_categories(rows, ["event_type"]).withColumn("event_type", F.col("event_type").cast("long"))


@query
def stratified_split(spark, d):
    marked = learning.mark_training_rows(labelled_readings(spark, d), "reading_id", "failed")
    return marked.groupBy("failed", "is_training").agg(F.count(F.lit(1)).alias("rows"))


@query
def classification_report(spark, d):
    predicted = table(spark, d, "labels").select(
        F.col("toxic").alias("label"), (F.col("quality") == 0).cast("int").alias("prediction")
    )
    return rounded(evaluation.class_report(predicted, "label", "prediction"), ["precision", "recall", "f1_score"])


@query
def binary_metrics(spark, d):
    scored = labelled_readings(spark, d).withColumn("score", F.col("temperature") / 500.0)
    return evaluation.binary_metrics(scored, "failed", "score", threshold=0.1)


def training_data(spark, d) -> tuple[DataFrame, learning.TrainingSpec]:
    spec = sensor_spec({"24h": (HOURS["24h"], ("mean", "std", "min", "max"))}, lags=(1, 5))
    marked = rolling.failure_within(readings(spark, d), spec, F.col("event_type") == "error", horizon=24 * 3600)
    features = rolling.machine_features(marked, spec)
    typed = lookup.add_dimension(features, machine_master(spark, d), "machine_id", ["machine_type", "location"])
    ready = typed.withColumns(calendar.shift_columns(F.col("timestamp")))
    shared = {"machine_id", "reading_id", "timestamp", "event_type", "will_fail_in_4hrs", "machine_type", "location"}
    numeric = [name for name in ready.columns if name not in shared]
    return ready, learning.TrainingSpec(numeric, ("machine_type", "location"))


def trained(spark, d):
    """The training table is written once: the trees read it many times."""
    ready, spec = training_data(spark, d)
    path = scratch_dir(spark, "training")
    ready.write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    model, metrics = learning.train(rows, spec)
    return rows, spec, model, metrics


def trained_model(spark, d) -> tuple[str, learning.TrainingSpec]:
    """A folder with a written gold table, the model trained on it and the run."""
    ready, spec = training_data(spark, d)
    folder = scratch_dir(spark, "training")
    ready.write.parquet(f"{folder}/gold")
    failure.train_model(spark.read.parquet(f"{folder}/gold"), spec, f"{folder}/model", f"{folder}/runs")
    return folder, spec


@query
def gbt_train_score(spark, d):
    folder, spec = trained_model(spark, d)
    return failure.score_readings(spark.read.parquet(f"{folder}/gold"), spec, f"{folder}/model")


def with_hot(df: DataFrame) -> DataFrame:
    return df.withColumn("hot", (F.col("temperature") > 250).cast("int"))


def stump(spark, d):
    """One tree with one split on one flag, whose leaves are weighted means of the label."""
    settings = {"label": "failed", "trees": 1, "depth": 1, "row_share": 1.0, "feature_share": 1.0}
    return learning.train(with_hot(labelled_readings(spark, d)), learning.TrainingSpec(["hot"], (), **settings))[0]


@query
def stump_scores(spark, d):
    return learning.score(with_hot(readings(spark, d)), stump(spark, d), ["reading_id", "machine_id"])


BOOSTED = ("hour", "day_of_week", "is_night_shift")


def boosted(spark, d, **settings) -> boosting.BoostedModel:
    rows = labelled_readings(spark, d).withColumns(calendar.shift_columns(F.col("timestamp")))
    return boosting.fit(rows, boosting.BoostingSpec(BOOSTED, "failed", **settings))


@query
def boosting_first_tree(spark, d):
    """Splits, gains and leaf weights of one round of depth 2."""
    model = boosted(spark, d, trees=1, depth=2, rate=1.0)
    return rounded(model.nodes(spark).drop("tree"), ["cut", "gain", "value"])


@query
def boosting_importance(spark, d):
    return rounded(boosting.importance(spark, boosted(spark, d, trees=1, depth=2, rate=1.0)), ["gain"])


@query
def boosting_scores(spark, d):
    """Several rounds on all sensors' features, scored."""
    ready, spec = training_data(spark, d)
    path = scratch_dir(spark, "boosting-gold")
    ready.withColumn("failing", F.col("will_fail_in_4hrs").cast("int")).write.parquet(path)
    rows = spark.read.parquet(path)
    model = boosting.fit(rows, boosting.BoostingSpec(spec.numeric, "failing", trees=4, depth=3, rate=0.3, write_every=2))
    return boosting.predict(rows, model).select("reading_id", F.round("probability", 6).alias("probability"))


@query
def feature_importance_top10(spark, d):
    _, _, model, _ = trained(spark, d)
    return learning.feature_importance(spark, model)


# ---- streams ------------------------------------------------------------------------------


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what there is and read what it wrote."""
    spark = df.sparkSession
    folder = scratch_dir(spark, name)
    writers.append_stream(df, f"{folder}/rows", f"{folder}/checkpoint", every=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def messages_of(events: DataFrame) -> DataFrame:
    body = F.struct(
        "event_id", F.col("ts").cast("string").alias("timestamp"), "user_id", "event_type", "value", "props"
    )
    return events.select(F.to_json(body).alias("value"), F.current_timestamp().alias("timestamp"))


MESSAGE_SCHEMA = schemas.schema_of(
    "event_id bigint, timestamp string, user_id bigint, event_type string, value double, props string"
)


@query
def stream_bronze(spark, d):
    parsed = ingest.parse_messages(messages_of(event_stream(spark, d)), MESSAGE_SCHEMA)
    rows = ingest.bronze_rows(parsed, "kafka")
    folder = scratch_dir(spark, "bronze")
    writers.append_stream(
        rows, f"{folder}/rows", f"{folder}/checkpoint", ["ingestion_date"], every=None
    ).awaitTermination()
    written = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    return written.drop("bronze_ingested_at").withColumn("ingestion_date", F.col("ingestion_date").cast("string"))


@query
def stream_silver(spark, d):
    parsed = ingest.parse_messages(messages_of(event_stream(spark, d)), MESSAGE_SCHEMA)
    bronze = ingest.bronze_rows(parsed, "kafka").withColumn("ts", parsing.to_timestamp_or_null(F.col("timestamp")))
    complete = quality.keep_required(
        as_readings(bronze, "bronze_ingested_at"), ["reading_id", "machine_id", "timestamp"]
    )
    distinct = ingest.drop_repeats(complete, ["reading_id"], "1 day")
    master = machine_master(spark, d)

    def enrich(batch: DataFrame) -> DataFrame:
        flagged = flagged_readings(batch, master)
        return flagged.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})

    folder = scratch_dir(spark, "silver")
    writers.transform_stream(
        distinct, enrich, f"{folder}/rows", f"{folder}/checkpoint", ["year", "month"], every=None
    ).awaitTermination()
    return commits.read_table(spark, f"{folder}/rows").select(*FLAG_COLUMNS)


@query
def stream_dedup(spark, d):
    twice = reading_stream(spark, d).unionByName(reading_stream(spark, d)).withColumn("arrived", F.current_timestamp())
    distinct = ingest.drop_repeats(twice, ["reading_id"], DELAY, arrival="arrived")
    return run_to_table(distinct, "dedup").drop("timestamp", "arrived")


@query
def stream_late_rows(spark, d):
    """Micro-batches in which rows come long after newer ones, some of them again."""
    folder, events = scratch_dir(spark, "late-events"), table(spark, d, "events")
    newer = F.col("ts") >= F.lit(events.agg(F.percentile_approx("ts", 0.5)).first()[0])
    events.where(newer).write.parquet(folder)
    events.write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    rows = as_readings(arriving).withColumn("arrived", F.current_timestamp())
    distinct = ingest.drop_repeats(rows, ["reading_id"], "1 day", arrival="arrived")
    return run_to_table(distinct, "late-rows").drop("timestamp", "arrived")


def _window_table(df: DataFrame, name: str) -> DataFrame:
    done = run_to_table(df, name)
    means = [f"{s}_mean" for s in SENSORS]
    bounds = {c: F.unix_timestamp(c) for c in ("window_start", "window_end")}
    return rounded(done.withColumns(bounds), means)


@query
def stream_windows_tumbling(spark, d):
    rows = reading_stream(spark, d)
    return _window_table(windows.tumbling(rows, "timestamp", ["machine_id"], SENSORS, "6 hours", DELAY), "tumbling")


@query
def stream_windows_sliding(spark, d):
    rows = reading_stream(spark, d)
    grouped = windows.sliding(rows, "timestamp", ["machine_id"], SENSORS, "24 hours", "6 hours", DELAY)
    return _window_table(grouped, "sliding")


@query
def stream_windows_session(spark, d):
    rows = reading_stream(spark, d)
    with setting(spark, LOCAL_SESSIONS, "true"):
        return _window_table(windows.sessions(rows, "timestamp", ["machine_id"], SENSORS, "6 hours", DELAY), "session")


@query
def stream_windows_late(spark, d):
    """Rows with even ids come first, the others after them, in another batch and long too late."""
    folder, events = scratch_dir(spark, "late-windows"), table(spark, d, "events")
    for odd in (0, 1):
        events.where(F.col("event_id") % 2 == odd).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    rows = as_readings(readers.parquet_stream(spark, f"{folder}/in", events.schema, max_files_per_trigger=1))
    latewindows.start_windows(
        rows, "timestamp", ["machine_id"], SENSORS, f"{folder}/out", f"{folder}/checkpoint", "6 hours", None, DELAY, every=None
    ).awaitTermination()
    done = latewindows.read_windows(spark, f"{folder}/out", ["machine_id"], SENSORS)
    late = latewindows.late_rows(spark, f"{folder}/out").groupBy("window_start", "machine_id").agg(F.count("*").alias("late"))
    whole = done.join(late, ["window_start", "machine_id"], "full")
    bounds = {"window_start": F.unix_timestamp("window_start"), "late": F.coalesce("late", F.lit(0))}
    return rounded(whole.drop("window_end").withColumns(bounds), [f"{s}_mean" for s in SENSORS]).fillna(0, ["readings"])


@query
def stream_failure_horizon(spark, d):
    failures = reading_stream(spark, d).filter(F.col("event_type") == "error")
    ahead = horizon.failures_ahead(reading_stream(spark, d), failures, "machine_id", "timestamp", "reading_id")
    return run_to_table(ahead, "horizon").select("machine_id", "reading_id")


@query
def stream_stateful_lag(spark, d):
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        lagged = stateful.stream_lags(reading_stream(spark, d), "machine_id", "timestamp", "reading_id", SENSORS)
        return run_to_table(lagged, "lags").drop("timestamp", "event_type")


@query
def stream_lag_by_batch(spark, d):
    spec = sensor_spec({})
    folder = scratch_dir(spark, "lag-batches")
    stateful.start_lag_batches(
        reading_stream(spark, d), spec, f"{folder}/rows", f"{folder}/recent", f"{folder}/checkpoint", every=None
    ).awaitTermination()
    lags = [f"{s}_lag{n}" for s in SENSORS for n in spec.lags]
    return commits.read_table(spark, f"{folder}/rows").select("reading_id", "machine_id", *SENSORS, *lags)


@query
def stream_ordered_lag(spark, d):
    """Readings with odd ids come a quarter of the time line later than those with even ids.

    Each part arrives as one file per core, so that no task writes or reads a part alone. A batch may
    take files of two parts: no reading is late by then, as the delay is two quarters.
    """
    folder, spec = scratch_dir(spark, "ordered-lags"), sensor_spec({})
    events = table(spark, d, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    quarter = (last - first) / 4 + datetime.timedelta(seconds=1)
    number = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit(first))) / quarter.total_seconds())
    files = spark.sparkContext.defaultParallelism
    for k in range(5):
        events.where(number + F.col("event_id") % 2 == k).repartition(files).write.mode("append").parquet(f"{folder}/in")
    rows = as_readings(readers.parquet_stream(spark, f"{folder}/in", events.schema, max_files_per_trigger=files))
    delay = f"{int(2 * quarter.total_seconds())} seconds"
    orderedlags.start_ordered_lags(rows, spec, f"{folder}/out", f"{folder}/checkpoint", delay, every=None).awaitTermination()
    lags = [f"{s}_lag{n}" for s in SENSORS for n in spec.lags]
    done = orderedlags.read_ordered_lags(spark, f"{folder}/out", spec, finish=True)
    return done.select("reading_id", "machine_id", *SENSORS, *lags)


@query
def stream_scoring(spark, d):
    """Gold rows that arrive as a stream, scored by the saved model of the training job."""
    folder, spec = trained_model(spark, d)
    rows = spark.read.parquet(f"{folder}/gold")
    arriving = readers.parquet_stream(spark, f"{folder}/gold", rows.schema)
    return run_to_table(failure.score_readings(arriving, spec, f"{folder}/model"), "scoring")
