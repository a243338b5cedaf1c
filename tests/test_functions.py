import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from smeltery.functions import calendar, parsing, rules


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_seasons_and_month_flags(spark):
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    names = column(months, calendar.season(F.col("m")))
    assert names == ["Winter"] * 2 + ["Spring"] * 3 + ["Monsoon"] * 4 + ["Autumn"] * 2 + ["Winter"]
    flags = calendar.month_columns(F.lit(2024), F.col("m"))
    on = {name: [i + 1 for i, v in enumerate(column(months, flags[name])) if v] for name in calendar.MONTH_FLAGS}
    assert on == {
        "is_flu_season": [1, 2, 11, 12],
        "is_monsoon": [6, 7, 8, 9],
        "is_festival_season": [10, 11],
        "is_summer": [4, 5, 6],
    }
    assert column(months, flags["quarter"]) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]


def test_night_shift_spans_midnight(spark):
    hours = spark.range(24).select(F.timestamp_seconds(F.col("id") * 3600).alias("t"))
    night = column(hours, calendar.shift_columns(F.col("t"))["is_night_shift"])
    assert [h for h in range(24) if night[h]] == [0, 1, 2, 3, 4, 5, 6, 22, 23]
    sunday = spark.createDataFrame([(dt.datetime(2024, 1, 7),)], ["t"])
    assert column(sunday, calendar.shift_columns(F.col("t"))["day_of_week"]) == [1]


def test_relative_change_guards_the_base_only(spark):
    rows = [(4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0)]
    df = spark.createDataFrame(rows, "y double, x double")
    assert column(df, rules.relative_change(F.col("y"), F.col("x"))) == [1.0, 0.0, 0.0, None]


def test_high_return_is_strictly_above_the_share(spark):
    df = spark.createDataFrame([(9, 100), (10, 100), (11, 100), (None, 100)], "r int, q int")
    assert column(df, rules.high_return(F.col("r"), F.col("q"))) == [False, False, True, False]


def test_limits_and_ranges(spark):
    df = spark.createDataFrame([(5.0, 5.0, 1.0), (5.1, 5.0, 1.0), (0.5, 5.0, 1.0), (9.0, None, None)], "s double, hi double, lo double")
    assert column(df, rules.above_limit_flags({"f": ("s", "hi")})["f"]) == [False, True, False, False]
    assert column(df, rules.outside_range_flag({"s": ("lo", "hi")})) == [False, True, True, False]


def test_risk_tiers_include_their_lower_bound(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.2499, 0.25, 0.4999, 0.5, 0.75, 1.0, None)], "p double")
    level = rules.risk_level(F.col("p"))
    assert column(df, level) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", None]
    assert column(df, rules.recommendation(level))[5] == "Immediate shutdown and inspection required!"
    assert column(spark.createDataFrame([(0.87654,)], "p double"), rules.failure_probability(F.col("p"))) == [0.8765]


def test_labels_revenue_and_age(spark):
    df = spark.createDataFrame([(0.3,), (0.31,), (0.8,), (0.81,)], "f double")
    assert column(df, rules.is_degrading(F.col("f"))) == [False, True, True, True]
    assert column(df, rules.is_failing(F.col("f"))) == [False, False, False, True]
    money = spark.createDataFrame([(10, 1, 2.5, 22.5), (10, 1, 2.5, 22.6), (10, 1, 2.5, None)], "q int, r int, p double, v double")
    parts = (F.col("q"), F.col("r"), F.col("p"))
    assert column(money, rules.net_revenue(*parts)) == [Decimal("22.50")] * 3
    assert column(money, rules.revenue_mismatch(F.col("v"), *parts)) == [False, True, False]
    dates = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2022, 1, 1))], ["a", "b"])
    assert column(dates, rules.machine_age_years(F.col("a"), F.col("b"))) == [2.0]


def test_parsing_never_fails(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02",), ("soon",), (None,)], "t string")
    assert column(df, parsing.to_timestamp_or_null(F.col("t"))) == [
        dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), None, None,
    ]
    assert column(df, parsing.to_date_or_null(F.col("t"))) == [dt.date(2024, 1, 2)] * 2 + [None, None]
    numbers = spark.createDataFrame([("7",), ("x",), (None,)], "t string")
    assert column(numbers, parsing.cast_or_null(F.col("t"), "int")) == [7, None, None]
    lists = spark.createDataFrame([("a|b|a",), ("c",)], "t string")
    assert column(lists, parsing.split_list(F.col("t"))) == [["a", "b"], ["c"]]
