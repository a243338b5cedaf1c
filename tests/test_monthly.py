import datetime as dt

from pyspark.sql import functions as F

from smeltery.operators import monthly

COLUMNS = (
    "transaction_id string, drug_id string, region_id string, drug_name string, transaction_date date, "
    "quantity_sold int, revenue double, returns int, unit_price double, channel string, is_event_day boolean"
)


def sale(n, year, month, quantity, name="a", channel="Retail", event=False, price=2.0):
    return (str(n), "D1", "R1", name, dt.date(year, month, 3), quantity, quantity * 2.0, 1, price, channel, event)


def by_month(df):
    return {(r.year, r.month): r for r in df.collect()}


def test_totals(spark):
    rows = [
        sale(1, 2024, 1, 10, channel="Hospital", event=True),
        sale(2, 2024, 1, 5, channel="Clinic", price=4.0),
        sale(3, 2024, 1, 7, channel="Online", price=None),
    ]
    row = monthly.monthly_totals(spark.createDataFrame(rows, COLUMNS)).first()
    assert (row.total_units_sold, row.total_returns, row.num_transactions) == (22, 3, 3)
    assert (row.hospital_qty, row.clinic_qty, row.retail_qty) == (10, 5, 0)
    assert (row.event_day_qty, row.event_day_count, row.avg_unit_price) == (10, 1, 3.0)


def test_renamed_item_stays_one_series(spark):
    rows = [sale(1, 2024, 1, 1, "old"), sale(2, 2024, 1, 2, "new"), sale(3, 2024, 1, 3, "new"), sale(4, 2024, 2, 8, "new")]
    spec = monthly.MonthlySpec(attributes=("drug_name",))
    out = by_month(monthly.monthly_features(spark.createDataFrame(rows, COLUMNS), spec))
    assert len(out) == 2
    assert (out[2024, 1].drug_name, out[2024, 1].total_units_sold) == ("new", 6)
    assert (out[2024, 2].lag_1m, round(out[2024, 2].mom_growth_rate, 4)) == (6, 0.3333)


def test_rows_and_months_differ_after_a_gap(spark):
    months = [(2023, 1), (2023, 2), (2023, 4)] + [(2023, m) for m in range(5, 13)] + [(2024, 1), (2024, 2)]
    df = spark.createDataFrame([sale(i, y, m, 10 + i) for i, (y, m) in enumerate(months)], COLUMNS)
    rows, dates = by_month(monthly.monthly_features(df)), by_month(monthly.monthly_features(df, calendar_lags=True))
    assert (rows[2023, 4].lag_1m, dates[2023, 4].lag_1m) == (11, None)
    assert (rows[2023, 4].rolling_avg_3m, dates[2023, 4].rolling_avg_3m) == (11.0, 11.5)
    assert (rows[2024, 2].lag_12m, dates[2024, 2].lag_12m) == (10, 11)
    assert (rows[2024, 1].lag_12m, dates[2024, 1].lag_12m) == (None, 10)
    assert rows[2023, 1].mom_growth_rate == dates[2023, 1].mom_growth_rate == 0.0


def test_growth_after_a_zero_month_is_zero(spark):
    df = spark.createDataFrame([sale(1, 2024, 1, 0), sale(2, 2024, 2, 5)], COLUMNS)
    assert by_month(monthly.monthly_features(df))[2024, 2].mom_growth_rate == 0.0


def test_windows_share_one_sort(spark):
    df = spark.createDataFrame([sale(1, 2024, 1, 1)], COLUMNS)
    plan = monthly.row_history(monthly.monthly_totals(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_channel_sums_do_not_exceed_the_total(spark):
    rows = [sale(i, 2024, 1 + i % 3, i, channel=("Hospital", "Clinic", "Retail", "Web")[i % 4]) for i in range(40)]
    out = monthly.monthly_totals(spark.createDataFrame(rows, COLUMNS))
    parts = F.col("hospital_qty") + F.col("clinic_qty") + F.col("retail_qty")
    assert out.filter(parts > F.col("total_units_sold")).count() == 0
