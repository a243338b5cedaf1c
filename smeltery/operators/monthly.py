"""Monthly demand features per series (drug and region)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.functions.calendar import month_columns, month_index
from smeltery.functions.rules import relative_change

MONTH_INDEX = "__month_index"


@dataclass(frozen=True)
class MonthlySpec:
    """Which columns of the sales table play which part."""

    series: Sequence[str] = ("drug_id", "region_id")
    attributes: Sequence[str] = ()
    date: str = "transaction_date"
    row_id: str = "transaction_id"
    quantity: str = "quantity_sold"
    revenue: str = "revenue"
    returns: str = "returns"
    price: str = "unit_price"
    channel: str = "channel"
    event_day: str = "is_event_day"
    # Channels and the columns of their quantities.
    channels: dict[str, str] = field(
        default_factory=lambda: {"hospital_qty": "Hospital", "clinic_qty": "Clinic", "retail_qty": "Retail"}
    )
    lags: Sequence[int] = (1, 3, 6, 12)
    means: Sequence[int] = (3, 6)


def channel_quantities(spec: MonthlySpec) -> dict[str, Column]:
    """Quantity sold per channel, to be summed; other channels count as 0."""
    return {
        name: F.when(F.col(spec.channel) == channel, F.col(spec.quantity)).otherwise(0)
        for name, channel in spec.channels.items()
    }


def monthly_totals(sales: DataFrame, spec: MonthlySpec = MonthlySpec()) -> DataFrame:
    """One row per series and month.

    Attributes describe the series but are not part of its key. They are carried through
    the first, map-side reduced aggregation and settled per series and month afterwards, by
    the variant with most transactions, so a renamed item stays one series. The second step
    runs on monthly rows placed by series, which is also what the windows need.
    """
    on_event_day = F.col(spec.event_day)
    months = [F.year(spec.date).alias("year"), F.month(spec.date).alias("month")]
    first = sales.groupBy(*spec.series, *spec.attributes, *months).agg(
        F.sum(spec.quantity).alias("total_units_sold"),
        F.sum(spec.revenue).alias("total_revenue"),
        F.sum(spec.returns).alias("total_returns"),
        F.sum(spec.price).alias("__price_sum"),
        F.count(spec.price).alias("__price_count"),
        F.count(spec.row_id).alias("num_transactions"),
        *[F.sum(value).alias(name) for name, value in channel_quantities(spec).items()],
        F.sum(F.when(on_event_day, F.col(spec.quantity)).otherwise(0)).alias("event_day_qty"),
        F.count_if(on_event_day).alias("event_day_count"),
    )
    measures = [
        name for name in first.columns if name not in {*spec.series, *spec.attributes, "year", "month"}
    ]
    if spec.attributes:
        described = F.struct(*spec.attributes)
        settled = (
            first.repartition(*spec.series)
            .groupBy(*spec.series, "year", "month")
            .agg(
                F.max_by(described, F.struct(F.col("num_transactions"), described)).alias("__attributes"),
                *[F.sum(name).alias(name) for name in measures],
            )
        )
        first = settled.select(
            *spec.series, "__attributes.*", "year", "month", *measures
        )
    average = F.col("__price_sum") / F.when(F.col("__price_count") > 0, F.col("__price_count"))
    return first.withColumn("avg_unit_price", average.cast("double")).drop("__price_sum", "__price_count")


def add_month_index(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn(MONTH_INDEX, month_index(F.col("year"), F.col("month")))


def row_history(monthly: DataFrame, spec: MonthlySpec = MonthlySpec(), value: str = "total_units_sold") -> DataFrame:
    """Lags and rolling means that count rows: a month without sales is not a step."""
    window = Window.partitionBy(*spec.series).orderBy("year", "month")
    return _with_growth(
        monthly,
        value,
        {f"lag_{n}m": F.lag(value, n).over(window) for n in spec.lags},
        {f"rolling_avg_{n}m": F.avg(value).over(window.rowsBetween(1 - n, 0)) for n in spec.means},
    )


def calendar_history(
    monthly: DataFrame, spec: MonthlySpec = MonthlySpec(), value: str = "total_units_sold"
) -> DataFrame:
    """Lags and rolling means that count months: a lag into a month without sales is NULL."""
    window = Window.partitionBy(*spec.series).orderBy(MONTH_INDEX)
    return _with_growth(
        add_month_index(monthly),
        value,
        {f"lag_{n}m": F.max(value).over(window.rangeBetween(-n, -n)) for n in spec.lags},
        {f"rolling_avg_{n}m": F.avg(value).over(window.rangeBetween(1 - n, 0)) for n in spec.means},
    ).drop(MONTH_INDEX)


def _with_growth(
    monthly: DataFrame, value: str, lags: dict[str, Column], means: dict[str, Column]
) -> DataFrame:
    """All window columns in one projection, so they share one sort."""
    with_windows = monthly.select(
        "*", *[column.alias(name) for name, column in {**lags, **means}.items()]
    )
    return with_windows.withColumn("mom_growth_rate", relative_change(F.col(value), F.col("lag_1m")))


def monthly_features(
    sales: DataFrame, spec: MonthlySpec = MonthlySpec(), calendar_lags: bool = False
) -> DataFrame:
    """Totals, history and calendar columns."""
    history = calendar_history if calendar_lags else row_history
    features = history(monthly_totals(sales, spec), spec)
    return features.withColumns(month_columns(F.col("year"), F.col("month")))
