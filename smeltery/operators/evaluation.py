"""Class balance and classification metrics, each one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives, share of positives and the weight that balances them."""
    positives = F.sum(F.col(label).cast("int"))
    counted = df.filter(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), positives.alias("positives")
    )
    negatives = F.col("rows") - F.col("positives")
    return counted.select(
        "rows",
        "positives",
        F.try_divide(F.col("positives"), F.col("rows")).alias("positive_rate"),
        F.try_divide(negatives, F.col("positives")).alias("positive_weight"),
    )


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """A share that is 0 when nothing was predicted or present."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _scores(hits: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(hits, predicted),
        "recall": _ratio(hits, actual),
        "f1_score": _ratio(2 * hits, predicted + actual),
    }


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    cells = confusion_counts(df, label, prediction)
    rows, none = F.col("rows"), F.lit(0).cast("long")
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), rows.alias("actual"), none.alias("predicted")),
                F.struct(F.col("prediction").alias("class"), none.alias("actual"), rows.alias("predicted")),
            )
        ).alias("side"),
        F.when(F.col("label") == F.col("prediction"), rows).otherwise(0).alias("hits"),
    ).select("side.*", "hits")
    # A cell on the diagonal appears on both sides, so its hits are counted once.
    totals = sides.groupBy("class").agg(
        F.sum("actual").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum(F.when(F.col("actual") > 0, F.col("hits")).otherwise(0)).alias("hits"),
    )
    scores = _scores(F.col("hits"), F.col("predicted"), F.col("support"))
    return totals.select("class", *[value.alias(name) for name, value in scores.items()], "support")


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5, ranges: int = 64) -> DataFrame:
    """ROC AUC, F1, precision and recall at a threshold, rounded to 4 digits.

    The area is exact: labels are counted per distinct score, ties count half. Distinct scores
    are cut into about equal ranges by approximate quantiles; each range is ordered by itself
    and starts with the negatives of the ranges below, so no task orders all scores.
    """
    positive = F.col(label).cast("int") == 1
    predicted = F.col(score) >= threshold
    levels = df.groupBy(F.col(score).cast("double").alias("level")).agg(
        F.count_if(positive).alias("pos"),
        F.count_if(~positive).alias("neg"),
        F.count_if(positive & predicted).alias("hits"),
        F.count_if(predicted).alias("predicted"),
    )
    shares = [i / ranges for i in range(1, ranges)]
    cuts = levels.agg(F.percentile_approx("level", shares, 1000).alias("cuts"))
    lower = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda cut: cut < F.col("level")))
    placed = levels.crossJoin(F.broadcast(cuts)).withColumn("range", F.greatest(lower, F.lit(0))).drop("cuts")
    per_range = placed.groupBy("range").agg(F.sum("neg").alias("range_neg"))
    earlier = F.sum("range_neg").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_range.select("range", F.coalesce(earlier, F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    won = F.col("pos") * (below + F.col("neg") / 2)
    totals = placed.join(starts, "range").withColumn("won", won).agg(
        F.sum("won").alias("won"),
        *[F.sum(name).alias(name) for name in ("pos", "neg", "hits", "predicted")],
    )
    area = F.try_divide(F.col("won"), F.col("pos").cast("double") * F.col("neg"))
    scores = _scores(F.col("hits"), F.col("predicted"), F.col("pos"))
    return totals.select(
        F.round(area, 4).alias("roc_auc"), *[F.round(value, 4).alias(name) for name, value in scores.items()]
    )
