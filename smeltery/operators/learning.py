"""Training data, boosted-tree training and scoring with MLlib."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltery.functions.rules import is_true
from smeltery.operators import quantiles
from smeltery.operators.evaluation import binary_metrics, class_balance, class_report
from smeltery.operators.reports import add_risk
from smeltery.session import scratch_dir

# Columns that are no features, and the categorical ones.
NOT_FEATURES = (
    "reading_id", "machine_name", "timestamp", "reading_date", "ingestion_source",
    "ingestion_timestamp", "bronze_ingested_at", "silver_processed_at", "gold_processed_at",
    "ingestion_date", "degradation_factor",
)
CATEGORIES = ("machine_id", "machine_type", "location", "criticality", "manufacturer")
# Optional inputs of the scorer and what stands for a missing one.
SCORING_DEFAULTS = {
    "is_anomaly": False, "anomaly_count_5m": 0, "hour": 12, "day_of_week": 1, "is_night_shift": 0,
}


@dataclass(frozen=True)
class TrainingSpec:
    """Features, label and model settings."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    label: str = "will_fail_in_4hrs"
    row_id: str = "reading_id"
    # The settings of the boosted trees and of the split.
    trees: int = 200
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    seed: int = 42
    train_share: float = 0.8
    extra: Mapping[str, object] = field(default_factory=dict)


def drop_columns(df: DataFrame, columns: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Drop what is present of the listed columns."""
    return df.drop(*columns)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with a label, as 0.0 or 1.0."""
    return df.na.drop(subset=[label]).withColumn(label, F.col(label).cast("int").cast("double"))


def split_bucket(row_id: str, seed: int) -> Column:
    """A number from 0 to 9,999 that depends only on the row's id and the seed, by md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000


def mark_training_rows(
    df: DataFrame, row_id: str, label: str, share: float = 0.8, seed: int = 42, name: str = "is_training"
) -> DataFrame:
    """Mark the training share of every class by a cut-off on a hash of the id.

    No shuffle of the rows: the cut-off per class comes from counting buckets, which gives
    at most 10,000 rows per class, and is joined back as one row per class.
    """
    bucket = split_bucket(row_id, seed)
    counted = df.groupBy(label, bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
    order = Window.partitionBy(label).orderBy("__bucket")
    upto = F.sum("__rows").over(order)
    total = F.sum("__rows").over(Window.partitionBy(label))
    cuts = (
        counted.select(label, "__bucket", (upto <= F.round(total * share)).alias("__in"))
        .groupBy(label)
        .agg(F.max(F.when(F.col("__in"), F.col("__bucket"))).alias("__cut"))
    )
    joined = df.join(F.broadcast(cuts), df[label].eqNullSafe(cuts[label]), "left").drop(cuts[label])
    return joined.withColumn(name, F.coalesce(bucket <= F.col("__cut"), F.lit(False))).drop("__cut")


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """``value, code``: alphabetical codes of a categorical column from 0, none for NULL.

    Distinct values are sorted by range over all tasks and written, each with the number of its
    range; a code is the number of values in earlier ranges plus the place in its own. What is
    ordered in one task are the counts, one per range, whatever the values have in common.
    """
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).distinct().na.drop()
    path = scratch_dir(df.sparkSession, "category-values")
    values.repartitionByRange("value").withColumn("__range", F.spark_partition_id()).write.parquet(path)
    placed = df.sparkSession.read.schema("value string, __range int").parquet(path)
    counted = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__values"))
    earlier = F.sum("__values").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("__range", F.coalesce(earlier, F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy("value")) - 1
    return placed.withColumn("__own", own).join(starts, "__range").select("value", (F.col("__start") + F.col("__own")).alias("code"))


def with_codes(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """A further column with the code of a categorical one; NULL where there is none."""
    named = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    joined = df.join(named, F.col(f"`{column}`").cast("string") == F.col("__value"), "left")
    return joined.withColumn(name, F.col("__code")).drop("__value", "__code")


def encode_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categorical columns replaced by their alphabetical codes."""
    for column in columns:
        df = with_codes(df, column, category_codes(df, column), column)
    return df


@dataclass(frozen=True)
class Model:
    """What scoring repeats of training: medians of the numbers, codes of the categories, the trees.

    A category that training has not seen, and NULL, has the code after the last.
    """

    medians: Mapping[str, float]
    codes: Mapping[str, DataFrame]
    unknown: Mapping[str, int]
    trees: PipelineModel

    def prepare(self, df: DataFrame) -> DataFrame:
        """The rows with the inputs of the trees; works on a stream."""
        for column, codes in self.codes.items():
            df = with_codes(df, column, codes, f"{column}__code")
        ready = {f"{c}__code": F.coalesce(f"{c}__code", F.lit(n)).cast("double") for c, n in self.unknown.items()}
        return df.withColumns(ready | {f"{c}__filled": quantiles.filled(c, m) for c, m in self.medians.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(self.prepare(df))


def boosted_trees(spec: TrainingSpec, inputs: Sequence[str]) -> Pipeline:
    """Codes enter the trees as ordinary numbers, so the bins of a tree do not limit their number."""
    trees = GBTClassifier(
        labelCol=spec.label,
        featuresCol="features",
        weightCol="__weight",
        maxIter=spec.trees,
        maxDepth=spec.depth,
        stepSize=spec.rate,
        subsamplingRate=spec.row_share,
        featureSubsetStrategy=str(spec.feature_share),
        seed=spec.seed,
        **spec.extra,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="features"), trees])


def fit(rows: DataFrame, spec: TrainingSpec) -> Model:
    """Medians, codes and trees of training rows, which have a ``__weight``."""
    found = quantiles.medians(rows, spec.numeric)
    if len(found) < len(spec.numeric):
        warnings.warn(f"no values in {sorted(set(spec.numeric) - set(found))}", stacklevel=3)
    codes = {c: category_codes(rows, c) for c in spec.categorical}
    prepared = Model(found, codes, {c: table.count() for c, table in codes.items()}, PipelineModel([]))
    inputs = [f"{c}__filled" for c in found] + [f"{c}__code" for c in spec.categorical]
    return replace(prepared, trees=boosted_trees(spec, inputs).fit(prepared.prepare(rows)))


def train(df: DataFrame, spec: TrainingSpec, training: Column | None = None) -> tuple[Model, dict[str, float]]:
    """Fit on the training share and measure on the rest, as a whole and per class.

    A numeric column without any value cannot be filled; it is left out with a warning.

    Give it a written table: encoder, fill and trees each read the rows again. The held-out rows are
    scored once, and their scores written, as the metrics read them several times. ``training``
    is a condition that replaces the split by classes, such as a time before a cut.
    """
    wanted = [spec.row_id, spec.label, *spec.numeric, *spec.categorical]
    if training is None:
        marked = mark_training_rows(df, spec.row_id, spec.label, spec.train_share, spec.seed)
    else:
        marked = df.withColumn("is_training", is_true(training))
    marked = labelled(marked.select(*wanted, "is_training"), spec.label)
    training, held_out = marked.filter("is_training"), marked.filter(~F.col("is_training"))
    weight = class_balance(marked, spec.label).first()["positive_weight"]
    if not weight:
        raise ValueError(f"{spec.label} needs rows of both classes")
    weighted = training.withColumn("__weight", F.when(F.col(spec.label) == 1.0, float(weight)).otherwise(1.0))
    model = fit(weighted, spec)
    scores = positive_probability(model.transform(held_out), "__score").select(spec.label, "__score", "prediction")
    path = scratch_dir(df.sparkSession, "held-out-scores")
    scores.write.parquet(path)
    scored = df.sparkSession.read.schema(scores.schema).parquet(path)
    metrics = binary_metrics(scored, spec.label, "__score").first().asDict()
    for row in class_report(scored, spec.label, "prediction").collect():
        metrics |= {f"{name}_class_{int(row['class'])}": float(row[name]) for name in ("precision", "recall", "f1_score", "support")}
    return model, metrics


def positive_probability(predictions: DataFrame, name: str) -> DataFrame:
    return predictions.withColumn(name, vector_to_array("probability")[1])


def score(df: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """Probability, tier and advice for each reading, of a table or of a stream."""
    predicted = positive_probability(model.transform(df), "__score")
    return add_risk(predicted, F.col("__score")).select(
        *keep, "failure_probability", "risk_level", "recommendation"
    )


def fill_scoring_defaults(df: DataFrame, defaults: Mapping[str, object] = SCORING_DEFAULTS) -> DataFrame:
    """Optional inputs: a missing column is added, a missing value is replaced."""
    present = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    added = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns({**present, **added})


def feature_importance(spark: SparkSession, model: Model, top: int = 10) -> DataFrame:
    """The features the trees used most, by name."""
    names = [name.removesuffix("__filled").removesuffix("__code") for name in model.trees.stages[-2].getInputCols()]
    weights = model.trees.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame(
        [(name, float(weight)) for name, weight in zip(names, weights)], "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def log_run(spark: SparkSession, path: str, spec: TrainingSpec, metrics: Mapping[str, float]) -> None:
    """Append one row of settings and metrics to the table of runs."""
    settings = {name: str(value) for name, value in asdict(spec).items()}
    row = spark.createDataFrame([(settings, dict(metrics))], "parameters map<string,string>, metrics map<string,double>")
    row.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def save_model(model: Model, path: str) -> None:
    """The trees, a table of medians and unknown codes, and a table of the known ones."""
    model.trees.write().overwrite().save(f"{path}/trees")
    spark = SparkSession.getActiveSession()
    fills = [(c, m, None) for c, m in model.medians.items()] + [(c, None, n) for c, n in model.unknown.items()]
    table = spark.createDataFrame(fills, "feature string, median double, unknown long")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/fills")
    codes = spark.createDataFrame([], "feature string, value string, code long")
    for column, known in model.codes.items():
        codes = codes.unionByName(known.select(F.lit(column).alias("feature"), "value", "code"))
    codes.write.mode("overwrite").parquet(f"{path}/codes")


def load_model(path: str) -> Model:
    spark = SparkSession.getActiveSession()
    fills = spark.read.parquet(f"{path}/fills").collect()
    codes = spark.read.schema("feature string, value string, code long").parquet(f"{path}/codes")
    unknown = {r["feature"]: r["unknown"] for r in fills if r["unknown"] is not None}
    return Model(
        {r["feature"]: r["median"] for r in fills if r["unknown"] is None},
        {c: codes.where(F.col("feature") == c).select("value", "code") for c in unknown},
        unknown,
        PipelineModel.load(f"{path}/trees"),
    )
