"""Boosted trees on histograms of gradients and curvatures.

A tree is grown level by level. A level is one pass over the rows: a task adds, for every open node,
feature and bin, the gradients and curvatures of the logistic loss of its rows; the sums of all tasks
tell the gain of every split, and the best of each node is taken. What reaches the driver are those
sums, nodes times features times bins of them, whatever the number of rows. Leaf weights are
penalised by their squares. Importance is the gain of a feature's splits.

Rows carry the margin of the trees so far; it is brought up to date and written every few trees, so
that a pass evaluates few trees and the lineage stays short.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.session import scratch_dir


@dataclass(frozen=True)
class BoostingSpec:
    """Columns and settings; ``weight`` names a column of row weights, if there is one."""

    features: Sequence[str]
    label: str
    weight: str | None = None
    trees: int = 50
    depth: int = 4
    rate: float = 0.1
    bins: int = 64
    #: Penalty on squared leaf weights, least curvature of a child, least gain of a split.
    penalty: float = 1.0
    least_curvature: float = 1.0
    least_gain: float = 0.0
    #: Trees after which margins are written.
    write_every: int = 8


@dataclass
class BoostedTree:
    """Nodes of a full binary tree, children of i at 2i + 1 and 2i + 2; a leaf has feature -1."""

    feature: list[int]
    cut: list[float]
    value: list[float]
    gain: list[float]

    def leaves(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after ``depth`` steps; values above a cut, and NaN, go right."""
        at = np.zeros(len(rows), np.int64)
        feature, cut = np.array(self.feature), np.array(self.cut)
        for _ in range(depth):
            split = feature[at] >= 0
            inner = at[split]
            left = rows[split, feature[inner]] <= cut[inner]
            at[split] = 2 * inner + np.where(left, 1, 2)
        return at


@dataclass
class BoostedModel:
    """Trees in order; the probability is the logistic of the sum of their leaf values."""

    features: list[str]
    depth: int
    trees: list[BoostedTree] = field(default_factory=list)

    def margins(self, rows: np.ndarray, first: int = 0) -> np.ndarray:
        total = np.zeros(len(rows))
        for tree in self.trees[first:]:
            total += np.array(tree.value)[tree.leaves(rows, self.depth)]
        return total

    def importance(self) -> dict[str, float]:
        """Gain of each feature's splits; 0 for a feature that has none."""
        gains = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    gains[self.features[feature]] += gain
        return gains

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node that rows reach: tree, node, feature and cut or NULL, gain and value."""
        rows = []
        for number, tree in enumerate(self.trees):
            reached = [0]
            for node in reached:
                split = tree.feature[node] >= 0
                name, cut = (self.features[tree.feature[node]], tree.cut[node]) if split else (None, None)
                rows.append((number, node, name, cut, tree.gain[node], tree.value[node]))
                reached += [2 * node + 1, 2 * node + 2] if split else []
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, gain double, value double")


def matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    """The features of a batch as numbers, NULL as NaN."""
    columns = [batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(features))]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


def feature_cuts(rows: DataFrame, n: int, bins: int) -> list[np.ndarray]:
    """For each feature the values that may cut it: all but the last if few, else quantiles."""
    shares = [i / bins for i in range(1, bins)]
    cuts = []
    found = rows.agg(
        *[F.percentile_approx(F.nanvl(f"x{i}", F.lit(None)), shares, 100 * bins) for i in range(n)],
        *[F.max(F.nanvl(f"x{i}", F.lit(None))) for i in range(n)],
        *[F.approx_count_distinct(f"x{i}") for i in range(n)],
    ).first()
    few = [i for i in range(n) if found[2 * n + i] <= bins // 2]
    exact = rows.agg(*[F.collect_set(F.nanvl(f"x{i}", F.lit(None))) for i in few]).first() if few else ()
    known = dict(zip(few, exact))
    for i in range(n):
        values = np.unique(np.array(known.get(i, found[i] or []), np.float64))
        cuts.append(values[values < found[n + i]] if found[n + i] is not None else values[:0])
    return cuts


def _histogram(rows: DataFrame, model: BoostedModel, done: int, tree: BoostedTree, level: int, cuts: list[np.ndarray]) -> np.ndarray:
    """Sums of gradient and curvature per node of a level, feature and bin (values up to a cut)."""
    bins = max((len(c) for c in cuts), default=0) + 1
    shape = (1 << level, len(cuts), bins)
    size, features = int(np.prod(shape)), model.features

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size))
        for batch in batches:
            x = matrix(batch, features)
            label, weight, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "margin"))
            chance = 1 / (1 + np.exp(-(margin + model.margins(x, done))))
            gradient, curvature = (chance - label) * weight, chance * (1 - chance) * weight
            node = tree.leaves(x, level) - ((1 << level) - 1)
            here = node >= 0
            for i, cut in enumerate(cuts):
                place = (node[here] * len(cuts) + i) * bins + np.searchsorted(cut, x[here, i])
                sums[0] += np.bincount(place, gradient[here], size)
                sums[1] += np.bincount(place, curvature[here], size)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["at", "g", "h"])

    parts = rows.mapInArrow(add, "at long, g double, h double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    total = np.zeros((2, size))
    for row in parts.collect():
        total[:, row["at"]] = row["g"], row["h"]
    return total.reshape(2, *shape)


def _best_split(gradient: np.ndarray, curvature: np.ndarray, cuts: list[np.ndarray], spec: BoostingSpec) -> tuple[float, int, float] | None:
    """Gain, feature and cut of the best split of a node; equal gains go to the first feature and cut."""
    best = None
    for i, cut in enumerate(cuts):
        if not len(cut):
            continue
        g, h = gradient[i].cumsum(), curvature[i].cumsum()
        whole = g[-1] * g[-1] / (h[-1] + spec.penalty)
        left, right = (g[: len(cut)], h[: len(cut)]), (g[-1] - g[: len(cut)], h[-1] - h[: len(cut)])
        gain = left[0] ** 2 / (left[1] + spec.penalty) + right[0] ** 2 / (right[1] + spec.penalty) - whole
        gain[(left[1] < spec.least_curvature) | (right[1] < spec.least_curvature)] = -np.inf
        at = int(gain.argmax())
        if gain[at] > spec.least_gain and (best is None or gain[at] > best[0]):
            best = (float(gain[at]), i, float(cut[at]))
    return best


def _grow(rows: DataFrame, model: BoostedModel, done: int, cuts: list[np.ndarray], spec: BoostingSpec) -> BoostedTree:
    size = (1 << (spec.depth + 1)) - 1
    tree = BoostedTree([-1] * size, [0.0] * size, [0.0] * size, [0.0] * size)
    open_nodes = {0}
    for level in range(spec.depth + 1):
        if not open_nodes:
            break
        first = (1 << level) - 1
        gradient, curvature = _histogram(rows, model, done, tree, level, cuts)
        following = set()
        for node in sorted(open_nodes):
            g, h = gradient[node - first], curvature[node - first]
            tree.value[node] = float(-spec.rate * g[0].sum() / (h[0].sum() + spec.penalty))
            split = _best_split(g, h, cuts, spec) if level < spec.depth else None
            if split:
                tree.gain[node], tree.feature[node], tree.cut[node] = split
                following |= {2 * node + 1, 2 * node + 2}
        open_nodes = following
    return tree


def _written(rows: DataFrame) -> DataFrame:
    path = scratch_dir(rows.sparkSession, "boosting")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fit(df: DataFrame, spec: BoostingSpec) -> BoostedModel:
    """Trees for rows with a label of 0 or 1; rows without a label are left out. NULL features are NaN."""
    weight = F.col(spec.weight).cast("double") if spec.weight else F.lit(1.0)
    rows = _written(
        df.where(F.col(spec.label).isNotNull()).select(
            *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(spec.features)],
            F.col(spec.label).cast("int").cast("double").alias("label"),
            weight.alias("weight"),
            F.lit(0.0).alias("margin"),
        )
    )
    model, done = BoostedModel(list(spec.features), spec.depth), 0
    if not spec.features or rows.isEmpty():
        return model
    cuts = feature_cuts(rows, len(spec.features), spec.bins)
    for _ in range(spec.trees):
        model.trees.append(_grow(rows, model, done, cuts, spec))
        if len(model.trees) - done >= spec.write_every:
            rows, done = _written(_with_margin(rows, model, done)), len(model.trees)
    return model


def _with_margin(rows: DataFrame, model: BoostedModel, first: int) -> DataFrame:
    names = rows.columns

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column("margin").to_numpy() + model.margins(matrix(batch, model.features), first)
            yield batch.set_column(names.index("margin"), "margin", pa.array(margin))

    return rows.mapInArrow(update, rows.schema)


def predict(df: DataFrame, model: BoostedModel, name: str = "probability") -> DataFrame:
    """The rows, of a table or a stream, with the probability of label 1."""
    features = [F.col(f"`{c}`").cast("double") for c in model.features]

    @F.arrow_udf("double")
    def chance(*columns: pa.Array) -> pa.Array:
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])
        return pa.array(1 / (1 + np.exp(-model.margins(x))))

    return df.withColumn(name, chance(*features) if features else F.lit(0.5))


def importance(spark: SparkSession, model: BoostedModel, top: int = 10) -> DataFrame:
    """The features with most gain, by name."""
    rows = [(name, gain) for name, gain in model.importance().items()]
    return spark.createDataFrame(rows, "feature string, gain double").orderBy(F.desc("gain"), "feature").limit(top)


def to_json(model: BoostedModel) -> str:
    return json.dumps(asdict(model))


def from_json(text: str) -> BoostedModel:
    parts = json.loads(text)
    return BoostedModel(parts["features"], parts["depth"], [BoostedTree(**tree) for tree in parts["trees"]])
