import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.operators import boosting


def rows(seed=1, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y, z = rng.randint(0, 9), rng.choice([None, float("nan"), rng.gauss(0, 1)]), rng.random()
        out.append((i, x, y, z, int((x > 5) ^ (z > 0.7) or rng.random() < 0.1), rng.choice([1.0, 2.0])))
    return out


def plain(data, spec, cuts):
    """Row by row, with the same cuts: margins, then the best split of each node by its gain."""
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in data], float)
    label, weight = np.array([r[4] for r in data], float), np.array([r[5] for r in data])
    margin = np.zeros(len(data))
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - label) * weight, p * (1 - p) * weight
        move = np.zeros(len(data))

        def grow(mine, depth):
            def worth(part):
                return g[part].sum() ** 2 / (h[part].sum() + spec.penalty)

            best = (spec.least_gain, None)
            for i, cut in [(i, c) for i in range(3) for c in cuts[i]] if depth < spec.depth else []:
                left = mine & (x[:, i] <= cut)
                right = mine & ~left
                if min(h[left].sum(), h[right].sum()) >= spec.least_curvature:
                    gain = worth(left) + worth(right) - worth(mine)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
            if best[1] is None:
                move[mine] = -spec.rate * g[mine].sum() / (h[mine].sum() + spec.penalty)
            else:
                for part in best[1]:
                    grow(part, depth + 1)

        grow(np.ones(len(data), bool), 0)
        margin += move
    return 1 / (1 + np.exp(-margin))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "id int, x int, `y.z` double, z double, label int, w double").repartition(5)


SPEC = boosting.BoostingSpec(("x", "y.z", "z"), "label", "w", trees=5, depth=3, rate=0.5, bins=16, write_every=2)


def test_rounds_equal_a_plain_computation(spark, table):
    model = boosting.fit(table, SPEC)
    kept = table.select(F.col("x").cast("double").alias("x0"), F.col("`y.z`").alias("x1"), F.col("z").alias("x2"))
    expected = plain(rows(), SPEC, boosting.feature_cuts(kept, 3, 16))
    scored = boosting.predict(table, model)
    found = {r["id"]: r["probability"] for r in scored.collect()}
    assert [found[i] for i in range(400)] == pytest.approx(expected.tolist(), abs=1e-9)
    good, bad = ([found[r[0]] for r in rows() if r[4] == c] for c in (1, 0))
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.85


def test_model_survives_as_text_and_names_gains(spark, table):
    model = boosting.fit(table, SPEC)
    assert boosting.from_json(boosting.to_json(model)) == model
    gains = {r["feature"]: r["gain"] for r in boosting.importance(spark, model).collect()}
    assert set(gains) == set(SPEC.features) and gains["x"] > gains["y.z"]
    nodes = model.nodes(spark)
    assert nodes.agg(F.sum("gain")).first()[0] == pytest.approx(sum(gains.values()))
    assert nodes.where("feature IS NULL AND gain > 0").count() == 0


@pytest.mark.parametrize("data", [[], [(1, 2.0, 1)], [(i, None, i % 2) for i in range(9)], [(i, 1.0, None) for i in range(9)]])
def test_tables_without_a_split(spark, data):
    frame = spark.createDataFrame(data, "id int, x double, label int")
    model = boosting.fit(frame, boosting.BoostingSpec(("x",), "label", trees=2, depth=2))
    assert model.importance() == {"x": 0.0}
    assert all(0 < r["probability"] < 1 and math.isfinite(r["probability"]) for r in boosting.predict(frame, model).collect())


def test_few_values_are_all_cuts(spark):
    frame = spark.range(1000).select((F.col("id") % 5).cast("double").alias("x0"), F.col("id").cast("double").alias("x1"))
    few, many = boosting.feature_cuts(frame, 2, 16)
    assert few.tolist() == [0.0, 1.0, 2.0, 3.0] and 10 <= len(many) <= 15
