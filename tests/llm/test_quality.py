import random

import numpy as np
import pytest
from corpus import DOCS, clashing, documents, prose
from pyspark.sql import functions as F

from smeltery.llm import quality


def labelled(n=300):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        text = prose(rng, ("en", "de", "es")[i % 3], rng.randint(20, 150))
        if i % 4 == 0:
            text = " ".join(rng.choice(["$$$ BUY", "###", w.upper(), w + "!!!"]) for w in text.split())
        rows.append((i, text, None, "s", i % 4 != 0 and 1 or 0))
    return rows


def test_held_out_auc_and_range(spark):
    docs = spark.createDataFrame(labelled(), DOCS).withColumnRenamed("n_chars", "label")
    featured = quality.with_statistics(docs)
    model = quality.fit(featured.where("doc_id % 3 <> 0"), "label")
    rows = quality.score(featured, model).where("doc_id % 3 = 0").collect()
    good, bad = [r.score for r in rows if r.label == 1], [r.score for r in rows if r.label == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_are_scored(spark):
    docs = clashing(spark)
    featured = quality.with_statistics(docs)
    assert sorted(featured.columns) == sorted([*[c for c in docs.columns if c != "text"], "statistics"])
    train = spark.createDataFrame(labelled(), DOCS).withColumnRenamed("n_chars", "label")
    rows = quality.score(featured, quality.fit(quality.with_statistics(train), "label")).collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (90, 91)}) == 1


@pytest.mark.parametrize(("labels", "expected"), [([], 0.5), ([1, 1], 0.75), ([0, 0, 0], 0.2), ([2, None], 0.5)])
def test_too_few_labels(spark, labels, expected):
    train = spark.createDataFrame([(i, "some text", x) for i, x in enumerate(labels)], "doc_id int, text string, label int")
    model = quality.fit(quality.with_statistics(train), "label")
    rows = quality.score(quality.with_statistics(spark.createDataFrame([(1, "a"), (2, None)], "doc_id int, text string")), model)
    assert [r.score for r in rows.collect()] == pytest.approx([expected] * 2)


def test_density_difference_equals_the_formula(spark):
    featured = quality.with_statistics(spark.createDataFrame(labelled(120), DOCS).withColumnRenamed("n_chars", "label")).cache()
    model = quality.fit(featured, "label")
    rows = featured.collect()
    x, y = np.array([r.statistics for r in rows]), np.array([r.label for r in rows])
    z = (x - model.centre) / model.scale
    logs = []
    for c in (0, 1):
        inverse = model.inverse_factors[c].T @ model.inverse_factors[c]
        away = z - z[y == c].mean(axis=0)
        logs.append(
            -0.5 * np.einsum("ij,jk,ik->i", away, inverse, away) + 0.5 * np.linalg.slogdet(inverse)[1]
            + np.log((np.sum(y == c) + 1) / (len(y) + 2))
        )
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700))), abs=1e-9)


def test_empty_table(spark):
    featured = quality.with_statistics(spark.createDataFrame([], DOCS))
    model = quality.fit(featured.withColumn("label", F.lit(1)), "label")
    assert quality.score(featured, model).count() == 0


def test_statistics_are_finite():
    for text in (None, "", " ", "\n\n", "a", "!" * 100_000, "É" * 10):
        assert np.isfinite(quality.statistics(text)).all() and len(quality.statistics(text)) == len(quality.STATISTICS)
