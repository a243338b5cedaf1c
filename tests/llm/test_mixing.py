from collections import Counter

import numpy as np
import pytest
from corpus import DOCS, clashing, documents
from pyspark.sql import functions as F

import corpus_pipeline
from smeltery.llm import mixing
from smeltery.llm.common import word_count

SIZED = "doc_id long, source string, size long"


def plain_targets(sizes):
    """Targets by giving the excess again and again to the sources below their limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s for s in rest if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in full else share[s] for s in order}
        full |= above


def rows_of(seed, n, sources):
    rng = np.random.default_rng(seed)
    return [(i, str(rng.choice(sources)), int(rng.integers(1, 400))) for i in range(n)]


@pytest.mark.parametrize(("block", "amiss"), [(4096, 2), (16, 200)])
def test_targets_are_met(spark, monkeypatch, block, amiss):
    """A last block of few documents can be half a document amiss."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = rows_of(3, 1500, ["a", "b", "b", "b", "c", "d", "e"]) + [(None, None, 50), (None, None, 60), (7, None, None), (8, "z", 0)]
    found = mixing.mix(spark.createDataFrame(rows, SIZED)).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size or 0
    targets, taken = plain_targets(sizes), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * (r["size"] or 0)
    for source in sizes:
        if source is not None:
            assert abs(taken[source] - targets[source]) <= amiss


def test_reruns_and_other_splits_agree(spark):
    rows = rows_of(4, 400, ["a", "b", "c"])
    docs = spark.createDataFrame(rows, SIZED)
    once = Counter(mixing.mix(docs).collect())
    assert once == Counter(mixing.mix(docs.repartition(7)).collect())


def test_equal_rows_share_what_they_take(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 64)
    rows = [(1, "a", 10)] * 500 + [(i, "b", 10) for i in range(500)] + [(2, "c", 10)] * 500
    found = mixing.mix(spark.createDataFrame(rows, SIZED)).collect()
    assert len(found) == 1500
    taken = Counter()
    for r in found:
        taken[r.source] += r.copies * 10
    targets = plain_targets(Counter(a=5000, b=5000, c=5000))
    assert all(abs(taken[s] - targets[s]) <= 10 for s in targets)


def test_clashing_columns_and_copies(spark):
    docs = clashing(spark).withColumn("size", word_count(F.col("text")))
    mixed = mixing.mix(docs)
    assert sorted(mixed.columns) == sorted([*docs.columns, "source_size"])
    out = mixing.take(mixed, docs.columns)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixed.collect())


def test_empty_table_and_no_words(spark):
    docs = spark.createDataFrame(rows_of(1, 3, ["a"]), SIZED)
    assert mixing.mix(docs.limit(0)).count() == 0
    none = mixing.mix(docs.withColumn("size", F.lit(0))).collect()
    assert [(r.source_size, r.target, r.copies) for r in none] == [(0, 0.0, 0)] * 3


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(2)
    size = rng.integers(0, 500, 400).astype(float).tolist()
    chance = [0.37] * 400
    flown = mixing.flight(chance, size, rng.random(400))
    assert sum(0 < c < 1 for c in flown) <= 2
    assert sum(flown) == pytest.approx(sum(chance)) and np.dot(flown, size) == pytest.approx(np.dot(chance, size))
    assert set(mixing.landing(flown, size)) <= {0.0, 1.0}


def test_inclusion_chances_hold_on_average():
    rng = np.random.default_rng(3)
    size = [5.0, 9.0, 2.0, 7.0, 4.0, 1.0]
    mean = np.mean([mixing.flight([0.3] * 6, size, rng.random(6)) for _ in range(4000)], axis=0)
    assert mean == pytest.approx([0.3] * 6, abs=0.03)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\x0b b\t\nc ", "é x", "a" * 10_000 + " b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r.n for r in rows.select("i", word_count(F.col("t")).alias("n")).orderBy("i").collect()]
    assert found == [len((t or "").encode().split()) for t in texts]


def test_drawn_is_take_of_mix_and_stores_no_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 4)
    seen = []
    stored = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, purpose: seen.append(df) or stored(df, purpose))
    docs = spark.createDataFrame(documents(), DOCS)
    often = docs.where("doc_id = 7").withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(9)))).drop("_n")
    docs = docs.union(docs.where("doc_id < 5")).union(often)
    drawn = mixing.drawn(docs, word_count(F.col("text")))
    assert seen and not any({"_row", "text"} & set(df.columns) for df in seen)
    taken = mixing.take(mixing.mix(docs.withColumn("_words", word_count(F.col("text"))), size_column="_words"), docs.columns)
    assert drawn.columns == docs.columns
    named = clashing(spark)
    assert mixing.drawn(named, word_count(F.col("text"))).columns == named.columns
    assert Counter(map(str, drawn.collect())) == Counter(map(str, taken.collect()))


def test_the_pipeline_stores_no_texts_while_mixing(spark, monkeypatch):
    seen = []
    stored = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, purpose: seen.append(df.schema.simpleString()) or stored(df, purpose))
    assert corpus_pipeline.source_mix(spark, spark.createDataFrame(documents(), DOCS), "").count()
    assert seen and not any("text" in schema for schema in seen)
