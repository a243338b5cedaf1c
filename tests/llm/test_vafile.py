import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.llm import vafile

SCHEMA = "vec_id long, embedding array<float>, id string, v string, cells string"


def plain(rows, query_rows, k):
    """Every query against every row."""

    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [math.floor(64 * float(np.float32(x))) for x in vector]

    vectors = [(r[0], whole(r[1])) for r in rows if r[0] is not None and whole(r[1]) is not None]
    expected = []
    for query in {r[0]: whole(r[1]) for r in query_rows if r[0] is not None and whole(r[1]) is not None}.items():
        scores = [
            (-sum(a * b for a, b in zip(query[1], v)), name) for name, v in vectors if name != query[0] and len(v) == len(query[1])
        ]
        expected += [(query[0], i + 1, name, -score) for i, (score, name) in enumerate(sorted(scores)[:k])]
    return sorted(expected)


def vectors(seed=1, n=300, size=6, spread=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, spread, size)]) for i in range(n)]
    rows += [(n, None), (n + 1, [1.0] * (size - 1) + [None]), (n + 2, [float("nan")] * size), (n + 3, [float("inf")] + [0.0] * (size - 1))]
    rows += [(None, [9.0] * size), (n + 4, []), (n + 20, []), (n + 5, [1.0, 2.0]), (n + 40, [2.0, -1.0]), (3, rows[3][1]), (4, rows[5][1])]
    return rows


def run(spark, rows, k, wanted="vec_id % 20 = 0", parts=4):
    frame = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA).repartition(parts)
    found = vafile.top_k(frame, frame.where(wanted), k).collect()
    return sorted((r.query_id, r["rank"], r["id"], r.score) for r in found)


@pytest.mark.parametrize(("k", "spread", "blocks"), [(5, 1.0, 4096), (20, 0.02, 4096), (400, 1.0, 4096), (3, 100.0, 3)])
def test_equals_brute_force(spark, monkeypatch, k, spread, blocks):
    monkeypatch.setattr(vafile, "QUERY_BLOCK", blocks)
    monkeypatch.setattr(vafile, "ROW_BLOCK", 40)
    rows = vectors(spread=spread)
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    assert run(spark, rows, k) == plain(rows, queries, k)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100)]
    assert run(spark, rows, 3, "vec_id = 40") == [(40, 1, 0, 4096), (40, 2, 1, 4096), (40, 3, 2, 4096)]


def test_empty_tables(spark):
    assert run(spark, [], 3) == []
    assert run(spark, vectors(), 3, "vec_id < 0") == []


def test_bounds_hold(spark):
    rng = np.random.default_rng(4)
    rows = rng.integers(-300, 300, (200, 8))
    frame = spark.createDataFrame([(r.tolist(),) for r in rows], "v array<long>")
    grid = vafile.fit_grid(frame)
    queries = rng.integers(-300, 300, (10, 8))
    above, below = grid.bounds(grid.cells(rows), queries)
    exact = queries @ rows.T
    assert (below <= exact).all() and (exact <= above).all()


def test_floor_of_components(spark):
    row = spark.createDataFrame([([0.5, -0.001, 1.0],)], "e array<float>").select(vafile.integer_vectors(F.col("e")).alias("v")).first()
    assert row.v == [32, -1, 64]
