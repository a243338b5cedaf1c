"""Exact top-k by inner product with a vector-approximation file.

Every component of every vector is quantised into cells of equal width between the component's
extremes. For a query, the cells bound each vector's score from above and below; tasks scan the
cells of their rows, keep per query the rows whose upper bound reaches the k-th largest lower
bound, and read those rows' exact vectors in order of falling upper bound until the k-th exact
score is at least the next bound. The tasks' best rows meet in one aggregation per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.common import slices, stored

#: Queries searched together, rows bounded together, and cells per component.
QUERY_BLOCK, ROW_BLOCK, CELLS = 4096, 2048, 64


def integer_vectors(column: Column, factor: float = 64.0) -> Column:
    """floor(factor * x) of every component, NULL if the vector or a component is NULL or not finite."""
    sound = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.when(column.isNotNull() & sound, F.transform(column, lambda x: F.floor(x.cast("double") * factor).cast("long")))


@dataclass
class Grid:
    """Per length of the vectors: lowest value and cell width of each component."""

    low: dict[int, np.ndarray]
    width: dict[int, np.ndarray]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        n = vectors.shape[1]
        return np.minimum((vectors - self.low[n]) // self.width[n], CELLS - 1).astype(np.uint8)

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest and smallest possible scores, queries by rows.

        A cell holds the whole numbers from its start to just below the next cell's start.
        """
        n = cells.shape[1]
        reach = (self.width[n] - 1) / 2
        wide = queries.astype(np.float64)
        middle = wide @ (self.low[n] + cells * self.width[n].astype(np.float64) + reach).T
        spread = (np.abs(wide) @ reach + 1e-9 * (1 + np.abs(middle).max(initial=0)))[:, None]
        return middle + spread, middle - spread


def fit_grid(vectors: DataFrame) -> Grid:
    """The extremes of every component over all rows; one row per length reaches the driver."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, _, values in _by_length(batch, "v"):
                both = np.stack([values.min(axis=0), values.max(axis=0)])
                if n in found:
                    both = np.stack([np.minimum(found[n][0], both[0]), np.maximum(found[n][1], both[1])])
                found[n] = both
        for n, both in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(both[0]), pa.array(both[1])],
                names=["n", "at", "low", "high"],
            )

    parts = vectors.select("v").mapInArrow(extremes, "n int, at int, low long, high long")
    low, width = {0: np.zeros(0, np.int64)}, {0: np.zeros(0, np.int64)}
    for row in parts.groupBy("n", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        low.setdefault(row.n, np.zeros(row.n, np.int64))[row.at] = row.low
        width.setdefault(row.n, np.ones(row.n, np.int64))[row.at] = -(-(row.high - row.low + 1) // CELLS)
    return Grid(low, width)


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of a batch as one integer matrix per length, with their row numbers."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield n, rows, flat[starts[rows, None] + np.arange(n)].reshape(len(rows), n)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _scan(grid: Grid, batches: Iterator[pa.RecordBatch], blocks: dict, k: int):
    """Per query the task's best rows: ``(query, id, score)`` arrays."""
    empty = np.zeros(0, np.int64)
    best = {n: [(empty, empty) for _ in ids] for n, (ids, _) in blocks.items()}
    least = {n: np.full(len(ids), -np.inf) for n, (ids, _) in blocks.items()}
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        cells = {n: values for n, _, values in _by_length(batch, "cells")}
        for n, rows, exact in _by_length(batch, "v"):
            if n not in blocks:
                continue
            query_ids, queries = blocks[n]
            for part in slices(len(rows), ROW_BLOCK):
                own, vectors = ids[rows[part]], exact[part]
                above, below = grid.bounds(cells[n][part], queries)
                enough = least[n]
                if len(own) > k:
                    enough = np.maximum(enough, np.partition(below, len(own) - k - 1, axis=1)[:, len(own) - k - 1])
                for at in np.flatnonzero(above.max(axis=1) >= enough).tolist():
                    scores, names = best[n][at]
                    wanted = np.flatnonzero((above[at] >= enough[at]) & (own != query_ids[at]))
                    wanted = wanted[np.argsort(-above[at, wanted], kind="stable")]
                    for step in slices(len(wanted), 4 * k):
                        if len(scores) == k and above[at, wanted[step.start]] < scores[-1]:
                            break
                        read = wanted[step]
                        scores = np.concatenate([scores, vectors[read] @ queries[at]])
                        scores, names = _best(scores, np.concatenate([names, own[read]]), k)
                    best[n][at] = (scores, names)
                    if len(scores) == k:
                        least[n][at] = scores[-1]
    for n, (query_ids, _) in blocks.items():
        for at, (scores, names) in enumerate(best[n]):
            if len(names):
                yield np.full(len(names), query_ids[at]), names, scores


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    factor: float = 64.0,
) -> DataFrame:
    """``query_id, rank, id, score`` of every query's ``k`` best other rows, all if there are fewer.

    Both tables give integer vectors by ``floor(factor * x)``; rows whose id or vector is NULL or
    holds a NULL or a component that is not finite take no part. Scores are inner products and
    must fit 64 bits. Ties go to the smaller id. A query is compared with vectors of its own
    length, and never with rows of its own id. Repeated rows are candidates each; repeated
    query ids are answered once. Queries are searched in blocks of ``QUERY_BLOCK``, the only part
    of the data that is sent to all tasks; the stored file of cells and vectors is scanned once
    per block.
    """
    spark = vectors.sparkSession

    def integers(df: DataFrame) -> DataFrame:
        made = df.select(F.col(id_column).cast("long").alias("id"), integer_vectors(F.col(vector_column), factor).alias("v"))
        return made.where("id is not null and v is not null")

    rows = integers(vectors)
    grid = fit_grid(rows)
    shared = spark.sparkContext.broadcast(grid)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            for _, at, values in _by_length(batch, "v"):
                for row, own in zip(at.tolist(), shared.value.cells(values)):
                    cells[row] = own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int16()))], names=["id", "v", "cells"]
            )

    file = stored(rows.mapInArrow(approximate, "id long, v array<long>, cells array<short>"), "va-file")
    asked = stored(integers(queries).groupBy("id").agg(F.first("v").alias("v")), "va-queries")
    number = asked.count()
    blocks = -(-number // QUERY_BLOCK)
    result = None
    for at in range(max(blocks, 1)):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1))) == at).toPandas()
        by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(v) for v in block["v"]}:
            own = block[block["v"].map(len) == n]
            by_length[n] = own["id"].to_numpy(np.int64), np.array(own["v"].tolist(), np.int64).reshape(len(own), n)
        here = _search(file, grid, by_length, k)
        result = here if result is None else result.union(here)
    return result


def _search(file: DataFrame, grid: Grid, blocks: dict, k: int) -> DataFrame:
    shared = file.sparkSession.sparkContext.broadcast((grid, blocks))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, blocks = shared.value
        for query, ids, scores in _scan(grid, batches, blocks, k):
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(scores)], names=["query_id", "id", "score"])

    found = file.mapInArrow(scan, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
