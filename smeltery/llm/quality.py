"""Quality scores by regularised quadratic discriminant analysis of document statistics.

Each class is a normal density over transformed statistics of the text. Covariances are shrunk
towards the pooled covariance and its diagonal; the Cholesky factors are computed once and sent
to the tasks, where the score is the logistic of the difference of the two log densities plus
the log odds of the classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import with_columns_of

#: Weight of the pooled covariance, and of its diagonal, in a class covariance; smallest variance.
POOLED, DIAGONAL, FLOOR = 0.3, 0.1, 1e-4
STATISTICS = (
    "words", "word_length", "letters", "upper", "digits", "marks", "symbols", "spaces", "distinct_words",
    "top_word", "lines", "line_length", "distinct_lines", "short_words", "long_words", "doubled", "entropy", "marked_words",
)

_UPPER, _LOWER, _DIGIT = np.arange(0x41, 0x5B), np.arange(0x61, 0x7B), np.arange(0x30, 0x3A)
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_MARK = np.frombuffer(b".,;:!?'\"()-", np.uint8)
_SYMBOL = np.setdiff1d(np.arange(33, 127), np.concatenate([_UPPER, _LOWER, _DIGIT, _MARK]))


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of a whole text; of the empty text for NULL.

    Counts and lengths become logarithms, shares the arcsine of their root.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    view = np.frombuffer(data, np.uint8)
    bytes_of = np.bincount(view, minlength=256)
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    n, n_words, n_lines = max(len(data), 1), max(len(words), 1), max(len(lines), 1)
    seen = bytes_of[bytes_of > 0] / n
    first = sum(word[0] in _FIRST_LETTERS for word in counts.elements()) if words else 0
    shares = np.array(
        [
            (bytes_of[_UPPER].sum() + bytes_of[_LOWER].sum() + bytes_of[128:].sum()) / n,
            bytes_of[_UPPER].sum() / n,
            bytes_of[_DIGIT].sum() / n,
            bytes_of[_MARK].sum() / n,
            bytes_of[_SYMBOL].sum() / n,
            bytes_of[_SPACE].sum() / n,
            len(counts) / n_words,
            max(counts.values(), default=0) / n_words,
            len(set(lines)) / n_lines,
            (lengths <= 3).sum() / n_words,
            (lengths >= 12).sum() / n_words,
            (view[1:] == view[:-1]).sum() / n,
            first / n_words,
        ]
    )
    letters, upper, digits, marks, symbols, spaces, distinct, top, own_lines, short, long, doubled, first = np.arcsin(
        np.sqrt(np.clip(shares, 0, 1))
    )
    log = np.log1p
    return np.array(
        [
            log(len(words)), log(lengths.mean() if words else 0), letters, upper, digits, marks, symbols, spaces, distinct,
            top, log(len(lines)), log(len(data) / n_lines), own_lines, short, long, doubled,
            float(-(seen * np.log(seen)).sum()), first,
        ]
    )


_FIRST_LETTERS = frozenset([*_UPPER.tolist(), *_LOWER.tolist(), *range(128, 256)])


def with_statistics(docs: DataFrame, text_column: str = "text", column: str = "statistics") -> DataFrame:
    """The rows of ``docs`` with an array of :data:`STATISTICS` in place of the text."""
    kept = [c for c in docs.columns if c not in (text_column, column)]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(text.as_py()) for text in batch.column("_read")]
            yield with_columns_of(batch, kept, **{column: pa.array(values, pa.list_(pa.float64()))})

    schema = docs.select(*kept).withColumn(column, F.array(F.lit(0.0))).schema
    return docs.select(*kept, F.col(text_column).cast("string").alias("_read")).mapInArrow(compute, schema)


@dataclass
class Discriminant:
    """Scaling, and per class (0, 1) the mean, inverse Cholesky factor, log determinant, log prior."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]
    offsets: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(values), 1 / (1 + np.exp(self.offsets[0] - self.offsets[1])))
        scaled = (values - self.centre) / self.scale
        density = [
            offset - 0.5 * (((scaled - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.inverse_factors, self.offsets)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(featured: DataFrame, label_column: str, column: str = "statistics") -> Discriminant:
    """Fit on every row whose label is 0 or 1; other labels and NULL are not used.

    Only sums, products and counts per class reach the driver. Without rows of both classes the
    score is the smoothed share of class 1, 0.5 for no rows at all.
    """
    size = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            values = np.array(batch.column("x").to_pylist(), np.float64).reshape(len(labels), size)
            for c in (0, 1):
                x = values[labels == c]
                total[c] += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * total.shape[1]), pa.array(range(total.shape[1])), pa.array(total[c])], names=["c", "at", "v"]
            )

    label = F.col(label_column).cast("int")
    rows = featured.where(label.isin(0, 1)).select(label.alias("label"), F.col(column).alias("x"))
    moments = np.zeros((2, 1 + size + size * size))
    for row in rows.mapInArrow(sums, "c long, at long, v double").groupBy("c", "at").agg(F.sum("v").alias("v")).collect():
        moments[row.c, row.at] = row.v
    counts, first, second = moments[:, 0], moments[:, 1 : 1 + size], moments[:, 1 + size :].reshape(2, size, size)
    prior = np.log((counts + 1) / (counts.sum() + 2))
    if counts.min() < 2:
        return Discriminant(np.zeros(size), np.ones(size), [], [], prior)
    means = first / counts[:, None]
    spread = [second[c] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = sum(counts[c] * spread[c] for c in (0, 1)) / counts.sum()
    centre, scale = first.sum(axis=0) / counts.sum(), np.sqrt(np.maximum(np.diag(pooled), FLOOR))
    pooled = pooled / np.outer(scale, scale)
    target = (1 - DIAGONAL) * pooled + DIAGONAL * np.diag(np.diag(pooled))
    factors, offsets = [], []
    for c in (0, 1):
        own = spread[c] / np.outer(scale, scale)
        factor = np.linalg.cholesky((1 - POOLED) * own + POOLED * target + FLOOR * np.eye(size))
        factors.append(np.linalg.inv(factor))
        offsets.append(prior[c] - np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, [(m - centre) / scale for m in means], factors, np.array(offsets))


def score(featured: DataFrame, model: Discriminant, column: str = "statistics") -> DataFrame:
    """All rows of ``featured`` with ``score`` (0 to 1) in place of the statistics.

    NULL and empty texts are scored like any other. Repeated rows stay; an input column named
    ``score`` is replaced; an empty table gives an empty result.
    """
    kept = [c for c in featured.columns if c not in (column, "score")]
    shared = featured.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column(column).to_pylist(), np.float64).reshape(batch.num_rows, len(STATISTICS))
            yield with_columns_of(batch, kept, score=pa.array(shared.value.score(values)))

    schema = featured.select(*kept).withColumn("score", F.lit(0.0)).schema
    return featured.select(*kept, column).mapInArrow(compute, schema)
