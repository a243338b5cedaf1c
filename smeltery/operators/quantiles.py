"""Exact quantiles that do not gather a group's values in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of a sketch: it is off by one in so many ranks; and values that are few enough to sort.
SKETCH, FEW = 10_000, 4_096


def binned_quantiles(
    df: DataFrame, group: str, value: Column, shares: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Interpolated quantiles of a value with few distinct levels, such as a rounded share.

    Values are counted per level first, so a group is at most as large as its levels.
    """
    counted = df.groupBy(group, value.alias("__value")).agg(F.count(F.lit(1)).alias("__rows"))
    found = F.percentile("__value", F.array(*map(F.lit, shares)), F.col("__rows"))
    summary = counted.groupBy(group).agg(found.alias("__found"), F.sum("__rows").alias("rows"))
    return summary.select(group, "rows", *[F.col("__found")[i].alias(n) for i, n in enumerate(names)])


@dataclass(frozen=True)
class _Search:
    """Where the value of a rank lies: strictly between two values, after ``before`` smaller ones."""

    column: str
    rank: int
    low: float | None
    high: float | None
    before: int
    size: int

    def inside(self) -> Column:
        value, inside = F.col(self.column), F.col(self.column).isNotNull()
        if self.low is not None:
            inside &= value > self.low
        return inside if self.high is None else inside & (value < self.high)

    def shares(self) -> list[float]:
        """Shares of the values inside between which the rank lies, even if the sketch is off as far as it may be."""
        place, slack = self.rank - self.before, 2.0 / SKETCH
        return [max(0.0, (place - 1) / self.size - slack), min(1.0, place / self.size + slack)]

    def narrowed(self, low: float, high: float, below: int, at_low: int, between: int, at_high: int) -> _Search | float:
        """The value, or a search among the values that can still be it; beside the bracket if it was missed."""
        place = self.rank - self.before
        if place <= below:
            return replace(self, high=low, size=below)
        if place <= below + at_low:
            return low
        if place <= below + at_low + between:
            return replace(self, low=low, high=high, before=self.before + below + at_low, size=between)
        if place <= below + at_low + between + at_high:
            return high
        gone = below + at_low + between + at_high
        return replace(self, low=high, before=self.before + gone, size=self.size - gone)


def ranked_values(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values of given ranks, from 1, among the numbers of a column; all columns in the same passes.

    A sketch brackets each rank, a counting pass tells which side of the bracket it is on, and the
    next sketch sees what is inside only. A pass shrinks the bracket some thousand times; when
    ``FEW`` values are left they are sorted. Sketches and counts are reduced map-side; no value is
    shuffled but those few.
    """
    plain = {c: f"v{i}" for i, c in enumerate(ranks)}
    values = df.select(*[_number(c).alias(v) for c, v in plain.items()])
    sizes = values.agg(*[F.count(v).alias(v) for v in plain.values()]).first()
    todo = [
        _Search(v, r, None, None, 0, sizes[v]) for c, v in plain.items() for r in sorted(set(ranks[c])) if 1 <= r <= sizes[v]
    ]
    found: dict[tuple[str, int], float] = {}
    while todo:
        few = [s for s in todo if s.size <= FEW]
        if few:
            lists = values.agg(*[F.sort_array(F.collect_list(F.when(s.inside(), F.col(s.column)))) for s in few]).first()
            found |= {(s.column, s.rank): held[s.rank - s.before - 1] for s, held in zip(few, lists)}
        todo = [s for s in todo if s.size > FEW]
        if not todo:
            break
        sketches = [F.percentile_approx(F.when(s.inside(), F.col(s.column)), s.shares(), SKETCH) for s in todo]
        brackets = values.agg(*sketches).first()
        counts = []
        for s, (low, high) in zip(todo, brackets):
            value, inside = F.col(s.column), s.inside()
            for part in (value < low, value == low, (value > low) & (value < high), (value == high) & F.lit(high > low)):
                counts.append(F.count_if(inside & part))
        counted = values.agg(*counts).first()
        moved = [s.narrowed(*brackets[i], *counted[4 * i : 4 * i + 4]) for i, s in enumerate(todo)]
        found |= {(s.column, s.rank): value for s, value in zip(todo, moved) if not isinstance(value, _Search)}
        todo = [s for s in moved if isinstance(s, _Search)]
    return {(c, r): found[v, r] for c, v in plain.items() for r in ranks[c] if (v, r) in found}


def _number(column: str) -> Column:
    """A column as a number, NaN as NULL."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per numeric column, the mean of the middle two of an even number.

    NULL and NaN are no values; a column without any has no median. Runs jobs: a median is what a
    model is fitted with.
    """
    sizes = dict(zip(columns, df.agg(*[F.count(_number(c)) for c in columns]).first() if columns else ()))
    middle = {c: [(size + 1) // 2, (size + 2) // 2] for c, size in sizes.items() if size}
    found = ranked_values(df, middle) if middle else {}
    return {c: (found[c, low] + found[c, high]) / 2 for c, (low, high) in middle.items()}


def filled(column: str, median: float | None) -> Column:
    """A column as a number, with NULL and NaN replaced by the median; without one they are NULL."""
    return F.coalesce(_number(column), F.lit(median).cast("double"))


def fill_with_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN replaced by the column's median; a column without any value stays NULL."""
    found = medians(df, columns)
    return df.withColumns({name: filled(name, found.get(name)) for name in columns})
