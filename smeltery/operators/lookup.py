"""Dimension lookups that keep every fact row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def add_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Left join of the listed dimension columns on a key that is unique in the dimension.

    Nothing is read to choose the join: adaptive execution broadcasts the dimension when its
    bytes are known to be few, and else splits partitions that a frequent key makes too large.

    A column both sides have is kept once: the dimension's value, or the fact's where the
    dimension has none.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shared = [name for name in columns if name in facts.columns]
    renamed = {name: f"__dim_{name}" for name in shared}
    side = dimension.select(*keys, *columns).withColumnsRenamed(renamed)
    joined = facts.join(side, keys, "left")
    merged = joined.withColumns({name: F.coalesce(renamed[name], name) for name in shared})
    return merged.drop(*renamed.values())


def orphan_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of the fact table that the dimension does not have, with their row counts.

    Facts are counted per key before the join, so a frequent key is one row in it.
    """
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti")
