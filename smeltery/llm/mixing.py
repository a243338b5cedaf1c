"""Mixing sources to target weights by balanced sampling with the cube method.

A document of a source whose target is r times its size is taken floor(r) times for certain and
once more with probability r - floor(r). The cube method decides on all the once-mores of a
source together: in its flight phase it moves the probabilities along null-space directions of
the balance equations (number of documents, number of words) until almost all are 0 or 1, so
that both totals stay what they were. It runs in blocks; each leaves as many undecided documents
as there are equations, and these meet in the blocks of the next round, until one block per
source is left, whose few open documents are landed on the outcome closest in words.
"""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.common import stored

#: Weights of the sources in turn, size of the mix, most repeats of a source.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Documents in a block, equal rows written at once, and how far from 0 or 1 counts as decided.
BLOCK, PART, NEAR = 4096, 1024, 1e-9


def source_targets(
    sizes: DataFrame, source_column: str, size_column: str, weights=WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    Sources in order of code points, NULL last, weigh ``weights`` in turn. Targets share
    ``share`` of all sizes by weight and stop at ``most`` times the source's size; the excess
    goes to the others by weight until none is above. Then each target is the smaller of its
    limit and weight times one common level. The level follows from running sums over sources
    in order of limit per weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col(source_column).isNull(), F.col(source_column))
    totals = sizes.groupBy(source_column).agg(F.sum(size_column).cast("long").alias("source_size"))
    place = F.row_number().over(by_name) - 1
    weighed = totals.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * most
    order = Window.orderBy(limit / F.col("weight"), F.col(source_column).isNull(), F.col(source_column))
    before, up_to = order.rowsBetween(Window.unboundedPreceding, -1), everything
    open_words = F.sum("source_size").over(up_to) * share - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(up_to) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = weighed.withColumn("level", open_words / open_weight)
    fits = F.col("level") * F.col("weight") <= limit
    level = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(limit, F.coalesce(level * F.col("weight"), limit))
    return levelled.select(source_column, "source_size", target.alias("target"))


def _direction(x: float, y: float, z: float) -> tuple[float, float, float]:
    """A direction in which three units move without changing their number or their words."""
    way = (z - y, x - z, y - x)
    longest = max(map(abs, way))
    return tuple(w / longest for w in way) if longest else (1.0, -1.0, 0.0)


def flight(chance: list[float], size: list[float], draws: np.ndarray) -> list[float]:
    """Move the chances until at most two are open; sums of chances and of words stay.

    Units join in the given order. Three open units have one more freedom than there are balance
    equations, so they can move along a null-space direction until one of them is 0 or 1; which
    end it moves to is drawn so that its expected chance stays.
    """
    chance = [0.0 if c < NEAR else 1.0 if c > 1 - NEAR else c for c in chance]
    pool: list[int] = []
    step = 0
    for unit in range(len(chance)):
        if not 0.0 < chance[unit] < 1.0:
            continue
        pool.append(unit)
        if len(pool) < 3:
            continue
        way = _direction(*(size[i] for i in pool))
        moving = [(chance[i], w) for i, w in zip(pool, way) if abs(w) > 1e-12]
        up = min((1 - c) / w if w > 0 else c / -w for c, w in moving)
        down = min(c / w if w > 0 else (1 - c) / -w for c, w in moving)
        far = up if draws[step] * (up + down) < down else -down
        step += 1
        for i, w in zip(pool, way):
            moved = chance[i] + far * w
            chance[i] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved
        pool = [i for i in pool if 0.0 < chance[i] < 1.0]
    return chance


def landing(chance: list[float], size: list[float]) -> list[float]:
    """Decide the last open units, two at most, so that words come closest to what is due.

    What is still amiss then is corrected by turning over the two decided units (one, or none)
    whose words cancel it best.
    """
    at = [i for i, c in enumerate(chance) if 0.0 < c < 1.0]
    if not at:
        return chance
    due = sum(chance[i] * size[i] for i in at)
    best = min(product((0.0, 1.0), repeat=len(at)), key=lambda x: abs(sum(v * size[i] for v, i in zip(x, at)) - due))
    result = np.array(chance)
    result[at] = best
    sizes = np.array(size)
    amiss = float(np.dot(best, sizes[at])) - due
    change = np.append(np.where(result == 1.0, -sizes, sizes), [0.0, 0.0])
    order = np.argsort(change, kind="stable")
    ordered = change[order]
    wanted = np.searchsorted(ordered, -amiss - ordered)
    choices = []
    for shift in (-2, -1, 0, 1):
        other = np.clip(wanted + shift, 0, len(ordered) - 1)
        left = np.where(other == np.arange(len(ordered)), np.inf, np.abs(amiss + ordered + ordered[other]))
        first = int(left.argmin())
        choices.append((float(left[first]), int(order[first]), int(order[other[first]])))
    for unit in min(choices)[1:]:
        if unit < len(result):
            result[unit] = 1.0 - result[unit]
    return result.tolist()


def _decide(units: DataFrame, seed: int) -> DataFrame:
    """``_key, _check, _more`` (0 or 1) for units with ``_source, _size, _chance``.

    Round by round the open units of a source meet in fewer blocks; the last has one.
    """

    def fly(last: bool, number: int):
        def block(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["_size", "_key", "_check"], ascending=[False, True, True])
            name = f"{seed}|{number}|{group['_source'].iloc[0]}|{group['_block'].iloc[0]}"
            draws = np.random.default_rng(zlib.crc32(name.encode("utf-8", "surrogatepass"))).random(len(group))
            size = group["_size"].astype(float).tolist()
            chance = flight(group["_chance"].tolist(), size, draws)
            return group.assign(_chance=landing(chance, size) if last else chance)

        return block

    done, number = None, 0
    while True:
        is_open = (F.col("_chance") > 0) & (F.col("_chance") < 1)
        counts = units.where(is_open).groupBy("_source").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
        counts = stored(counts.withColumnRenamed("_source", "_of"), "mix-blocks")
        most = counts.agg(F.max("_blocks")).first()[0]
        decided = units.where(~is_open).select("_key", "_check", F.col("_chance").cast("int").alias("_more"))
        done = decided if done is None else done.union(decided)
        if most is None:
            return done
        placed = (
            units.where(is_open)
            .join(counts, F.col("_source").eqNullSafe(F.col("_of")))
            .select(*units.columns, F.pmod(F.xxhash64(F.lit(seed), "_key", "_check"), "_blocks").alias("_block"))
        )
        flown = placed.groupBy("_source", "_block").applyInPandas(fly(most == 1, number), placed.schema)
        units = stored(flown.select(*units.columns), "mix-flight")
        number += 1


def mix(
    docs: DataFrame,
    source_column: str = "source",
    size_column: str = "size",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 7,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``source_size``, ``target`` and ``copies``.

    ``copies`` is how often the mix takes the row, ``most`` rounded up at the most. A NULL size
    counts as 0; NULL is a source. Equal rows are one unit that is taken a number of times, so
    neither a hot source nor a hot row meets in one task, and the result depends on the rows and
    the seed alone. Sources without words take nothing. Input columns with the names of the
    result are replaced; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    rows = docs.select(F.xxhash64(row).alias("_key"), F.xxhash64(F.lit(seed), row).alias("_check"), row.alias("_row"))
    same = stored(rows.groupBy("_key", "_check").agg(F.first("_row").alias("_row"), F.count("*").alias("_rows")), "mix-rows")
    units = same.select(
        "_key",
        "_check",
        "_rows",
        F.col("_row").getField(source_column).cast("string").alias("_source"),
        F.coalesce(F.col("_row").getField(size_column), F.lit(0)).cast("long").alias("_size"),
    )
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("_rows") - 1) / PART)))
    taken = _taken(units, weights, share, most, seed).select(
        "_key", "_check", "source_size", "target", "_taken", parts.alias("_part")
    )
    dealt = same.join(taken, ["_key", "_check"])
    first = F.col("_part") * PART
    number = F.explode(F.sequence(first, F.least(first + PART, F.col("_rows")) - 1))
    dealt = dealt.select("_row", "source_size", "target", "_taken", "_rows", number.alias("_number"))
    copies = F.floor(F.col("_taken") / F.col("_rows")) + (F.col("_number") < F.col("_taken") % F.col("_rows")).cast("long")
    return dealt.select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "source_size", "target", copies.cast("long").alias("copies")
    )


def _taken(units: DataFrame, weights, share: float, most: float, seed: int) -> DataFrame:
    """``units`` of equal rows with ``source_size``, ``target`` and how many rows the mix takes, ``_taken``."""
    words = units.select(F.col("_source").alias("_of"), (F.col("_size") * F.col("_rows")).alias("_words"))
    targets = stored(source_targets(words, "_of", "_words", weights, share, most), "mix-targets")
    expected = F.col("_rows") * F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    units = units.join(targets, F.col("_source").eqNullSafe(F.col("_of"))).select(
        "_key", "_check", "_source", "_size", "_rows", "source_size", "target",
        F.floor(expected + NEAR).alias("_sure"), F.greatest(expected - F.floor(expected + NEAR), F.lit(0.0)).alias("_chance"),
    )
    units = stored(units, "mix-units")
    more = _decide(units.select("_key", "_check", "_source", "_size", "_chance"), seed)
    return units.join(more, ["_key", "_check"]).withColumn("_taken", F.col("_sure") + F.col("_more"))


def drawn(
    docs: DataFrame,
    size: Column,
    source_column: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 7,
) -> DataFrame:
    """The documents of the mix of ``docs`` whose sizes are ``size``, every row as often as it is taken.

    The same as :func:`mix` followed by :func:`take`, but whole rows move once, to meet what was
    decided on their hashes, and are not stored in between.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashes = [F.xxhash64(row).alias("_a"), F.xxhash64(F.lit(seed), row).alias("_b")]
    sized = docs.select(*hashes, row.alias("_row"), F.col(f"`{source_column}`").cast("string").alias("_source"), size.alias("_words"))
    whole = F.struct(*[F.col("_row").getField(c).alias(c) for c in docs.columns], "_words")
    narrow = sized.select(
        F.xxhash64(whole).alias("_key"),
        F.xxhash64(F.lit(seed), whole).alias("_check"),
        "_a",
        "_b",
        "_source",
        F.coalesce("_words", F.lit(0)).cast("long").alias("_size"),
    )
    same = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("_rows"))
    same = stored(same, "mix-rows")
    taken = _taken(same.drop("_a", "_b"), weights, share, most, seed).where("_taken > 0").select("_key", "_check", "_taken")
    taken = same.select("_key", "_check", "_a", "_b").join(taken, ["_key", "_check"]).select("_a", "_b", "_taken")
    texts = docs.select(*hashes, row.alias("_row")).groupBy("_a", "_b").agg(F.first("_row").alias("_row"))
    # No sequence is longer than PART, however often a row is taken.
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("_taken") - 1) / PART))).alias("_part")
    often = texts.join(taken, ["_a", "_b"]).select("_row", "_taken", parts)
    times = F.least(F.col("_taken") - F.col("_part") * PART, F.lit(PART))
    again = often.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return again.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def take(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of the mix: every row as often as it has copies."""
    return mixed.where("copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)
