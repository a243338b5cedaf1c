"""Sensor history per machine: lags, rate of change, rolling statistics, failure horizon.

A window over a whole machine would put all its readings into one task. Here the work is
cut along time:

* lags run on slices of a machine's time line, as long as its own readings ask for; the
  readings a slice needs from before it, at most as many as the longest lag, are looked up
  from the ends of the earlier slices; a machine with few readings is one slice;
* rolling statistics run on one summary row per machine and second, because readings of
  one second share one frame; see :mod:`smeltery.operators.frames`;
* the failure horizon is a running minimum over failure times in the same slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.functions.calendar import epoch_seconds
from smeltery.functions.rules import is_true, relative_change
from smeltery.operators import frames

SECOND = "__second"
SLICE = "__slice"
LENGTH = "__length"
READING = "__reading"
HOUR = 3_600
SLICE_ROWS = 2_000_000


@dataclass(frozen=True)
class RollingSpec:
    """Which columns play which part, and what to compute."""

    machine: str = "machine_id"
    time: str = "timestamp"
    row_id: str = "reading_id"
    sensors: Sequence[str] = ("temperature", "vibration", "pressure", "rpm", "voltage")
    lags: Sequence[int] = (1, 5, 10)
    # Suffix of each frame, its length in seconds and its statistics.
    frames: Mapping[str, tuple[int, Sequence[str]]] = field(
        default_factory=lambda: {
            "5m": (300, ("mean", "std", "min", "max")),
            "15m": (900, ("mean", "std")),
            "30m": (1800, ("mean", "std")),
        }
    )
    # Name of a counting column, the flag it counts and its frame in seconds.
    counts: Mapping[str, tuple[str, int]] = field(
        default_factory=lambda: {"anomaly_count_5m": ("is_anomaly", 300)}
    )


def slice_lengths(df: DataFrame, spec: RollingSpec, rows: int = SLICE_ROWS, at_least: int = 60) -> DataFrame:
    """``machine, __length``: seconds that hold about ``rows`` readings in the machine's busiest hour.

    Only machines with more than ``rows`` readings are listed; the others need no slices. So there
    are fewer rows than one for every ``rows`` readings. Counted per hour, reduced map-side.
    """
    hour = F.floor(epoch_seconds(F.col(spec.time)) / HOUR)
    per_hour = df.groupBy(spec.machine, hour.alias("__hour")).agg(F.count(F.lit(1)).alias("__rows"))
    busiest = F.floor(F.lit(HOUR * rows).cast("long") / F.max("__rows"))
    per_machine = per_hour.groupBy(spec.machine).agg(
        F.sum("__rows").alias("__rows"), F.greatest(busiest, F.lit(at_least)).cast("long").alias(LENGTH)
    )
    return per_machine.filter(F.col("__rows") > rows).drop("__rows")


def _add_slices(df: DataFrame, spec: RollingSpec, lengths: DataFrame | int) -> DataFrame:
    """Add length and number of the slice that each row's second lies in.

    The lengths are broadcast; see :func:`slice_lengths` for their number. Machines that are not
    among them have one slice, whatever its readings' times.
    """
    if isinstance(lengths, int):
        known = df.withColumn(LENGTH, F.lit(lengths).cast("long"))
    else:
        named = F.broadcast(lengths.withColumnRenamed(spec.machine, "__of"))
        known = df.join(named, F.col(spec.machine).eqNullSafe(F.col("__of")), "left").drop("__of")
    number = F.when(F.col(LENGTH).isNull(), 0).otherwise(F.floor(F.col(SECOND) / F.col(LENGTH)))
    return known.withColumn(SLICE, number.cast("long"))


def cut_slices(df: DataFrame, spec: RollingSpec, lengths: DataFrame | int) -> DataFrame:
    """Add the second, the slice length (NULL where a machine is one slice) and the slice of every reading."""
    return _add_slices(df.withColumn(SECOND, epoch_seconds(F.col(spec.time))), spec, lengths)


def _history_rows(sliced: DataFrame, spec: RollingSpec) -> DataFrame:
    """For each slice: the last readings before it, as rows of that slice.

    Machines of one slice have none and are left out before anything moves. Each slice is first
    reduced to its last readings, so the window over a machine sees a few rows per slice.
    """
    depth = max(spec.lags)
    order = [SECOND, spec.time, spec.row_id]
    from_end = Window.partitionBy(spec.machine, SLICE).orderBy(*[F.desc(name) for name in order])
    ends = (
        sliced.filter(F.col(LENGTH).isNotNull())
        .select(spec.machine, SLICE, *order, F.struct(*spec.sensors).alias(READING))
        .withColumn("__from_end", F.row_number().over(from_end))
        .filter(F.col("__from_end") <= depth)
    )
    machine = Window.partitionBy(spec.machine).orderBy(*order)
    entry = F.struct(*order, READING)
    return (
        ends.select(
            spec.machine,
            SLICE,
            F.lag(SLICE).over(machine).alias("__slice_before"),
            F.collect_list(entry).over(machine.rowsBetween(-depth, -1)).alias("__before"),
        )
        .filter(F.col("__slice_before") < F.col(SLICE))
        .select(spec.machine, SLICE, F.explode("__before").alias("__entry"))
        .select(spec.machine, SLICE, "__entry.*")
    )


def _lags_in_slices(sliced: DataFrame, spec: RollingSpec, rolled: DataFrame | None = None) -> DataFrame:
    """Lag columns of a sliced table and, if given, the columns of its per-second frames.

    Readings, the history of each slice and the frames are put into one table: it is
    shuffled and sorted once, and every column is a running window function over it. The
    readings travel as one struct, so rows of the other kinds stay narrow.
    """
    order = [SECOND, spec.time, spec.row_id]
    readings = sliced.select(
        spec.machine,
        SLICE,
        *order,
        F.struct(*spec.sensors).alias(READING),
        F.struct(*[F.col(name) for name in sliced.columns]).alias("__row"),
    )
    together = readings.unionByName(_history_rows(sliced, spec), allowMissingColumns=True)
    frame_columns = []
    if rolled is not None:
        frame_columns = [name for name in rolled.columns if name not in {spec.machine, SLICE, SECOND}]
        packed = rolled.select(spec.machine, SLICE, SECOND, F.struct(*frame_columns).alias("__frame"))
        together = together.unionByName(packed, allowMissingColumns=True)
    # Frame rows have no time of their own and sort before the readings of their second.
    by = f"PARTITION BY `{spec.machine}`, {SLICE} ORDER BY {SECOND}, `{spec.time}`, `{spec.row_id}`"
    windows = [
        F.expr(f"lag({READING}, {n}) IGNORE NULLS OVER ({by})").alias(f"__lag{n}") for n in spec.lags
    ]
    if frame_columns:
        windows.append(F.expr(f"last(__frame) IGNORE NULLS OVER ({by} ROWS UNBOUNDED PRECEDING)").alias("__now"))
    return (
        together.select(spec.machine, "__row", *windows)
        .filter(F.col("__row").isNotNull())
        .select(
            "__row.*",
            *[F.col(f"__lag{n}")[s].alias(f"{s}_lag{n}") for s in spec.sensors for n in spec.lags],
            *[F.col("__now")[name].alias(name) for name in frame_columns],
        )
    )


def _with_change(df: DataFrame, spec: RollingSpec) -> DataFrame:
    if 1 not in spec.lags:
        return df
    return df.withColumns(
        {f"{s}_roc": relative_change(F.col(s), F.col(f"{s}_lag1")) for s in spec.sensors}
    )


def lag_features(df: DataFrame, spec: RollingSpec = RollingSpec(), slices: int | None = None) -> DataFrame:
    """Row lags and relative change per sensor, ordered by time and then row id."""
    sliced = cut_slices(df, spec, slices or slice_lengths(df, spec))
    return _with_change(_lags_in_slices(sliced, spec), spec).drop(SECOND, SLICE, LENGTH)


def _second_summary(df: DataFrame, spec: RollingSpec) -> DataFrame:
    """Count, mean, squared deviations, minimum and maximum per sensor, machine and second.

    Only what the frames ask for; the mean of equal values is that value, to the last digit.
    """
    asked = {stat for _, stats in spec.frames.values() for stat in stats}
    flags = sorted({flag for flag, _ in spec.counts.values()})
    parts = [F.count_if(F.col(flag)).alias(f"__n_{flag}") for flag in flags]
    for s in spec.sensors if spec.frames else ():
        low, high = F.min(s), F.max(s)
        parts.append(F.count(s).alias(f"__n_{s}"))
        if asked & {"mean", "std"}:
            mean = F.when(low == high, low.cast("double")).otherwise(F.avg(s))
            parts += [mean.alias(f"__mean_{s}"), (F.var_pop(s) * F.count(s)).alias(f"__dev_{s}")]
        parts += [value.alias(f"__{stat}_{s}") for stat, value in (("min", low), ("max", high)) if stat in asked]
    return df.groupBy(spec.machine, SECOND).agg(*parts)


def _frames_per_second(with_second: DataFrame, spec: RollingSpec) -> DataFrame:
    """Rolling columns for every machine and second that has a reading.

    Seconds are placed by slices of twice the longest frame, which take along the seconds before
    them that their frames reach; all frames share that one shuffle. A slice holds a summary per
    second, however many readings, so a task's work is bounded by the frames.
    """
    lengths = sorted({n for n, _ in spec.frames.values()} | {n for _, n in spec.counts.values()})
    width = max(2 * lengths[-1], HOUR)
    slice_of = F.floor(F.col(SECOND) / width)
    needed_in = F.sequence(slice_of, F.floor((F.col(SECOND) + lengths[-1]) / width))
    wanted = {
        f"{s}_{stat}_{suffix}": (s, length, stat)
        for suffix, (length, stats) in spec.frames.items()
        for s in spec.sensors
        for stat in stats
    }
    wanted |= {name: (flag, length, "count") for name, (flag, length) in spec.counts.items()}
    keys = [spec.machine, SLICE]
    placed = _second_summary(with_second, spec).withColumn(SLICE, F.explode(needed_in))
    placed = placed.repartition(*keys).sortWithinPartitions(*keys, SECOND)

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in frames.whole_groups(batches, keys):
            second = table.column(SECOND).to_numpy()
            found = frames.columns_of(table, group, second, wanted)
            own = pa.array(table.column(SLICE).to_numpy() == second // width)
            rows = pa.Table.from_arrays(
                [table.column(spec.machine), table.column(SECOND), *found.values()], names=[spec.machine, SECOND, *found]
            )
            yield from rows.filter(own).to_batches()

    kinds = {name: "long" if stat == "count" else "double" for name, (_, _, stat) in wanted.items()}
    known = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    machine = placed.schema[spec.machine].dataType.simpleString()
    rolled = placed.mapInArrow(roll, f"`{spec.machine}` {machine}, {SECOND} long, {known}")
    sensor = {name: with_second.schema[s].dataType for name, (s, _, stat) in wanted.items() if stat in ("min", "max")}
    return rolled.withColumns({name: F.col(name).cast(kind) for name, kind in sensor.items()})


def rolling_features(df: DataFrame, spec: RollingSpec = RollingSpec()) -> DataFrame:
    """Statistics over the seconds up to and including each reading's second."""
    with_second = df.withColumn(SECOND, epoch_seconds(F.col(spec.time)))
    rolled = _frames_per_second(with_second, spec)
    return with_second.join(rolled, [spec.machine, SECOND], "left").drop(SECOND)


def machine_features(df: DataFrame, spec: RollingSpec = RollingSpec(), slices: int | None = None) -> DataFrame:
    """Lags, change, rolling statistics and counts together.

    The wide readings are shuffled and sorted once; see :func:`_lags_in_slices`.
    """
    lengths = slices or slice_lengths(df, spec)
    sliced = cut_slices(df, spec, lengths)
    rolled = _add_slices(_frames_per_second(sliced, spec), spec, lengths).drop(LENGTH)
    return _with_change(_lags_in_slices(sliced, spec, rolled), spec).drop(SECOND, SLICE, LENGTH)


def failure_within(
    df: DataFrame,
    spec: RollingSpec,
    is_failure: Column,
    horizon: int = 4 * HOUR,
    name: str = "will_fail_in_4hrs",
    slices: int | None = None,
) -> DataFrame:
    """Whether the machine fails after a reading's second and within the horizon.

    A slice sees its own failure seconds and, of every later slice within reach, the first
    one; the next failure is then a running minimum from the end of the slice.
    """
    sliced = cut_slices(df, spec, slices or slice_lengths(df, spec))
    own = sliced.filter(is_failure).select(spec.machine, SLICE, SECOND, LENGTH).distinct()
    reach = F.floor((F.col(SECOND) - horizon) / F.col(LENGTH))
    ahead = (
        own.groupBy(spec.machine, SLICE, LENGTH)
        .agg(F.min(SECOND).alias(SECOND))
        .filter(reach < F.col(SLICE))
        .withColumn(SLICE, F.explode(F.sequence(reach, F.col(SLICE) - 1)))
    )
    failures = own.unionByName(ahead).withColumn("__failure", F.col(SECOND))
    marked = sliced.withColumn("__reading", F.lit(True)).unionByName(failures, allowMissingColumns=True)
    later = (
        Window.partitionBy(spec.machine, SLICE)
        .orderBy(F.desc(SECOND))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    found = marked.withColumn("__next", F.min("__failure").over(later)).filter(F.col("__reading"))
    in_time = is_true(F.col("__next") - F.col(SECOND) <= horizon)
    return found.withColumn(name, in_time).drop(SECOND, SLICE, LENGTH, "__failure", "__reading", "__next")
