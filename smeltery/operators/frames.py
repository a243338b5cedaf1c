"""Rolling statistics of many series at once, from one summary row per second.

A summary is a count, a mean, a sum of squared deviations and, where asked for, a minimum and a
maximum; two of them merge into the summary of both. Time is cut into blocks one second longer than
the frame. A frame then is the start of the block its last second lies in, and the end of the block
before: a running merge forwards and one backwards, and one merge of the two per row. Nothing is
subtracted, so a far value leaves no trace in frames that do not hold it, and the work per row grows
with the logarithm of the rows in a frame.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows that are worked on at once, if groups end there. They bound what a task of frames holds in Python.
ROWS = 50_000
Summary = dict[str, np.ndarray]


def merge(a: Summary, b: Summary) -> Summary:
    """The summary of what two summaries hold together; empty ones change nothing."""
    n = a["n"] + b["n"]
    both = {"n": n}
    if "mean" in a:
        none_a, none_b = a["n"] == 0, b["n"] == 0
        with np.errstate(invalid="ignore", over="ignore"):
            delta = np.where(a["mean"] == b["mean"], 0.0, b["mean"] - a["mean"])
            share = b["n"] / np.maximum(n, 1)
            mean = np.where(np.isfinite(delta), a["mean"] + delta * share, a["mean"] + b["mean"])
            dev = a["dev"] + b["dev"] + delta * delta * a["n"] * share
        both["mean"] = np.where(none_a, b["mean"], np.where(none_b, a["mean"], mean))
        both["dev"] = np.where(none_a, b["dev"], np.where(none_b, a["dev"], dev))
    if "min" in a:
        both["min"] = np.fmin(a["min"], b["min"])
    if "max" in a:
        both["max"] = np.maximum(a["max"], b["max"])
    return both


def running(values: Summary, first: np.ndarray) -> Summary:
    """Merges of each row with all rows before it in its block, ``first`` being the block's first row.

    After a step each row holds twice as many rows as before it.
    """
    held = {name: column.copy() for name, column in values.items()}
    rows, step = np.arange(len(first)), 1
    while True:
        at = rows[rows - step >= first]
        if not len(at):
            return held
        merged = merge({k: v[at - step] for k, v in held.items()}, {k: v[at] for k, v in held.items()})
        for name, column in merged.items():
            held[name][at] = column
        step *= 2


def starts(changed: np.ndarray) -> np.ndarray:
    """For each row the row at which its run began; ``changed`` is true where one begins."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def frame_summaries(values: Summary, group: np.ndarray, second: np.ndarray, length: int) -> Summary:
    """For each row the summary of its group's rows of the last ``length`` seconds and its own second.

    Rows are in order of group and second.
    """
    if not len(second):
        return values
    block = second // (length + 1)
    changed = np.ones(len(second), bool)
    changed[1:] = (group[1:] != group[:-1]) | (block[1:] != block[:-1])
    forwards = running(values, starts(changed))
    ends = np.append(changed[1:], True)[::-1]
    backwards = {k: v[::-1] for k, v in running({k: v[::-1] for k, v in values.items()}, starts(ends)).items()}
    base = second.min()
    span = int(second.max() - base) + 1
    at = second - base
    begin = np.searchsorted(group * span + at, group * span + np.maximum(at - length, 0))
    reached = np.flatnonzero(block[begin] < block)
    together = {k: v.copy() for k, v in forwards.items()}
    merged = merge({k: v[begin[reached]] for k, v in backwards.items()}, {k: v[reached] for k, v in forwards.items()})
    for name, column in merged.items():
        together[name][reached] = column
    return together


def statistic(summary: Summary, name: str) -> pa.Array:
    """A statistic of each summary; none of no values, and no deviation of a single one."""
    n = summary["n"]
    if name == "count":
        return pa.array(n, pa.int64())
    if name == "std":
        with np.errstate(invalid="ignore"):
            return pa.array(np.sqrt(np.maximum(summary["dev"], 0.0) / np.maximum(n - 1, 1)), pa.float64(), mask=n < 2)
    return pa.array(summary[name], pa.float64(), mask=n == 0)


def _changes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where a row differs from the one before in a key; NULL is a value of its own."""
    changed = np.zeros(len(table), bool)
    changed[:1] = True
    for key in keys:
        column = table.column(key).combine_chunks()
        now, before = column.slice(1), column.slice(0, max(len(column) - 1, 0))
        other = pc.or_(pc.fill_null(pc.not_equal(now, before), False), pc.not_equal(pc.is_null(now), pc.is_null(before)))
        changed[1:] |= other.to_numpy(zero_copy_only=False)
    return changed


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The sorted rows in tables that end where a group ends, with the number of each row's group."""
    held, count, wanted = [], 0, rows
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= wanted:
            table = pa.Table.from_batches(held)
            changed = _changes(table, keys)
            cut = int(np.flatnonzero(changed)[-1])
            if cut:
                yield table.slice(0, cut), np.cumsum(changed[:cut])
            held, count = table.slice(cut).to_batches(), table.num_rows - cut
            wanted = max(rows, 2 * count)
    if count:
        table = pa.Table.from_batches(held)
        yield table, np.cumsum(_changes(table, keys))


def summary_of(table: pa.Table, name: str, wanted: frozenset[str]) -> Summary:
    """The summaries of a sensor or flag (``__n_``, ``__mean_`` and so on) that the statistics need."""
    n = table.column(f"__n_{name}").to_numpy()
    summary = {"n": n.astype(np.int64)}
    if wanted & {"mean", "std"}:
        for part in ("mean", "dev"):
            column = table.column(f"__{part}_{name}").to_numpy()
            summary[part] = np.where(n == 0, 0.0, column)
    if "min" in wanted:
        summary["min"] = table.column(f"__min_{name}").to_numpy().astype(np.float64)
    if "max" in wanted:
        summary["max"] = np.where(n == 0, -np.inf, table.column(f"__max_{name}").to_numpy().astype(np.float64))
    return summary


def columns_of(table: pa.Table, group: np.ndarray, second: np.ndarray, wanted: Mapping[str, tuple[str, int, str]]) -> dict[str, pa.Array]:
    """The wanted columns, each the name of a sensor or flag, a frame length and a statistic.

    One summary is held at a time, with the statistics its columns ask for.
    """
    asked: dict[tuple[str, int], set[str]] = {}
    for name, length, stat in wanted.values():
        asked.setdefault((name, length), set()).add(stat)
    found = {}
    for (name, length), stats in asked.items():
        summary = frame_summaries(summary_of(table, name, frozenset(stats)), group, second, length)
        found |= {column: statistic(summary, stat) for column, (n, size, stat) in wanted.items() if (n, size) == (name, length)}
    return found
