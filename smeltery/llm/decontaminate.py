"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of whole documents inside one task. Its words are numbered by the test
vocabulary (0 for any other word); an FM-index over them holds the Burrows-Wheeler transform in
a wavelet tree with sampled ranks, and suffix positions at every few places of the text. Test
windows are searched backwards, all at once, one word per step; occurrences are located by
walking to the next sampled position, and become spans of words, which are merged.

Words that no test window holds cannot be part of an occurrence, so runs of test words shorter
than the shortest window are left out of the index; this changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import packed, texts_of, unpacked, with_columns_of

#: Words between ASCII characters other than letters and digits.
GAPS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: The same words as a pattern.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of one shard's text, unless a single document has more; test words searched in one pass.
SHARD_WORDS, TEST_WORDS = 1 << 19, 1 << 20
RANK_STEP, POSITION_STEP = 64, 8


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII gaps; none for NULL."""
    return text.encode("utf-8", "surrogatepass").lower().translate(GAPS).split() if text else []


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbols, highest first.

    Each level is stably parted by its bit, so a node is a range of the level; counts of ones
    are kept at every ``RANK_STEP``-th place and the rest is counted in packed words.
    """

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.n = len(sequence)
        self.words, self.sums, self.zeros = [], [], []
        level = sequence
        for bit in range(self.bits - 1, -1, -1):
            ones = ((level >> bit) & 1).astype(np.uint8)
            padded = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
            padded[: self.n] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(self.n - int(ones.sum()))
            level = np.concatenate([level[ones == 0], level[ones == 1]])

    def _ones(self, level: int, ends: np.ndarray) -> np.ndarray:
        block = ends // RANK_STEP
        mask = (np.uint64(1) << (ends % RANK_STEP).astype(np.uint64)) - np.uint64(1)
        return self.sums[level][block] + np.bitwise_count(self.words[level][block] & mask).astype(np.int64)

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros_like(ends), ends
        for level in range(self.bits):
            bit = (symbols >> (self.bits - 1 - level)) & 1
            low_ones, high_ones = self._ones(level, low), self._ones(level, high)
            low = np.where(bit == 1, self.zeros[level] + low_ones, low - low_ones)
            high = np.where(bit == 1, self.zeros[level] + high_ones, high - high_ones)
        return high - low

    def at(self, places: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        symbols = np.zeros(len(places), np.int64)
        for level in range(self.bits):
            bit = ((self.words[level][places // 64] >> (places % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(level, places)
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
            symbols = symbols << 1 | bit
        return symbols


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling of the sorted prefix."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        order = np.argsort(rank * (n + 1) + after, kind="stable")
        key = (rank * (n + 1) + after)[order]
        fresh = np.zeros(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if fresh[order[-1]] == n - 1 or step >= n:
            return order
        rank, step = fresh, step * 2


class FMIndex:
    """Backward search over a text of symbols that ends with symbol 0, which occurs there only."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        self.n = len(text)
        self.tree = WaveletTree(text[order - 1], symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))]).astype(np.int64)
        sampled = order % POSITION_STEP == 0
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.is_sampled, self.positions = sampled, order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns, given as rows that end at the last column."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        width = patterns.shape[1]
        for step in range(width):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            symbol = patterns[live, width - 1 - step]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of places in the suffix order."""
        result, walked = np.full(len(places), -1, np.int64), np.zeros(len(places), np.int64)
        todo = np.arange(len(places))
        places = places.copy()
        while len(todo):
            here = places[todo]
            hit = self.is_sampled[here]
            result[todo[hit]] = self.positions[self.sampled[here[hit]]] + walked[todo[hit]]
            todo, here = todo[~hit], here[~hit]
            symbol = self.tree.at(here)
            places[todo] = self.before[symbol] + self.tree.rank(symbol, here)
            walked[todo] += 1
        return result


@dataclass
class Windows:
    """Distinct test windows, as rows of word numbers (from 2), and the items that hold each."""

    vocabulary: dict[bytes, int]
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[list[int]]
    item_ids: list


def windows_of(items: list[tuple[object, list[bytes]]], width: int) -> Windows:
    vocabulary: dict[bytes, int] = {}
    holders: dict[tuple[int, ...], set[int]] = {}
    for number, (_, words) in enumerate(items):
        symbols = [vocabulary.setdefault(word, len(vocabulary) + 2) for word in words]
        for start in range(max(1, len(symbols) - width + 1)):
            if symbols:
                holders.setdefault(tuple(symbols[start : start + width]), set()).add(number)
    patterns = np.ones((len(holders), width), np.int64)
    lengths = np.zeros(len(holders), np.int64)
    for row, window in enumerate(holders):
        patterns[row, width - len(window) :] = window
        lengths[row] = len(window)
    return Windows(vocabulary, patterns, lengths, [sorted(x) for x in holders.values()], [x[0] for x in items])


def occurrences(symbols: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Start and window number of each occurrence in a shard's symbols, where 0 is no test word.

    Documents must be parted by a 0.
    """
    none = np.zeros(0, np.int64)
    if not len(windows.lengths):
        return none, none
    known = np.concatenate([[False], symbols > 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= windows.lengths.min()
    starts, ends = starts[enough], ends[enough]
    if not len(starts):
        return none, none
    sizes = ends - starts
    shifts = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]), sizes + 1)
    place = np.arange(len(shifts)) + shifts
    run = np.where(place < np.repeat(ends, sizes + 1), symbols[np.minimum(place, len(symbols) - 1)], 1)
    text = np.concatenate([run, [0]])
    index = FMIndex(text, len(windows.vocabulary) + 2)
    low, high = index.search(windows.patterns, windows.lengths)
    found = np.repeat(np.arange(len(low)), high - low)
    offsets = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = index.locate(np.repeat(low, high - low) + offsets)
    return place[at], found


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined into one."""
    spans: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist())):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((start, end))
    return spans


def _shard_results(documents: list[list[bytes]], windows: Windows):
    """Per document: number of words, merged hit spans, numbers of the items found."""
    sizes = np.array([len(words) for words in documents], np.int64)
    get = windows.vocabulary.get
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    symbols = np.zeros(int(starts[-1]), np.int64)
    for start, words in zip(starts, documents):
        symbols[start : start + len(words)] = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
    at, found = occurrences(symbols, windows)
    owner = np.searchsorted(starts, at, side="right") - 1
    order = np.argsort(owner, kind="stable")
    at, found, owner = at[order], found[order], owner[order]
    borders = np.searchsorted(owner, np.arange(len(documents) + 1))
    for number, size in enumerate(sizes.tolist()):
        mine = slice(borders[number], borders[number + 1])
        begin = at[mine] - starts[number]
        spans = merged(begin, begin + windows.lengths[found[mine]])
        yield size, spans, sorted({item for window in set(found[mine].tolist()) for item in windows.items[window]})


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 10,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``spans`` and ``items``.

    ``spans`` are the merged word ranges ``[start, end)`` inside occurrences of test windows;
    ``items`` the distinct ids, as text and in order, of the items whose windows occur. An item
    with fewer than ``width`` words is one window; NULL and wordless texts have none. Windows of
    items with a NULL id count for spans but name no item. Repeated rows stay; repeated item ids
    are one item. Columns of the input with these names are replaced, all others are kept. No
    shuffle: documents stay where they are read. The test set comes to the driver in blocks of
    about ``TEST_WORDS`` words; one block is searched, and broadcast, at a time.
    """
    added = ("n_words", "spans", "items")
    kept = [c for c in docs.columns if c not in added]
    result = packed(docs, kept).select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    tests = benchmark.select(F.col(item_column).alias("id"), F.col(item_text_column).cast("string").alias("text"))
    n_words = tests.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    blocks = 1 + int(n_words) // TEST_WORDS
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for number in range(blocks):
        rows = tests.where(block == number).collect() if blocks > 1 else tests.collect()
        windows = windows_of([(row.id, words_of(row.text)) for row in rows], width)
        result = _searched(result, kept, text_column, docs.sparkSession.sparkContext.broadcast(windows))
    return result.select(*unpacked(kept), *added)


def _searched(docs: DataFrame, kept: list[str], text_column: str, shared) -> DataFrame:
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def joined(spans: list[tuple[int, int]], earlier: list[dict]) -> list[dict]:
        pairs = spans + [(x["start"], x["end"]) for x in earlier]
        both = merged(np.array([x[0] for x in pairs]), np.array([x[1] for x in pairs])) if earlier else spans
        return [{"start": start, "end": end} for start, end in both]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        names = [None if x is None else str(x) for x in windows.item_ids]
        for batch in batches:
            sizes, spans, items = [], [], []
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())

            def close(shard: list[list[bytes]]) -> None:
                for size, found, numbers in _shard_results(shard, windows):
                    old_spans, old_items = next(earlier)
                    sizes.append(size)
                    spans.append(joined(found, old_spans))
                    items.append(sorted({names[x] for x in numbers if names[x] is not None} | set(old_items)))

            shard, held = [], 0
            for text in texts_of(batch, kept, text_column):
                words = words_of(text.as_py())
                if shard and held + len(words) > SHARD_WORDS:
                    close(shard)
                    shard, held = [], 0
                shard.append(words)
                held += len(words)
            close(shard)
            yield with_columns_of(
                batch,
                ["row"],
                n_words=pa.array(sizes, pa.int64()),
                spans=pa.array(spans, span_type),
                items=pa.array(items, pa.list_(pa.string())),
            )

    return docs.mapInArrow(search, docs.schema)


def hit_words() -> Column:
    """Words inside the spans of :func:`contamination`."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **how) -> DataFrame:
    """The documents in which no test window occurs, unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("_row"), F.col(text_column).alias("_text"))
    found = contamination(rows, benchmark, text_column="_text", **how).where(F.size("spans") == 0)
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
