"""Alignment of the tokens of two tokenizers over the same bytes, by interval coalescing.

Each token is an interval of byte offsets. The intervals of both tokenizers are sorted by start;
a running maximum of their ends tells how far the tokens so far reach, and a group breaks where a
start reaches it. Inside a group, each A token is expanded over the B tokens it overlaps. Many
documents are one long line of bytes to these steps, so they run on whole slices of a batch.

How many documents hold an id pair linked is a count over all documents. Documents are put
into blocks of bounded size, each with its distinct pairs once; pairs of blocks, not links of
documents, are counted, joined to the counts and sent back to their block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from smeltery.llm.common import stored
from smeltery.session import setting

#: Where the vocabulary files are on every machine, and their names.
FOLDER, FILE_A, FILE_B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that are tokenized at once, and id pairs of documents that share a block.
SLICE_BYTES, BLOCK_PAIRS = 1 << 18, 1 << 21
#: Bytes of rows that a Python worker gets at once, or one larger row; blocks lie within.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
PAIRS = ("pair_a", "pair_b", "pair_links")
#: Longest word whose ids are remembered, and how many words are, per Python worker.
LONGEST_WORD, WORDS_HELD = 64, 150_000
# How the byte-level vocabulary cuts a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Any character but printable ones and line ends up to U+024F.
UNCOMMON = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f]")
#: What stands after a token: more of its side, the other side, the next group, nothing.
MARKS = (",", "|", ";", "")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class WordIds(dict):
    """The ids of words as A's model gives them; words that are not very long are remembered.

    When half of ``WORDS_HELD`` are, they become the older half, and the older half before goes
    but for the words that came again. An id is one object in all words.
    """

    def __init__(self, model, numbers: int):
        super().__init__()
        self._model = model
        self._characters = {b: c for c, b in byte_of_character().items()}
        self._numbers = list(range(numbers))
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self._older.get(word)
        if ids is None:
            written = word.encode("utf-8").decode("latin-1").translate(self._characters)
            ids = tuple([self._numbers[token.id] for token in self._model.tokenize(written)])
        if len(word) <= LONGEST_WORD:
            self[word] = ids
        return ids

    def held(self) -> int:
        return len(self) + len(self._older)

    def age(self) -> None:
        if len(self) > WORDS_HELD // 2:
            self._older = dict(self)
            self.clear()


class Tokenizers:
    """Both tokenizers and the bytes of each of their ids.

    A cuts a text into words before it looks at them. Texts of Latin letters, where every version
    of Unicode cuts alike, are cut here and their words looked up, as most words come again; other
    texts go to A whole. The ids are the same.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        table = byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.words = WordIds(self.a.model, max(vocabulary.values()) + 1)
        self.a_bytes = [b"\xff"] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in table for c in token):
                self.a_bytes[number] = bytes(table[c] for c in token)
        self.b = SentencePieceProcessor(model_file=path_b)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.vocab_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.names = max(len(self.a_bytes), len(self.b_bytes))
        self.marked = pa.array([f"{i}{mark}" for mark in MARKS for i in range(self.names)], pa.string())

    def _piece_bytes(self, number: int) -> bytes:
        """0xFF, which no UTF-8 text holds, for ids that stand for no bytes."""
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        if self.b.is_unknown(number) or self.b.is_control(number):
            return b"\xff"
        return piece.replace("▁", " ").encode("utf-8")

    def encode_a(self, text: str) -> list[int]:
        if UNCOMMON.search(text):
            return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        self.words.age()
        return list(chain.from_iterable(map(self.words.__getitem__, WORDS.findall(text))))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B of each text; none where either's bytes are not those of the text."""
        found_a = [self.encode_a(" " + text) for text in texts]
        found_b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            whole = b" " + text.encode("utf-8")
            alike = b"".join([self.a_bytes[x] for x in found_a[i]]) == whole and b"".join(
                [self.b_bytes[x] for x in found_b[i]]
            ) == whole
            if not text or not alike:
                found_a[i], found_b[i] = [], []
        return found_a, found_b


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Loaded once per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(path_a, path_b)


def coalesce(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by start (then side) and, in that order, the number of each interval's group."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.empty(len(order), bool)
    breaks[:1] = True
    breaks[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def _below(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the values, which are byte offsets, lie below each limit."""
    counts = np.bincount(values, minlength=int(limits.max(initial=0)))
    return np.concatenate([[0], np.cumsum(counts)])[limits]


def expand(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose intervals overlap, in order of A, then of B."""
    first = _below(b_end, a_start + 1)
    number = _below(b_start, a_end) - first
    of_a = np.repeat(np.arange(len(a_start)), number)
    within = np.arange(len(of_a)) - np.repeat(np.cumsum(number) - number, number)
    return of_a, first[of_a] + within


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row and the document of each."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    return ids, np.repeat(np.arange(len(lists)), sizes)


def align_texts(texts: list[str], tools: Tokenizers) -> dict[str, pa.Array]:
    """Counts, groups and linked id pairs of each text."""
    found_a, found_b = tools.encode(texts)
    (a, a_doc), (b, b_doc) = _flat(found_a), _flat(found_b)
    a_end, b_end = np.cumsum(tools.a_sizes[a]), np.cumsum(tools.b_sizes[b])
    a_start, b_start = a_end - tools.a_sizes[a], b_end - tools.b_sizes[b]
    side = np.repeat([0, 1], [len(a), len(b)])
    order, group = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]), side)
    n = len(texts)
    counts = {"n_a": np.bincount(a_doc, minlength=n), "n_b": np.bincount(b_doc, minlength=n)}

    in_group = np.argsort(2 * group + side[order], kind="stable")
    ids, docs = np.concatenate([a, b])[order][in_group], np.concatenate([a_doc, b_doc])[order][in_group]
    sides = side[order][in_group]
    last_of_group = np.append(group[1:] != group[:-1], True) if len(group) else np.empty(0, bool)
    last_of_side = np.append(sides[1:] != sides[:-1], True) if len(sides) else last_of_group
    last_of_text = np.append(docs[1:] != docs[:-1], True) if len(docs) else last_of_group
    mark = np.select([last_of_text, last_of_group, last_of_side], [3, 2, 1], 0)
    at = np.concatenate([[0], np.cumsum(counts["n_a"] + counts["n_b"])]).astype(np.int32)
    pieces = pa.ListArray.from_arrays(at, tools.marked.take(pa.array(mark * tools.names + ids)))
    groups = pc.binary_join(pieces, "")
    counts["n_groups"] = np.bincount(docs[last_of_group], minlength=n)

    link_a, link_b = expand(a_start, a_end, b_start, b_end)
    counts["n_links"] = np.bincount(a_doc[link_a], minlength=n)
    kinds = len(tools.a_bytes) * len(tools.b_bytes)
    code = (a_doc * kinds)[link_a] + (a * len(tools.b_bytes))[link_a] + b[link_b]
    distinct, links = np.unique(code, return_counts=True)
    offsets = np.searchsorted(distinct, np.arange(n + 1) * kinds).astype(np.int32)
    pairs = (distinct % kinds // len(tools.b_bytes), distinct % len(tools.b_bytes), links)
    lists = {name: pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for name, x in zip(PAIRS, pairs)}
    return {name: pa.array(counts[name], pa.int64()) for name in COUNTS} | {"groups": groups} | lists


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive rows with ``most`` in all, or one larger row."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)


def align(docs: DataFrame, text_column: str = "text", folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """All rows and columns of ``docs`` with the alignment of each whole text.

    A encodes a blank and the text, B the text. Adds ``n_a, n_b, n_groups, n_links``; ``groups``,
    the ids of the groups as ``a1,a2|b1;a3|b2``; and ``pair_a, pair_b, pair_links``, each linked
    id pair once with its number of links, in order of ids. Texts that are NULL or empty, or
    whose bytes one of the tokenizers does not keep, have no tokens: zeros, an empty string and
    empty lists. Repeated rows are aligned each. Other columns may have any name; those named
    like the result's are replaced. An empty table gives an empty result. Needs the vocabulary
    files in ``folder`` on every machine.
    """
    path_a, path_b = f"{folder}/{file_a}", f"{folder}/{file_b}"
    kept = [c for c in docs.columns if c not in (*COUNTS, "groups", *PAIRS)]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text.alias("text"))
    numbers = [StructField(name, LongType()) for name in COUNTS]
    lists = [StructField(name, ArrayType(IntegerType())) for name in PAIRS]
    schema = StructType([packed.schema["row"], *numbers, StructField("groups", StringType()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(path_a, path_b)
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for start, end in _slices(sizes, SLICE_BYTES):
                part = batch.slice(start, end - start)
                found = align_texts(part.column("text").to_pylist(), tools)
                yield pa.RecordBatch.from_arrays([part.column("row"), *found.values()], names=["row", *found])

    found = packed.mapInArrow(run, schema)
    return found.select(*[F.col(f"row.`{c}`") for c in kept], *COUNTS, "groups", *PAIRS)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and all values of a column of lists."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    return sizes, column.flatten().to_numpy(zero_copy_only=False)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents, its distinct pairs and how many documents hold each."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes, a = _lists(batch.column("pair_a"))
        (_, b), (_, links) = _lists(batch.column("pair_b")), _lists(batch.column("pair_links"))
        codes = a.astype(np.int64) << 32 | b
        at = np.concatenate([[0], np.cumsum(sizes)])
        for start, end in _slices(sizes, BLOCK_PAIRS):
            inside = slice(at[start], at[end])
            distinct, place, held = np.unique(codes[inside], return_inverse=True, return_counts=True)
            rows = batch.column("row").slice(start, end - start)
            columns = {
                "block": pa.array([number], pa.int64()),
                "rows": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                "sizes": pa.array([sizes[start:end].astype(np.int32)], pa.list_(pa.int32())),
                "place": pa.array([place.astype(np.int32)], pa.list_(pa.int32())),
                "links": pa.array([links[inside].astype(np.int32)], pa.list_(pa.int32())),
                "codes": pa.array([distinct], pa.list_(pa.int64())),
                "held": pa.array([held.astype(np.int32)], pa.list_(pa.int32())),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            number += 1


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``code, count, best`` from ``code, held``: documents of each pair, and whether none of its A id has more.

    The greatest count per A id is broadcast; it has a row per id of A's vocabulary at most.
    """
    counts = pairs.groupBy("code").agg(F.sum("held").alias("count")).withColumn("a", F.shiftright("code", 32))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` without pairs, with ``n_best`` and ``count_sum`` over their links.

    The count of an id pair is the number of rows of ``aligned`` that hold it linked. ``n_best``
    is the number of links whose count no other pair of the same A id exceeds; ``count_sum`` the
    sum of the counts. Rows without links have zeros; repeated rows count each. Other columns may
    have any name; ``n_best`` and ``count_sum`` are replaced.

    A block holds ``BLOCK_PAIRS`` pairs or one longer document. It is stored as one row; what
    is shuffled are its distinct pairs, twice, and its row, once. A task that aligns and blocks
    rows has a Python worker for either, which the next task may use the other way round, so each
    can come to hold the tokenizers and their words; batches are therefore bounded by bytes.
    """
    kept = [c for c in aligned.columns if c not in (*PAIRS, "n_best", "count_sum")]
    packed = aligned.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *PAIRS)
    row, whole = packed.schema["row"].dataType, ArrayType(IntegerType())
    lists = [StructField(name, whole) for name in ("sizes", "place", "links")]
    schema = [StructField("block", LongType()), StructField("rows", ArrayType(row)), *lists]
    schema += [StructField("codes", ArrayType(LongType())), StructField("held", whole)]
    with setting(aligned.sparkSession, BATCH_SETTING, str(BATCH_BYTES)):
        blocks = stored(packed.mapInArrow(_to_blocks, StructType(schema)), "alignment-blocks")
    pairs = blocks.select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("codes", "held")).alias("at", "pair"))
    pairs = pairs.select("of", "at", F.col("pair.codes").alias("code"), "pair.held")
    weights = pairs.join(pair_counts(pairs), "code").select("of", "at", "count", "best")

    def weigh(block: pa.Table, weights: pa.Table) -> pa.Table:
        rows = block.column("rows").combine_chunks().flatten()
        sizes, place, links = (_lists(block.column(c).combine_chunks())[1] for c in ("sizes", "place", "links"))
        count, best = np.zeros(weights.num_rows, np.int64), np.zeros(weights.num_rows, np.int64)
        at = weights.column("at").to_numpy()
        count[at], best[at] = weights.column("count").to_numpy(), weights.column("best").to_numpy()
        ends = np.cumsum(sizes)
        sums = [np.concatenate([[0], np.cumsum(links * values[place])]) for values in (best, count)]
        found = [pa.array(s[ends] - s[ends - sizes], pa.int64()) for s in sums]
        return pa.Table.from_arrays([rows, *found], names=["row", "n_best", "count_sum"])

    row = blocks.schema["rows"].dataType.elementType  # nullable, as it comes from files
    result = StructType([StructField("row", row), StructField("n_best", LongType()), StructField("count_sum", LongType())])
    held = blocks.select("block", "rows", "sizes", "place", "links").groupBy("block")
    scored = held.cogroup(weights.groupBy("of")).applyInArrow(weigh, result)
    return scored.select(*[F.col(f"row.`{c}`") for c in kept], "n_best", "count_sum")
