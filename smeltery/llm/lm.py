"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

P(word | context) = P(group | context) * P(class | group, context) * P(word | class, context). Classes of
words form groups of eight; group and class are predicted from hashed n-gram and skip features
of the two words before, so each softmax has few terms; the weights are one table of fixed size, trained by distributed gradient updates: tasks descend on their share of all training
texts, and the tables are averaged, each row weighted by how often a task saw its feature. The most frequent words are classes of their own, the end of the text is one,
and all other words share classes by the hash of their last two bytes.

With ``fit(..., word_context=True)`` context predicts the word inside its class as well: the words
of a class are leaves of a Huffman tree of eight branches, and each step down it is a softmax of
hashed features, trained like the other two. Words that are not among the frequent ones are leaves
by hash cell; inside a cell each has its smoothed share. Without it, every word has its share of
the class, the maximum-entropy solution for unigram features.

Word counts cover all training texts. A bounded number of frequent words goes to every task;
the counts of all other words are joined.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import slices, stored, with_columns_of, word_list

#: Classes: single words, the end of the text, and shared ones by suffix.
SINGLES, SHARED = 31, 32
END_CLASS, CLASSES = SINGLES, SINGLES + 1 + SHARED
#: Classes per group; a feature has one row of weights for the groups and one for each group's classes.
GROUP = 8
GROUPS = CLASSES // GROUP
#: Rows of the weight table, rows per message, and words that go to every task.
HASH_BITS, BLOCK, HEAD_WORDS, HEAD_BYTES = 14, 128, 1 << 17, 64
#: The end of the text, as a token; no word is empty.
END = b""
BATCH, COUNTER_KEYS = 8192, 1 << 18
#: Bytes of text that are cut into words and looked up at once; one text may be longer.
READ_BYTES = 1 << 22
#: Bits of the least and largest number of cells of rare words per shared class, and of rows for steps
#: down the trees of words; between them, both grow with the vocabulary.
CELL_BITS, STEP_BITS = (2, 10), (12, 17)
ADDED = 0.1
_FEATURES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: Logits are held within these bounds, so their exponentials are finite.
LARGEST = np.float32(60)


def before(hashes: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the one before that, for every token and the end of one text.

    With ``starts``, of several texts one after the other, their ends included in ``hashes``.
    """
    padded = np.concatenate([np.zeros(2, np.uint32), hashes.astype(np.uint32)])
    first, second = padded[1:], padded[:-1]
    if starts is not None:
        first, second = first[:-1], second[:-1].copy()
        first[starts] = second[starts] = 0
        second[starts[starts + 1 < len(second)] + 1] = 0
    return first, second


def features_of(hashes: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Rows of the weight table for every token and the end: the word before, the one before
    that (skipping a word), and both together. Products wrap at 32 bits."""
    first, second = before(hashes, starts)
    mixed = np.empty((len(first), 3), np.uint32)
    for i, key in enumerate((first, second, first * np.uint32(31) + second)):
        column = (key + np.uint32(1)) * _FEATURES[i]
        column ^= column >> np.uint32(15)
        column *= np.uint32(0x2C1B3C6D)
        mixed[:, i] = column >> np.uint32(32 - HASH_BITS)
    return mixed


@dataclass
class Trees:
    """The trees of words in their classes: paths of leaves, log shares, and the table of weights.

    Leaves are the frequent words and the end by number, then the cells of rare words. Leaf ``i``
    has the steps ``first[i]`` to ``first[i + 1]``, each a node and the branch taken there.
    """

    first: np.ndarray
    nodes: np.ndarray
    branches: np.ndarray
    bias: np.ndarray
    cell_totals: np.ndarray
    weights: np.ndarray

    @property
    def cells(self) -> int:
        """Cells of rare words per shared class."""
        return len(self.cell_totals) // SHARED

    def steps(self, leaves: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each step down to each token's leaf: the token, rows of weights, node and branch."""
        begin = self.first[leaves]
        lengths = self.first[leaves + 1] - begin
        token = np.repeat(np.arange(len(leaves)), lengths)
        at = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths - begin, lengths)
        nodes = self.nodes[at]
        rows = (keys[token] ^ (nodes.astype(np.uint32) * np.uint32(0x9E3779B1))[:, None]) * np.uint32(0x2C1B3C6D)
        rows >>= np.uint32(32 - int(len(self.weights)).bit_length() + 1)
        return token, rows.astype(np.int32), nodes, self.branches[at]


def trees_of(leaves_of: list[list[int]], weights_of: np.ndarray, bits: int) -> Trees:
    """Huffman trees of eight branches, one for each list of leaves."""
    above = np.full(len(weights_of), -1, np.int64)
    branch = np.zeros(len(weights_of), np.int64)
    parents, places, shares = [], [], []
    for leaves in leaves_of:
        heap = [(float(weights_of[leaf]), i, leaf, True) for i, leaf in enumerate(leaves)]
        heapq.heapify(heap)
        size, count = (len(heap) - 2) % (GROUP - 1) + 2, len(heap)
        while len(heap) > 1:
            taken = [heapq.heappop(heap) for _ in range(min(size, len(heap)))]
            size, node = GROUP, len(parents)
            total = sum(x[0] for x in taken)
            parents.append(-1)
            places.append(0)
            shares.append([math.log(x[0] / total) for x in taken] + [-float(LARGEST)] * (GROUP - len(taken)))
            for place, (_, _, which, is_leaf) in enumerate(taken):
                if is_leaf:
                    above[which], branch[which] = node, place
                else:
                    parents[which], places[which] = node, place
            heapq.heappush(heap, (total, count, node, False))
            count += 1
    upwards, place_of = np.array([*parents, -1], np.int64), np.array([*places, 0], np.int64)
    leaf, node, at = np.flatnonzero(above >= 0), above[above >= 0], branch[above >= 0]
    owners, nodes, taken = [], [], []
    while len(leaf):
        owners.append(leaf)
        nodes.append(node)
        taken.append(at)
        at, node = place_of[node], upwards[node]
        leaf, at, node = leaf[node >= 0], at[node >= 0], node[node >= 0]
    owner = np.concatenate([*owners, np.zeros(0, np.int64)])
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(weights_of)))])
    every = [np.concatenate([*x, np.zeros(0, np.int64)])[order].astype(np.int32) for x in (nodes, taken)]
    bias = np.array(shares, np.float32).reshape(-1, GROUP)
    return Trees(first, *every, bias, np.zeros(0), np.zeros((1 << bits, GROUP), np.float32))


@dataclass
class Model:
    """Frequent words with counts and classes, class totals, and the weight table.

    ``trees`` chooses the word in its class by context; without it words have their shares.
    """

    words: dict[bytes, int]
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    totals: np.ndarray
    tokens: int
    vocabulary: int
    weights: np.ndarray
    trees: Trees | None = None

    @property
    def bias(self) -> np.ndarray:
        """Log shares: of the groups in the first row, of each group's classes in the others."""
        by_group = self.totals.reshape(GROUPS, GROUP)
        return np.log(np.concatenate([[by_group.sum(axis=1)], by_group])).astype(np.float32)

    def read(self, texts: pa.Array) -> Tokens:
        """The tokens of texts one after the other, each with its end."""
        words, starts = words_of(texts)
        is_word = np.ones(len(words) + len(texts), bool)
        is_word[starts[1:] - 1] = False
        numbers = np.full(len(is_word), self.words[END], np.int32)
        found = pc.index_in(words, value_set=pa.array(list(self.words), pa.binary()))
        numbers[is_word] = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
        hashes, classes = self.hashes[numbers], self.classes[numbers]
        rare = np.flatnonzero(numbers < 0)
        unseen = words.filter(pc.is_null(found)).to_pylist()
        hashes[rare] = np.fromiter(map(crc32, unseen), np.uint32, len(rare))
        classes[rare] = np.fromiter(map(shared_class, unseen), np.int32, len(rare))
        leaves = numbers.copy()
        if self.trees:
            leaves[rare] = len(self.words) + cells_of(classes[rare], hashes[rare], self.trees.cells)
        own = [features_of(hashes, starts[:-1]).astype(np.int32), classes, numbers, leaves, step_keys(hashes, starts[:-1])]
        return Tokens(*own, starts, unseen)


@dataclass
class Tokens:
    """Features, class, number (-1: not a frequent word), leaf and keys of steps of each token of some texts.

    Text ``i`` has the tokens ``starts[i]`` to ``starts[i + 1]``; ``unseen`` are the words without a number.
    """

    features: np.ndarray
    classes: np.ndarray
    numbers: np.ndarray
    leaves: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    unseen: list[bytes]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of :func:`word_list` of all texts, and where each text starts if it has one end more.

    The last of the starts is where the next text would.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    pieces, owner = split.flatten(), pc.list_parent_indices(split).to_numpy()
    is_word = pc.greater(pc.binary_length(pieces), 0)
    words = pieces.filter(is_word).cast(pa.binary())
    sizes = np.bincount(owner[is_word.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return words, np.concatenate([[0], np.cumsum(sizes + 1)])


def chunks_of(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``READ_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts.cast(pa.string())), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    borders = np.flatnonzero(np.diff(ends // READ_BYTES)) + 1
    for start, end in zip([0, *borders.tolist()], [*borders.tolist(), len(texts)]):
        if end > start:
            yield texts[start:end]


def shared_class(word: bytes) -> int:
    return SINGLES + 1 + crc32(word[-2:]) % SHARED


def cells_of(classes: np.ndarray, hashes: np.ndarray, cells: int) -> np.ndarray:
    """Cells of rare words, by class and the upper bits of the word's hash."""
    return (classes - SINGLES - 1) * cells + (hashes.astype(np.int64) >> 16) % cells


def step_keys(hashes: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """For every token and the end, what the rows of its steps start from: the word before, and the two before."""
    first, second = before(hashes, starts)
    return np.column_stack([first * np.uint32(0x85EBCA77), (first * np.uint32(31) + second + np.uint32(1)) * np.uint32(0xC2B2AE3D)])


def _rows(features: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table that hold each token's group weights and class weights."""
    base = features * (GROUPS + 1)
    return base, base + 1 + (classes // GROUP)[:, None]


def _chances(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances that are not yet divided by their sums, and the sums."""
    logits = bias + weights.take(rows[:, 0], 0)
    for i in range(1, rows.shape[1]):
        logits += weights.take(rows[:, i], 0)
    chance = np.exp(np.clip(logits, -LARGEST, LARGEST, out=logits), out=logits)
    return chance, chance @ np.ones(GROUP, np.float32)


def _log_chance(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural logarithm of the wanted branch's chance in each softmax."""
    chance, total = _chances(rows, weights, bias)
    return np.log((chance[np.arange(len(rows)), wanted] / total).astype(np.float64))


def _log_probability(features: np.ndarray, classes: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Natural logarithm of P(group | context) * P(class | group, context) of each token."""
    of_group, of_class = _rows(features, classes)
    group = classes // GROUP
    outer = _log_chance(of_group, weights, bias[0], group)
    return outer + _log_chance(of_class, weights, bias.take(1 + group, 0), classes % GROUP)


def _log_steps(trees: Trees, leaves: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Natural logarithm of P(leaf | class, context) of each token; 0 where the class is one word."""
    token, rows, nodes, branches = trees.steps(leaves, keys)
    return np.bincount(token, _log_chance(rows, trees.weights, trees.bias.take(nodes, 0), branches), len(leaves))


def _word_counts(texts: DataFrame) -> DataFrame:
    """``token, n`` over all texts; combined within tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def close() -> Iterator[pa.RecordBatch]:
            tokens, numbers = list(held.keys()), list(held.values())
            held.clear()
            for part in slices(len(tokens), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[part], pa.binary()), pa.array(numbers[part], pa.int64())], names=["token", "n"]
                )

        for batch in batches:
            for text in batch.column(0):
                words = word_list(text.as_py())
                for part in slices(len(words), COUNTER_KEYS):
                    held.update(words[part])
                    if len(held) >= COUNTER_KEYS:
                        yield from close()
                held[END] += 1
        yield from close()

    return texts.mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame) -> list:
    """At most ``HEAD_WORDS`` of the most frequent tokens: all above one level of frequency."""
    level = F.floor(F.log2("n") * 8).cast("int")
    short = counts.where(F.length("token") <= HEAD_BYTES).withColumn("level", level)
    sizes = {row.level: row.size for row in short.groupBy("level").agg(F.count("*").alias("size")).collect()}
    total, least = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > HEAD_WORDS:
            break
        least = at
    rows = short.where((F.col("level") >= least) & (F.col("token") != F.lit(END))).select("token", "n").collect()
    return sorted(((bytes(row.token), row.n) for row in rows), key=lambda x: (-x[1], x[0]))


def _word_trees(counts: DataFrame, kind: Column, model: Model) -> Trees:
    """Trees of the classes that words share: frequent words, and cells with the counts of the others."""
    bits = model.vocabulary.bit_length()
    of_cells, of_steps = (min(max(bits - less, least), most) for less, (least, most) in ((8, CELL_BITS), (0, STEP_BITS)))
    size = 1 << of_cells
    cell = (F.col("kind") - (SINGLES + 1)) * size + F.shiftright(F.crc32("token"), 16) % size
    found = (
        counts.select("token", "n", kind.cast("int").alias("kind"))
        .where(F.col("kind") > END_CLASS)
        .groupBy(cell.alias("cell"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        .collect()
    )
    cells = np.zeros((2, SHARED * size), np.int64)
    for row in found:
        cells[:, row.cell] = row.n, row.words
    shared = np.flatnonzero(model.classes > END_CLASS)
    own = cells_of(model.classes[shared], model.hashes[shared], size)
    np.subtract.at(cells[0], own, model.counts[shared])
    np.subtract.at(cells[1], own, 1)
    totals = cells[0] + ADDED * (cells[1] + 1)
    leaves: list[list[int]] = [[] for _ in range(SHARED)]
    for leaf in shared.tolist():
        leaves[model.classes[leaf] - SINGLES - 1].append(leaf)
    for i, of_class in enumerate(leaves):
        of_class.extend(range(len(model.words) + i * size, len(model.words) + (i + 1) * size))
    return replace(trees_of(leaves, np.concatenate([model.counts + ADDED, totals]), of_steps), cell_totals=totals)


def fit(
    texts: DataFrame, text_column: str = "text", rounds: int = 1, rate: float = 0.4, word_context: bool = False
) -> tuple[Model, DataFrame]:
    """The model and its table of all word counts ``(token, n)``, learned from every row.

    With ``word_context`` context predicts words inside their classes, too.
    """
    texts = texts.select(F.col(text_column).cast("string").alias("text"))
    counts = stored(_word_counts(texts), "lm-counts")
    head = _frequent(counts)
    singles = [word for word, _ in head[:SINGLES]]
    suffix = F.crc32(F.substring("token", -2, 2)) % SHARED + SINGLES + 1
    kind = F.when(F.col("token") == F.lit(END), END_CLASS).otherwise(suffix)
    if singles:
        place = F.array_position(F.array(*[F.lit(word) for word in singles]), F.col("token"))
        kind = F.when(place > 0, place - 1).otherwise(kind)
    sums = counts.groupBy(kind.cast("int").alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    totals, tokens, vocabulary = np.zeros(CLASSES), 0, 0
    totals[END_CLASS] = totals[-SHARED:] = ADDED
    for row in sums.collect():
        totals[row.kind] += row.n + ADDED * (row.words - (row.kind == END_CLASS))
        tokens, vocabulary = tokens + row.n, vocabulary + row.words
    totals[: len(singles)] = np.maximum(totals[: len(singles)], ADDED)
    totals[len(singles) : SINGLES] = 1e-30
    ends = counts.where(F.col("token") == F.lit(END)).select("n").first()
    words = {word: i for i, (word, _) in enumerate(head)} | {END: len(head)}
    classes = [i if i < SINGLES else shared_class(word) for i, (word, _) in enumerate(head)] + [END_CLASS]
    hashes = np.array([crc32(word) for word in words], np.uint32)
    numbers = np.array([n for _, n in head] + [ends.n if ends else 0], np.int64)
    weights = np.zeros(((GROUPS + 1) << HASH_BITS, GROUP), np.float32)
    model = Model(words, hashes, numbers, np.array(classes, np.int32), totals, tokens, vocabulary, weights)
    if word_context:
        model.trees = _word_trees(counts, kind, model)
    for number in range(rounds):
        learned = _averaged(texts, model, rate / (1 + number))
        model.weights = learned[: len(weights)]
        if model.trees:
            model.trees.weights = learned[len(weights) :]
    return model, counts


def _averaged(texts: DataFrame, model: Model, rate: float) -> np.ndarray:
    """One round of gradient updates over all texts: weights of groups and classes, then of steps."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, bias = shared.value, shared.value.bias
        weights, trees, classes_end = _table(start), start.trees, len(start.weights)
        squares = np.full(len(weights), 1e-2, np.float32)
        seen = np.zeros(len(weights), np.float32)
        touched, place_of = np.zeros(len(weights), bool), np.zeros(len(weights), np.intp)
        branch = np.arange(GROUP)

        def update(rows: np.ndarray, wanted: np.ndarray, own_bias: np.ndarray) -> None:
            # Only the rows of the table that occur are worked on, as a small table of their own.
            every = rows.ravel(order="F")
            touched[every] = True
            at = np.flatnonzero(touched)
            touched[at] = False
            place_of[at] = np.arange(len(at))
            places = place_of.take(every)
            own, columns = weights.take(at, 0), places.reshape(rows.shape[1], len(rows))
            gradient, total = _chances(columns.T, own, own_bias)
            gradient /= total[:, None]
            gradient[np.arange(len(rows)), wanted] -= 1
            sums, flat = np.zeros(own.size, np.float32), gradient.ravel()
            for column in columns:
                np.add.at(sums, (column[:, None] * GROUP + branch).ravel(), flat)
            change = sums.reshape(-1, GROUP)
            spread = squares.take(at) + np.einsum("ij,ij->i", change, change) / GROUP
            squares[at] = spread
            change *= (rate / np.sqrt(spread))[:, None]
            own -= change
            weights[at] = own
            seen[at] += np.bincount(places, minlength=len(at)).astype(np.float32)

        for features, classes, leaves, keys in _batches(batches, start):
            of_group, of_class = _rows(features, classes)
            group = classes // GROUP
            update(of_group, group, bias[0])
            update(of_class, classes % GROUP, bias.take(1 + group, 0))
            if trees:
                _, rows, nodes, branches = trees.steps(leaves, keys)
                update(rows + np.int32(classes_end), branches, trees.bias.take(nodes, 0))
        for block in range(len(weights) // BLOCK):
            rows = slice(block * BLOCK, (block + 1) * BLOCK)
            if seen[rows].any():
                message = np.concatenate([(weights[rows] * seen[rows, None]).ravel(), seen[rows]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([message.astype(np.float32).tobytes()])],
                    names=["block", "message"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, message in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(message.as_py(), np.float32).astype(np.float64)
                sums[block] = sums[block] + values if block in sums else values
        for block, values in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([values.tobytes()])], names=["block", "message"]
            )

    messages = texts.mapInArrow(descend, "block int, message binary")
    weights = _table(model)
    for row in messages.repartition("block").mapInArrow(add, "block int, message binary").collect():
        values = np.frombuffer(row.message, np.float64)
        table, seen = values[:-BLOCK].reshape(BLOCK, GROUP), values[-BLOCK:]
        at = np.flatnonzero(seen)
        weights[row.block * BLOCK + at] = (table[at] / seen[at, None]).astype(np.float32)
    return weights


def _table(model: Model) -> np.ndarray:
    """A copy of all weights: of groups and classes, then of steps."""
    return np.concatenate([model.weights, model.trees.weights]) if model.trees else model.weights.copy()


def _batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[list[np.ndarray]]:
    """Features, classes, leaves and keys of some thousand tokens at a time."""
    rest: list[list[np.ndarray]] = []
    held = 0
    for batch in batches:
        for texts in chunks_of(batch.column(0)):
            tokens = model.read(texts)
            cuts = [0]
            for start, end in zip(tokens.starts.tolist(), tokens.starts[1:].tolist()):
                for part in slices(end - start, BATCH):
                    held += part.stop - part.start
                    if held >= BATCH:
                        cuts.append(start + part.stop)
                        held = 0
            own = (tokens.features, tokens.classes, tokens.leaves, tokens.keys)
            for start, end in zip(cuts, cuts[1:]):
                rest.append([x[start:end] for x in own])
                yield [np.concatenate(x) for x in zip(*rest)]
                rest = []
            if held:
                # A copy, so that the other tokens need not be kept.
                rest.append([x[cuts[-1] :].copy() for x in own])
    if held:
        yield [np.concatenate(x) for x in zip(*rest)]


def score(docs: DataFrame, model: Model, counts: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with token numbers and scores of the whole text.

    Adds ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training),
    ``base_score`` (log10 probability under smoothed unigrams) and ``score`` (log10 probability
    under the model). NULL texts are empty texts. Repeated rows stay; input columns with these
    names are replaced; an empty table gives an empty result. Counts of rare words come by a
    join on the word, once per word and document.
    """
    added = ("n_tokens", "n_known", "base_score", "score")
    kept = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base_total = math.log10(model.tokens + ADDED * (model.vocabulary + 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        log_counts, log_totals = np.log10(model.counts + ADDED), np.log10(model.totals)
        bias, trees = model.bias, model.trees
        log_cells = np.log10(trees.cell_totals) if trees else None
        for batch in batches:
            sizes, known, logs, scores = [], [], [], np.zeros(batch.num_rows)
            tokens, times, ends = [], [], [0]

            def add(own: Tokens, part: slice, owners: np.ndarray) -> None:
                features, classes, numbers, leaves, keys = (
                    x[part] for x in (own.features, own.classes, own.numbers, own.leaves, own.keys)
                )
                found = _log_probability(features, classes, model.weights, bias)
                if trees:
                    found += _log_steps(trees, leaves, keys)
                found /= math.log(10)
                if trees:
                    # The counts are in the sum already: of a frequent word its own, of a rare one its share of a cell.
                    alone = classes <= END_CLASS
                    found -= np.where(alone, log_totals[classes], np.where(numbers >= 0, log_counts[numbers], 0))
                    rare = numbers < 0
                    found[rare] -= log_cells[leaves[rare] - len(model.words)]
                else:
                    found -= log_totals[classes]
                scores[:] += np.bincount(owners, found, len(scores))

            for texts in chunks_of(batch.column("_read")):
                own = model.read(texts)
                numbers, first = own.numbers, own.starts[:-1]
                owners = np.repeat(np.arange(len(texts)) + len(sizes), np.diff(own.starts))
                for part in slices(len(numbers), BATCH):
                    add(own, part, owners[part])
                frequent = numbers >= 0
                sizes += np.diff(own.starts).tolist()
                known += np.add.reduceat(frequent & (model.counts[numbers] > 0), first, dtype=np.int64).tolist()
                logs += np.add.reduceat(np.where(frequent, log_counts[numbers], 0.0), first).tolist()
                borders = np.concatenate([[0], np.cumsum(~frequent)])[own.starts].tolist()
                for start, end in zip(borders, borders[1:]):
                    rare = Counter(own.unseen[start:end])
                    tokens += rare.keys()
                    times += rare.values()
                    ends.append(len(tokens))
            pairs = pa.StructArray.from_arrays([pa.array(tokens, pa.binary()), pa.array(times, pa.int64())], ["token", "times"])
            yield with_columns_of(
                batch,
                ["_row", *kept],
                n_tokens=pa.array(sizes, pa.int64()),
                part_known=pa.array(known, pa.int64()),
                part_log=pa.array(logs, pa.float64()),
                part_score=pa.array(scores),
                tail=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), *kept)
    schema = numbered.withColumns(
        {
            "n_tokens": F.lit(0).cast("long"),
            "part_known": F.lit(0).cast("long"),
            "part_log": F.lit(0.0),
            "part_score": F.lit(0.0),
            "tail": F.array().cast("array<struct<token:binary,times:long>>"),
        }
    ).schema
    texts = docs.select(
        F.monotonically_increasing_id().alias("_row"), *kept, F.col(text_column).cast("string").alias("_read")
    )
    parts = stored(texts.mapInArrow(read, schema), "lm-parts")
    rare = parts.select("_row", F.explode("tail").alias("x")).select("_row", "x.token", "x.times")
    count = F.coalesce("n", F.lit(0))
    rest = (
        rare.join(counts, "token", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(count + ADDED)).alias("rest_log"),
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        )
    )
    logs = F.col("part_log") + F.coalesce("rest_log", F.lit(0.0))
    return parts.drop("tail").join(rest, "_row", "left").select(
        *kept,
        "n_tokens",
        (F.col("part_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        (logs - F.col("n_tokens") * base_total).alias("base_score"),
        (logs + F.col("part_score")).alias("score"),
    )
