"""SimHash near-duplicates, searched with vantage-point trees.

A fingerprint has 64 bits. Two fingerprints within ``radius`` bits agree, in at least one of
three bit segments, within ``radius // 3`` bits, so each segment gets a vantage-point tree with
that much smaller radius. A tree node compares a segment with its vantage point: points at
distance mu or less go inside, points further than mu - r go outside. By the triangle
inequality two points within r of each other meet on at least one side; only the ring of width
r is sent to both. The leaves are the shards: all pairs inside a shard are compared on all 64
bits, and a shard returns a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.common import connected, popcount, slices, stored, with_columns_of, word_list

SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: For the wider search of candidates that are then compared by their shingles: of each wide print.
WIDE_SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Parts that the bits of a wide segment are dealt to, and bits of a shard's number that hold its value.
WIDE_PARTS, WIDE_BITS = 4, 16
#: Distinct fingerprints a leaf should hold before overlap, and the most one task compares at once:
#: fingerprints or shingles, and wide prints alone.
LEAF, UNIT, WIDE_UNIT = 512, 4096, 1 << 15
#: Most fingerprints the driver sees, to place vantage points; and the share of all it may see.
SAMPLE, SAMPLE_SHARE = 1 << 17, 0.25
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a whole text; zero when it has no word.

    Long texts are hashed in pieces, so the memory for hashes is bounded.
    """
    words = word_list(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for part in slices(n, HASHES_AT_ONCE):
        hashes = np.fromiter(
            (digest(join(words[i : i + shingle]), 42) for i in range(part.start, part.stop)),
            np.uint64,
            part.stop - part.start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


@dataclass(frozen=True)
class Similar:
    """Texts count as near copies if they share ``least`` of their distinct shingles (Jaccard).

    They are compared when their two wide prints, 128 bits, differ in ``reach`` bits at most and
    in ``within`` bits at most in one of the wide segments. Texts that share 0.8 of their
    shingles differ in 19.4 bits on average, with a standard deviation of 4.1.
    """

    shingle: int = 5
    least: float = 0.8
    reach: int = 32
    within: int = 1


@dataclass
class Tree:
    """A vantage-point tree over one segment; leaves have ``inside`` -1 and a shard number."""

    shift: int
    width: int
    vantage: np.ndarray
    mu: np.ndarray
    inside: np.ndarray
    outside: np.ndarray
    shard: np.ndarray

    def segment(self, prints: np.ndarray) -> np.ndarray:
        return (prints >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)

    def route(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and shards; a row is repeated for each shard it belongs to."""
        values = self.segment(prints)
        rows, nodes = np.arange(len(prints)), np.zeros(len(prints), np.int64)
        done_rows, done_shards = [], []
        while len(rows):
            leaf = self.inside[nodes] < 0
            done_rows.append(rows[leaf])
            done_shards.append(self.shard[nodes[leaf]])
            rows, nodes = rows[~leaf], nodes[~leaf]
            far = popcount(values[rows] ^ self.vantage[nodes]).astype(np.int64)
            within, beyond = far <= self.mu[nodes], far > self.mu[nodes] - radius
            rows, nodes = (
                np.concatenate([rows[within], rows[beyond]]),
                np.concatenate([self.inside[nodes[within]], self.outside[nodes[beyond]]]),
            )
        return np.concatenate(done_rows), np.concatenate(done_shards)


def grow_tree(sample: np.ndarray, shift: int, width: int, leaf: int, first_shard: int) -> Tree:
    """Split a sample at the median distance from a vantage point until ``leaf`` are left.

    Of a few sample points the one with the widest spread of distances becomes the vantage point.
    """
    values = (sample >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    nodes: list[list[int]] = []
    todo, shard = [(np.sort(values), -1, 0)], first_shard
    while todo:
        part, parent, side = todo.pop()
        here = len(nodes)
        nodes.append([0, 0, -1, -1, -1])
        if parent >= 0:
            nodes[parent][side] = here
        best = None
        if len(part) > leaf:
            for point in part[:: max(1, len(part) // 8)][:8]:
                far = popcount(part ^ point).astype(np.int64)
                if best is None or far.var() > best[1].var():
                    best = (point, far)
        if best is None or best[1].min() == best[1].max():
            nodes[here][4] = shard
            shard += 1
            continue
        point, far = best
        mu = min(int(np.median(far)), int(far.max()) - 1)
        nodes[here][:2] = [int(point), mu]
        todo += [(part[far <= mu], here, 2), (part[far > mu], here, 3)]
    columns = np.array(nodes, dtype=np.int64).T
    return Tree(shift, width, columns[0].astype(np.uint64), *columns[1:])


def _spanning(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``radius`` bits."""
    parent = list(range(len(prints)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for rows in slices(len(prints), 256):
        rest = prints[rows.start :]
        near = popcount(prints[rows, None] ^ rest[None, :]) <= radius
        for i, j in np.argwhere(np.triu(near, 1)).tolist():
            a, b = find(rows.start + i), find(rows.start + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(rows.start + i)
                right.append(rows.start + j)
    return prints[left], prints[right]


def _in_parts(routed: DataFrame, held: DataFrame, names: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """The rows ``shard, *names`` with their ``unit``; and of each shard the ``parts`` it was cut into.

    Shards that hold more than ``most`` rows are cut into parts, and every two parts meet in one unit.
    """
    cut = F.ceil(F.col("held") / most).cast("int").alias("parts")
    parts = stored(held.select("shard", "held", cut), "simhash-parts")
    part = F.pmod(F.xxhash64(*names), F.col("parts")).cast("int")
    unit = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.least(other, F.col("part")) * F.col("parts") + F.greatest(other, F.col("part")),
    )
    work = routed.join(F.broadcast(parts.drop("held")), "shard").withColumn("part", part)
    return work.select("shard", *names, F.explode(unit).alias("unit")), parts


def _units(prints: DataFrame, segments: tuple[tuple[int, int], ...], within: int) -> DataFrame:
    """The rows ``fp`` of ``prints`` with ``shard, unit``, from a tree for each of the segments.

    Two rows that differ in ``within`` bits at most in a segment meet in at least one unit of its
    tree. Shards that hold more than ``UNIT`` rows (equal or close segments) are cut; units are
    dealt to tasks one by one.

    Rows are routed twice, once to count the shards and once to send them, because routing is
    cheaper than keeping what it gives. The counts are broadcast: a tree has SAMPLE / 8 shards at
    most.
    """
    spark = prints.sparkSession
    n = prints.count()
    share = min(SAMPLE_SHARE, SAMPLE / max(n, 1))
    scale = 1 << 20
    seen = prints.where(F.pmod(F.xxhash64("fp"), F.lit(scale)) < int(share * scale)).select("fp").toPandas()
    leaf = max(8, int(LEAF * share))
    trees, shards = [], 0
    sample = seen["fp"].to_numpy(np.int64).view(np.uint64)
    for shift, width in segments:
        trees.append(grow_tree(sample, shift, width, leaf, shards))
        shards = int(trees[-1].shard.max()) + 1
    shared = spark.sparkContext.broadcast(trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in shared.value:
                rows, shard = tree.route(values, within)
                yield with_columns_of(batch.take(pa.array(rows)), ["fp"], shard=pa.array(shard))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shards, np.int64)
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in shared.value:
                held += np.bincount(tree.route(values, within)[1], minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["shard", "held"])

    routed = prints.mapInArrow(route, "fp long, shard long")
    held = prints.mapInArrow(counted, "shard long, held long").groupBy("shard").agg(F.sum("held").alias("held"))
    return _in_parts(routed, held, ["fp"], UNIT)[0].repartition("shard", "unit")


def segment_masks(width: int, within: int) -> list[int]:
    """Masks of a segment's bits: what differs in ``within`` bits at most lies inside one of them."""
    parts = [sum(1 << bit for bit in range(first, width, WIDE_PARTS)) for first in range(WIDE_PARTS)]
    return [sum(some) for some in combinations(parts, min(within, WIDE_PARTS))]


def _close(prints: DataFrame, within: int) -> DataFrame:
    """The rows ``p, q, root`` of ``prints`` once for each shard that they belong to.

    A shard holds the rows that agree in a wide segment but for the bits of one of its masks, so two
    rows that differ in ``within`` bits at most in a segment meet in one of its shards. A row has
    one shard per segment and mask, 40 for one bit, however many rows there are.
    """
    shards = []
    for column in ("p", "q"):
        for shift, width in WIDE_SEGMENTS:
            for mask in segment_masks(width, within):
                kept = ((1 << width) - 1) & ~mask
                value = F.shiftrightunsigned(column, shift).bitwiseAND(F.lit(kept).cast("long"))
                shards.append(value.bitwiseOR(F.lit(len(shards) << WIDE_BITS).cast("long")))
    return prints.select("p", "q", "root", F.explode(F.array(*shards)).alias("shard"))


def _dealt(routed: DataFrame, most: int) -> DataFrame:
    """The rows ``p, q, root, shard`` with ``unit``, in ``lot`` of about ``most`` rows: a lot has whole units."""
    held = routed.groupBy("shard").agg(F.count("*").alias("held"))
    work, parts = _in_parts(routed, held, ["p", "q", "root"], most)
    lots = -(-(parts.agg(F.sum(F.col("held") * F.col("parts"))).first()[0] or 1) // most)
    return work.withColumn("lot", F.pmod(F.xxhash64("shard", "unit"), F.lit(lots)))


def _compared(units: DataFrame, compare) -> DataFrame:
    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        a, b = compare(np.unique(group["fp"].to_numpy(np.int64)).view(np.uint64))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return units.groupBy("shard", "unit").applyInPandas(pairs, "a long, b long")


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``(a, b)`` that join all distinct fingerprints ``fp`` within ``radius`` bits.

    Every link between two different fingerprints is found: the links returned connect the same
    components as all pairs would.
    """
    units = _units(prints.select("fp"), SEGMENTS, radius // len(SEGMENTS))
    return _compared(units, lambda values: _spanning(values, radius))


def candidates(prints: DataFrame, beyond: int, radius: int) -> DataFrame:
    """All pairs ``(a, b)`` of distinct fingerprints more than ``beyond`` and at most ``radius`` bits apart.

    Their number grows with the square of a family, so this is for small tables;
    :func:`similar_links` makes no pairs.
    """

    def between(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [np.zeros((0, 2), np.int64)]
        for rows in slices(len(values), 256):
            far = popcount(values[rows, None] ^ values[None, :])
            found.append(np.argwhere((far > beyond) & (far <= radius)) + [rows.start, 0])
        at = np.concatenate(found)
        return values[at[:, 0]], values[at[:, 1]]

    units = _units(prints.select("fp"), WIDE_SEGMENTS, radius // len(WIDE_SEGMENTS))
    pairs = _compared(units, between)
    return pairs.where("a < b").distinct()


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Distinct hashes of a whole text's shingles."""
    words, join = word_list(text), b" ".join
    starts = range(max(1, len(words) - shingle + 1)) if words else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(join(words[i : i + shingle]), 42) for i in starts), np.uint64))


def wide_prints(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit SimHashes of distinct shingle hashes, the second over the hashes mixed anew."""
    mixed = hashes ^ (hashes >> np.uint64(30))
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    prints = []
    for values in (hashes, mixed):
        ones = np.zeros(64, np.int64)
        for part in slices(len(values), HASHES_AT_ONCE):
            bits = np.unpackbits(values[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        prints.append(int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.int64)[0]))
    return prints[0], prints[1]


def _owned(p: np.ndarray, q: np.ndarray, rows: slice, shard: int, similar: Similar) -> np.ndarray:
    """Which pairs of ``rows`` and all rows are compared in this shard, as a matrix.

    Those within reach, where this shard's segment is the first that is close enough and its mask
    the first that holds what differs there: two rows meet in every such shard, and one comparison
    will do.
    """
    far = popcount(p[rows, None] ^ p[None, :])
    far += popcount(q[rows, None] ^ q[None, :])
    near = far <= similar.reach
    left, right = np.nonzero(near)
    if not len(left):
        return near
    masks = len(segment_masks(WIDE_SEGMENTS[0][1], similar.within))
    segment, mask = divmod(shard >> WIDE_BITS, masks)
    owned = np.ones(len(left), bool)
    for number in range(segment + 1):
        values, (shift, width) = (p, q)[number // len(WIDE_SEGMENTS)], WIDE_SEGMENTS[number % len(WIDE_SEGMENTS)]
        differ = (values[left + rows.start] ^ values[right]) >> np.uint64(shift) & np.uint64((1 << width) - 1)
        if number < segment:
            owned &= popcount(differ) > similar.within
        else:
            for place, held in enumerate(segment_masks(width, similar.within)[: mask + 1]):
                owned &= (differ & ~np.uint64(held) == 0) == (place == mask)
            owned &= popcount(differ) <= similar.within
    near[left, right] = owned
    return near


def _runs(shard: np.ndarray, unit: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each unit in a sorted lot."""
    first = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (unit[1:] != unit[:-1])]))
    return zip(first.tolist(), [*first[1:].tolist(), len(shard)])


def _rows_at_once(n: int) -> int:
    """So many rows that their matrix against all has some million entries."""
    return max(16, min(256, (1 << 21) // n))


def _hopeful(lot: pd.DataFrame, similar: Similar) -> pd.DataFrame:
    """The rows of a lot that have a row of another component to be compared with."""
    lot = lot.sort_values(["shard", "unit"], kind="stable", ignore_index=True)
    every_p, every_q = (lot[c].to_numpy(np.int64).view(np.uint64) for c in ("p", "q"))
    every_root, shard, unit = (lot[c].to_numpy(np.int64) for c in ("root", "shard", "unit"))
    hopeful = np.zeros(len(lot), bool)
    for start, end in _runs(shard, unit):
        p, q, root = every_p[start:end], every_q[start:end], every_root[start:end]
        for rows in slices(end - start, _rows_at_once(end - start)) if end - start > 1 else ():
            near = _owned(p, q, rows, int(shard[start]), similar)
            left, right = np.nonzero(near)
            hopeful[start + rows.start + left[root[left + rows.start] != root[right]]] = True
    return lot.loc[hopeful, ["p", "q", "root", "shard"]]


def _alike(lot: pd.DataFrame, similar: Similar) -> pd.DataFrame:
    """Spanning forests of the roots in each unit of a lot whose texts share enough shingles."""
    lot = lot.sort_values(["shard", "unit"], kind="stable", ignore_index=True)
    runs = _runs(lot["shard"].to_numpy(), lot["unit"].to_numpy())
    return pd.concat([_alike_in_unit(lot.iloc[start:end], similar) for start, end in runs], ignore_index=True)


def _alike_in_unit(group: pd.DataFrame, similar: Similar) -> pd.DataFrame:
    """A spanning forest of the roots in a unit whose texts share enough shingles.

    Every pair to be compared is, unless earlier links have joined it.
    """
    shard = int(group["shard"].iloc[0])
    p, q = (group[c].to_numpy(np.int64).view(np.uint64) for c in ("p", "q"))
    root, component = np.unique(group["root"].to_numpy(np.int64), return_inverse=True)
    own = component.copy()
    sets = group["hashes"].tolist()
    sizes = np.array([len(x) for x in sets])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(len(numbers), bool)
    left, right = [], []
    for rows in slices(len(group), 256):
        near = _owned(p, q, rows, shard, similar)
        for i in range(rows.start, rows.stop):
            others = np.flatnonzero(near[i - rows.start, i + 1 :]) + i + 1
            least, most = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            others = others[(component[others] != component[i]) & (least >= similar.least * most) & (least > 0)]
            if not len(others):
                continue
            here = numbers[ends[i] : ends[i + 1]]
            mark[here] = True
            for j in others.tolist():
                if component[i] != component[j]:
                    common = int(mark[numbers[ends[j] : ends[j + 1]]].sum())
                    if common >= similar.least * (sizes[i] + sizes[j] - common):
                        left.append(root[own[i]])
                        right.append(root[own[j]])
                        component[component == component[j]] = component[i]
            mark[here] = False
    return pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})


def chosen_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """One of the rows ``id, text_key, ...`` for each of ``chosen``, which says how many there are.

    ``chosen`` has ``id, text_key, n``. Rows that are the only ones of their id and text stay where
    they are or move once, to meet ``chosen``; only repeated rows are grouped, and of those the
    first by the JSON of their other columns is taken.
    """
    others = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c not in ("id", "text_key")]))
    first = F.row_number().over(Window.partitionBy("id", "text_key").orderBy(others))

    def among(some: DataFrame) -> DataFrame:
        named = some.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"))
        same = F.col("id").eqNullSafe(F.col("_id")) & F.col("text_key").eqNullSafe(F.col("_key"))
        return rows.join(named, same, "left_semi")

    repeated = among(chosen.where("n > 1")).withColumn("_place", first).where("_place = 1").drop("_place")
    return among(chosen.where("n = 1")).union(repeated)


def similar_links(
    texts: DataFrame, docs: DataFrame, text: Column, similar: Similar, carriers: DataFrame | None = None
) -> DataFrame:
    """Links ``(a, b)`` between the roots of texts that share enough of their shingles.

    ``texts`` has ``text_key, root, p, q`` of every distinct text; ``carriers`` says which rows of
    ``docs`` stand for them, by their ``id``, so that copies need not be brought together. The links returned connect the
    same roots as all pairs that :class:`Similar` compares would. Shingles are sent only to the
    units where a text has a partner; pairs are made and checked inside the unit.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x.as_py(), similar.shingle).view(np.int64) for x in batch.column("text")]
            yield with_columns_of(batch, ["text_key"], hashes=pa.array(sets, pa.list_(pa.int64())))

    units = _dealt(_close(texts.select("p", "q", "root").distinct(), similar.within), WIDE_UNIT)
    members = "p long, q long, root long, shard long"
    hopeful = units.repartition("lot").groupBy("lot").applyInPandas(lambda lot: _hopeful(lot, similar), members)
    # A row whose shard was cut can be hopeful in several units.
    hopeful = stored(hopeful.distinct(), "simhash-candidates")
    wanted = texts.join(hopeful.select("p", "q", "root").distinct(), ["p", "q", "root"], "left_semi")
    wanted = stored(wanted.select("text_key", "p", "q", "root"), "simhash-wanted")
    whole = docs.withColumns({"text_key": F.xxhash64(text), "text": text})
    if carriers is None:
        sets = whole.select("text_key", "text").join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"])
    else:
        carrying = stored(carriers.join(wanted, "text_key", "left_semi"), "simhash-carriers")
        sets = chosen_rows(whole.select("id", "text_key", "text"), carrying).select("text_key", "text")
    sets = sets.mapInArrow(hashed, "text_key long, hashes array<long>")
    sets = stored(wanted.join(sets, "text_key").select("p", "q", "root", "hashes"), "simhash-shingles")
    members = _dealt(hopeful, UNIT).join(sets, ["p", "q", "root"]).repartition("lot")
    return members.groupBy("lot").applyInPandas(lambda lot: _alike(lot, similar), "a long, b long")


def _carriers(marked: DataFrame) -> DataFrame:
    """``id, text_key, n``: for each text its smallest id, NULL if it has no other, and that id's rows."""
    copies = marked.groupBy("text_key", "id").agg(F.count("*").alias("n"))
    first = copies.groupBy("text_key").agg(F.min_by("n", "id").alias("n"), F.min("id").alias("id"), F.max("n").alias("nameless"))
    return first.select("id", "text_key", F.coalesce("n", "nameless").alias("n"))


def _classified(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, radius: int, similar: Similar | None = None
) -> DataFrame:
    """``id, fp, text_key, root, component_id`` of every document; root names the component."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() for text in batch.column("text")]
            prints = np.fromiter((fingerprint(text, shingle) for text in texts), np.uint64, batch.num_rows)
            more = {}
            if similar:
                wide = [wide_prints(shingle_hashes(text, similar.shingle)) for text in texts]
                more = {name: pa.array([x[i] for x in wide], pa.int64()) for i, name in enumerate(("p", "q"))}
            yield with_columns_of(batch, ["id", "text_key"], fp=pa.array(prints.view(np.int64)), **more)

    text = F.col(text_column).cast("string")
    ids = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    id_type = ids.schema["id"].dataType.simpleString()
    wide = ", p long, q long" if similar else ""
    marked = stored(ids.mapInArrow(hashed, f"id {id_type}, text_key long, fp long{wide}"), "simhash-prints")
    classes = stored(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-classes")

    def rooted(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
        """``nodes`` with ``root``, the smallest key that ``edges`` connect with ``key``."""
        roots = connected(edges).select(F.col("node").alias(key), F.col("root").alias("_root"))
        return nodes.join(roots, key, "left").withColumn("_root", F.coalesce("_root", key))

    classes = rooted(classes, links(classes, radius), "fp").withColumnRenamed("_root", "root")
    if similar:
        classes = stored(classes, "simhash-rooted")
        texts = marked.select("text_key", "fp", "p", "q").distinct().join(classes.select("fp", "root"), "fp")
        texts = stored(texts.select("text_key", "root", "p", "q"), "simhash-texts")
        found = similar_links(texts, ids, F.col("text"), similar, _carriers(marked))
        classes = rooted(classes, found, "root").drop("root").withColumnRenamed("_root", "root")
    smallest = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(smallest, "root").select("fp", "root", "component_id")
    return marked.select("id", "text_key", "fp").join(named, "fp")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """One row per document: id, ``fp`` (signed 64-bit fingerprint) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``radius`` bits or fewer.
    Texts that are NULL or have no word have fingerprint zero and are linked like any other;
    shorter texts than a shingle are one shingle. Equal texts share a fingerprint and are
    compared once. Repeated rows stay; a NULL id is never the smallest, and a component of
    NULL ids only has a NULL component. An empty table gives an empty result. Other columns of
    the input are not read.
    """
    found = _classified(docs, id_column, text_column, shingle, radius)
    return found.select(F.col("id").alias(id_column), "fp", "component_id")


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 4,
    radius: int = 4,
    similar: Similar | None = Similar(),
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Besides fingerprints within ``radius`` bits, texts are linked which share ``similar.least`` of
    their shingles of ``similar.shingle`` words, as :class:`Similar` describes. Of a component's rows with the smallest id the one with the smallest hash of its
    text stays, and of its repetitions one; an id may stand for texts of several components. A
    component that has NULL ids only keeps one document, that with the smallest hash of its text.
    """
    found = stored(_classified(docs, id_column, text_column, shingle, radius, similar), "simhash-components")
    copies = found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root", "id", "text_key").agg(F.count("*").alias("n"))
    chosen = copies.groupBy("root", "id").agg(F.min("text_key").alias("text_key"), F.min_by("n", "text_key").alias("n"))
    chosen = stored(chosen.select("id", "text_key", "n"), "simhash-chosen")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.xxhash64(F.col(f"`{text_column}`").cast("string")).alias("text_key")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), key, whole)
    return chosen_rows(rows, chosen).select(*[F.col(f"row.`{c}`") for c in docs.columns])
