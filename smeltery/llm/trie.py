"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Its key is the exclusive or of 128-bit hashes of
(place, role, text) of the turns on the way, so that the keys along a conversation are a running
aggregate, and a long conversation is cut into blocks whose aggregates are combined.

Totals: rounds of joins shrink the tree. A round rakes all leaves into their parents and
compresses chains: a node with one child left is spliced out, its child inherits its parent and
takes what the node would have added along. Which nodes of a chain go is drawn by a hash, so that
no two neighbours do, and a chain of n nodes is gone after O(log n) rounds. Then the rounds are
walked backwards: a spliced node's total is its child's and what it had itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.common import stored

#: Two longs that name a node.
KEY, PARENT, ROOT = ("a", "b"), ("pa", "pb"), 0
#: Conversations of a family share the first turns of its first member; at most MOST - 1 of them.
FAMILY, MOST = 5, 9


def _turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _before(window_key: str) -> Window:
    """Earlier blocks of the same conversation."""
    return Window.partitionBy(window_key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, block, place, n`` and hashes and bytes of each turn; places count from 1, n is the last.

    Turns are sorted by range over all conversations, so that blocks are ranges and a conversation
    of any length is spread over several; a place is the place in the block and the turns of the
    conversation in earlier blocks. Blocks are stored: they name themselves by their partition.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    light = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.md5(text).alias("digest"),
        F.xxhash64(role, text).alias("ha"),
        F.xxhash64(F.lit(1), text, role).alias("hb"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    ranged = light.repartitionByRange("conv_id", *_turn_order())
    ranged = stored(ranged.withColumn("block", F.spark_partition_id()), "trie-turns")
    sizes = ranged.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    offsets = sizes.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("size").over(_before("conv_id")), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy("conv_id")).alias("n"),
    )
    order = Window.partitionBy("conv_id", "block").orderBy(*_turn_order())
    placed = ranged.withColumn("place", F.row_number().over(order)).join(offsets, ["conv_id", "block"])
    return placed.select("conv_id", "block", (F.col("place") + F.col("offset")).alias("place"), "n", "ha", "hb", "bytes")


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % MOST


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as ``conv_id, length``, and their turns.

    A conversation c starts with the first h turns of c - c % 5 and goes on with its own turns
    after its first h, h = crc32(c) % 9. The shared turns come first, as block -1; there are
    fewer than ``MOST`` of them, and each goes to ``FAMILY`` conversations at most.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("n").alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = sizes.select("conv_id", "n", shared_turns(F.col("conv_id")).alias("h"), first.alias("first"))
    bases = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "first", "left").withColumn("shared", shared)
    convs = convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "first", "h", "shared", "length"), "trie-conversations")
    opening = turns.where(F.col("place") < MOST).select(F.col("conv_id").alias("first"), "place", "ha", "hb", "bytes")
    heads = convs.where("shared > 0").join(opening, "first").where("place <= shared")
    heads = heads.select("conv_id", F.lit(-1).alias("block"), "place", "ha", "hb", "bytes")
    own = turns.where(F.col("place") > shared_turns(F.col("conv_id")))
    parts = own.groupBy("conv_id", "block").agg(F.count("*").alias("own")).join(convs, "conv_id")
    shift = parts.select("conv_id", "block", (F.col("shared") - F.col("h")).alias("shift"))
    tails = own.join(shift, ["conv_id", "block"]).withColumn("place", F.col("place") + F.col("shift"))
    return convs.select("conv_id", "length"), heads.unionByName(tails.select(heads.columns))


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, bytes`` and the keys of each turn's node and of its parent."""
    marks = {
        "za": F.xxhash64("place", "ha", "hb"),
        "zb": F.xxhash64(F.lit(1), "hb", "place", "ha"),
    }
    marked = stored(turns.withColumns(marks).drop("ha", "hb"), "trie-marks")
    blocks = marked.groupBy("conv_id", "block").agg(*[F.bit_xor(z).alias(z) for z in marks])
    starts = blocks.select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(z).over(_before("conv_id")), F.lit(ROOT)).alias(f"s{z}") for z in marks]
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = marked.withColumns({f"r{z}": F.bit_xor(z).over(so_far) for z in marks}).join(starts, ["conv_id", "block"])
    node = [F.col(f"r{z}").bitwiseXOR(F.col(f"s{z}")) for z in marks]
    return running.select(
        "conv_id",
        F.col("place").alias("depth"),
        "bytes",
        *[x.alias(k) for x, k in zip(node, KEY)],
        *[x.bitwiseXOR(F.col(z)).alias(k) for x, z, k in zip(node, marks, PARENT)],
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return (F.col(left[0]) == F.col(right[0])) & (F.col(left[1]) == F.col(right[1]))


def _as(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def contract(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``a, b`` and the sums of ``values`` over each node's subtree, itself included.

    ``tree`` has ``a, b`` (the node), ``pa, pb`` (its parent, NULL for a root) and the values;
    any number of trees, of any depth and width. A parent of many children is reduced before the
    shuffle; each round's joins are between tables with one row per node.
    """
    kids = tree.where("pa IS NOT NULL").groupBy(*PARENT).agg(F.count("*").alias("n"))
    live = tree.join(_as(kids, "k_"), _same(KEY, ("k_pa", "k_pb")), "left").select(
        *KEY, *PARENT, F.coalesce("k_n", F.lit(0)).alias("kids"), *values, *[F.lit(0).cast("long").alias(f"e_{v}") for v in values]
    )
    rounds, live = [], stored(live, "contract-live")
    while not live.where("kids > 0").isEmpty():
        kept = stored(_rake(live, values, len(rounds)), "contract-kept")
        gone = kept.where("spliced").select(
            *KEY, "ua", "ub", *[(F.col(v) + F.col(f"u_{v}")).alias(v) for v in values]
        )
        rounds.append((live.where("kids = 0").select(*KEY, *values), gone))
        live = stored(_compress(kept, values), "contract-live")
    totals = live.select(*KEY, *values)
    for raked, gone in reversed(rounds):
        found = gone.join(_as(totals, "t_"), _same(("ua", "ub"), ("t_a", "t_b")))
        found = found.select(*KEY, *[(F.col(v) + F.col(f"t_{v}")).alias(v) for v in values])
        totals = stored(totals.unionByName(raked).unionByName(found), "contract-totals")
    return totals


def _rake(live: DataFrame, values: Sequence[str], number: int) -> DataFrame:
    """Nodes with children, richer by those that were leaves; ``spliced`` are to be compressed.

    ``ua, ub, u_...`` are key and edge of a child that is no leaf, the only one where it matters.
    """
    draw = F.xxhash64(F.lit(number), *KEY).bitwiseAND(F.lit(1))
    leaf, own = F.col("kids") == 0, live.withColumn("draw", draw)
    inner = {"ua": "a", "ub": "b", "u_draw": "draw"} | {f"u_{v}": f"e_{v}" for v in values}
    below = own.where("pa IS NOT NULL").groupBy(F.col("pa").alias("of_a"), F.col("pb").alias("of_b")).agg(
        F.count_if(leaf).alias("raked"),
        *[F.sum(F.when(leaf, F.col(v) + F.col(f"e_{v}")).otherwise(0)).alias(f"r_{v}") for v in values],
        *[F.max(F.when(~leaf, F.col(c))).alias(name) for name, c in inner.items()],
    )
    left = F.col("kids") - F.col("raked")
    chain = F.col("pa").isNotNull() & (left == 1) & (F.col("draw") == 1) & (F.col("u_draw") == 0)
    return own.join(below, _same(KEY, ("of_a", "of_b"))).select(
        *KEY,
        *PARENT,
        left.alias("kids"),
        *[(F.col(v) + F.col(f"r_{v}")).alias(v) for v in values],
        *[f"e_{v}" for v in values],
        *[c for c in inner if c != "u_draw"],
        chain.alias("spliced"),
    )


def _compress(kept: DataFrame, values: Sequence[str]) -> DataFrame:
    """What stays after splicing: a spliced node's child hangs below its parent.

    The child's edge carries what the spliced node would have passed on besides the child.
    """
    lifted = kept.where("spliced").select(
        F.col("ua").alias("l_a"),
        F.col("ub").alias("l_b"),
        *[F.col(p).alias(f"l_{p}") for p in PARENT],
        *[(F.col(v) + F.col(f"e_{v}") + F.col(f"u_{v}")).alias(f"l_{v}") for v in values],
    )
    stay = kept.where(~F.col("spliced")).join(lifted, _same(KEY, ("l_a", "l_b")), "left")
    return stay.select(
        *KEY,
        *[F.coalesce(f"l_{p}", p).alias(p) for p in PARENT],
        "kids",
        *values,
        *[F.coalesce(f"l_{v}", f"e_{v}").alias(f"e_{v}") for v in values],
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of each node, from rows in order of node and id; a node's ids per batch are a piece."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEY, "conv_id")]
        pieces: list[tuple] = []
        for key, group in groupby(zip(*columns), key=lambda row: row[:2]):
            ids = [row[2] for row in group]
            pieces.append((*key, ids[0], ",".join(map(str, ids))))
        yield _batch(pieces, {"a": pa.int64(), "b": pa.int64(), "first": pa.int64(), "ids": pa.string()})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, from rows in order of node and first id.

    Pieces flow through a node's hash one by one and are never held together.
    """
    kinds = {"a": pa.int64(), "b": pa.int64(), "ends_sha256": pa.string()}
    key, digest = None, None
    for batch in batches:
        done = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if key != (a, b):
                if digest:
                    done.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        yield _batch(done, kinds)
    if digest:
        yield _batch([(*key, digest.hexdigest())], kinds)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``a, b, ends_sha256`` from the ids that end in each node.

    Ids are sorted by range, so those of one node are written out by many tasks; what the one task
    that a node's hash needs, SHA-256 being a chain, reads is a row per batch of ids.
    """
    spread = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = spread.mapInArrow(_pieces, "a long, b long, first long, ids string")
    in_order = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return in_order.mapInArrow(_digests, "a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    ``conv_id`` (the smallest that starts with the node's turns), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree) and
    ``ends_sha256``, of the ids of the conversations that end there.

    Turns go in order of ``turn``, NULL first; ties in order of role, then of the MD5 of the
    text; repeated rows are turns of their own. NULL roles and texts are empty; rows with a NULL
    ``conv_id`` belong to no conversation and are left out. Texts are read whole, once, and only
    their hashes and sizes travel. Other columns are not looked at, whatever their names. An
    empty table has no node, not even a root.

    The ids that end in one node are sorted and joined by many tasks and hashed by one, because
    SHA-256 is a chain; they are streamed.
    """
    turns = stored(numbered_turns(conversations), "trie-places")
    convs, rows = rebuilt(turns)
    path = stored(paths(rows), "trie-paths")
    nodes = path.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").cast("long").alias("depth"),
        *[F.min(p).alias(p) for p in PARENT],
        F.count("*").alias("n_convs"),
        F.min("bytes").alias("bytes"),
    )
    at_root = [F.lit(ROOT).cast("long").alias(k) for k in KEY]
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *at_root, "conv_id", F.lit(0).cast("long").alias("depth"), *[none.alias(p) for p in PARENT], "n_convs",
        F.lit(0).cast("long").alias("bytes"),
    )
    nodes = stored(nodes.unionByName(root), "trie-nodes")
    children = nodes.where("pa IS NOT NULL").groupBy(*PARENT).agg(F.count("*").alias("n_children"))
    counted = nodes.join(_as(children, "c_"), _same(KEY, ("c_pa", "c_pb")), "left").select(
        *nodes.columns, F.coalesce("c_n_children", F.lit(0)).cast("long").alias("n_children")
    )
    counted = stored(counted, "trie-children")
    tree = counted.select(
        *KEY,
        *PARENT,
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = contract(tree, ["n_leaves", "saved_tokens"])

    ends = path.join(convs, "conv_id").where(F.col("depth") == F.col("length")).select(*KEY, "conv_id")
    ends = ends.unionByName(convs.where("length = 0").select(*at_root, "conv_id"))
    digests = _end_digests(ends)
    above = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    return (
        counted.join(totals, list(KEY))
        .join(digests, list(KEY), "left")
        .join(above, list(PARENT), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
