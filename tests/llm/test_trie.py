import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from smeltery.llm import queries, trie
from smeltery.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The trie built turn by turn, totals by walking down from every node."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    own = {conv: [(t[2], t[4]) for t in sorted(ts)] for conv, ts in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        first = math.fmod(conv, 5)
        whole = tuple(own.get(conv - int(first), [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(conv)
        ends[whole].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    result = []
    for node, convs in members.items():
        leaves = saved = 0
        open_nodes = [node]
        while open_nodes:
            one = open_nodes.pop()
            leaves += not children[one]
            saved += (len(members[one]) - 1) * len(one[-1][1].encode()) if one else 0
            open_nodes += children[one]
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        result.append((min(convs), len(node), above, len(convs), len(children[node]), leaves, saved, digest))
    return sorted(result, key=str)


def conversations(seed=1, n=60):
    rng = random.Random(seed)
    text = lambda: rng.choice(["yes", "no", "", "zwölf", None, "a b c"])
    rows = [(c, t, rng.choice(["user", "assistant", None]), text()) for c in range(n) for t in range(rng.randint(1, 14))]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(12)]  # copies
    rows += [(c, None, "user", text()) for c in range(5)] + [(c, 3, "tie", text()) for c in range(8)]
    rows += [(None, 1, "user", "nobody"), (-7, 0, "user", "below"), (-5, 0, "user", "zero"), (10**15 + 1, 5, None, None)]
    return rows + rows[:6] + rows[:3]


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_trie_equals_brute_force(spark):
    rows = conversations()
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_a_conversation_with_most_rows_is_cut_into_blocks(spark):
    rows = [(50, i, "user", f"turn {i % 7}") for i in range(150)] + conversations(2, 12)
    frame = spark.createDataFrame(rows, SCHEMA)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # a table this small would be one block
    try:
        blocks = trie.numbered_turns(frame).where("conv_id = 50").select("block").distinct().count()
        found = got(trie.prefix_trie(frame))
    finally:
        spark.conf.unset(setting)
    assert blocks > 1
    assert found == plain(rows)


def test_sql_gives_the_same_rows(spark, tmp_path):
    spark.createDataFrame(conversations(3, 20), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    name = "op13_conversation_prefix_trie"
    assert difference(queries.QUERIES[name](spark, str(tmp_path)), con, queries.SQL[name]) == ""


def forest(seed):
    rng = random.Random(seed)
    chain = [(i, i - 1 if i else None) for i in range(120)]
    star = [(1000, None)] + [(1001 + i, 1000) for i in range(300)]
    bush = [(5000, None)] + [(5000 + i, 5000 + rng.randrange(max(0, i - 20), i)) for i in range(1, 300)]
    return [(i, p, rng.randint(0, 9)) for i, p in chain + star + bush + [(9000, None)]]


def test_contraction_sums_any_forest(spark):
    nodes = forest(4)
    tree = spark.createDataFrame(nodes, "a long, pa long, v long")
    tree = tree.select("a", F.lit(0).cast("long").alias("b"), "pa", (F.col("pa") * 0).alias("pb"), "v", F.lit(1).cast("long").alias("n"))
    found = {r["a"]: (r["v"], r["n"]) for r in trie.contract(tree, ["v", "n"]).collect()}
    parent, expected = {i: p for i, p, _ in nodes}, defaultdict(lambda: [0, 0])
    for i, _, v in nodes:
        at = i
        while at is not None:
            expected[at][0] += v
            expected[at][1] += 1
            at = parent[at]
    assert found == {i: tuple(x) for i, x in expected.items()}


def test_chains_shrink_geometrically(spark):
    """Raking alone would take 120 rounds."""
    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(120)], "a long, pa long")
    tree = tree.select("a", F.lit(0).cast("long").alias("b"), "pa", (F.col("pa") * 0).alias("pb"), F.lit(1).cast("long").alias("v"))
    live = tree.select("a", "b", "pa", "pb", (F.col("a") < 119).cast("long").alias("kids"), "v", F.lit(0).cast("long").alias("e_v"))
    sizes = []
    for number in range(6):
        live = stored(trie._compress(stored(trie._rake(live, ["v"], number), "kept"), ["v"]), "live")
        sizes.append(live.count())
    assert sizes[-1] < 60


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(7, None, None, None)]])
def test_odd_tables_and_clashing_names(spark, rows):
    names = "a b pa pb block place depth n ha kids e_v a.b digest bytes".split()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("own") for n in names})
    assert got(trie.prefix_trie(frame)) == plain(rows)
