import random

import numpy as np
import pytest
import xxhash
from corpus import DOCS, clashing, documents
from pyspark.sql import functions as F

from smeltery.llm import simhash
from smeltery.llm.common import connected


def plain_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius):
    """Root index per print, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprint_of_odd_texts():
    texts = [None, "", " \n", "One", "one two three", "É é A a", "x " * 70_000, "a b c d e f g h"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_near_duplicates_equal_all_pairs(spark):
    rows = documents()
    near = rows[0][1].split("\n")
    rows.append((500, "\n".join([*near, "the"]), "en", "src0", 1))
    found = simhash.near_duplicates(clashing(spark, rows)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = components(prints, 4)
    least = {}
    for row, root in zip(rows, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, 10**9), row[0])
    expected = sorted(
        (str(r[0]), np.uint64(p).astype(np.int64).item(), str(least.get(root))) for r, p, root in zip(rows, prints, roots)
    )
    assert sorted((str(r.doc_id), r.fp, str(r.component_id)) for r in found) == expected


def test_links_find_every_pair_in_a_tree_of_many_leaves(spark, monkeypatch):
    """Clustered fingerprints, small leaves and small units: the same components as all pairs."""
    monkeypatch.setattr(simhash, "LEAF", 32)
    monkeypatch.setattr(simhash, "UNIT", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = np.array([np.bitwise_xor.reduce([np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, k)] + [np.uint64(0)]) for k in rng.integers(0, 7, 1200)])
    prints = np.unique(np.concatenate([base, np.tile(base, 4) ^ flips, base[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    signed = [int(x) for x in prints.view(np.int64)]
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert all(bin((l.a ^ l.b) & (2**64 - 1)).count("1") <= 4 for l in links)
    place = {x: i for i, x in enumerate(signed)}
    parent = list(range(len(signed)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for link in links:
        parent[find(place[link.a])] = find(place[link.b])
    own, brute = [find(i) for i in range(len(signed))], components([int(x) for x in prints], 4)
    assert len(set(zip(own, brute))) == len(set(own)) == len(set(brute))


def test_keep_one_drops_texts_that_share_most_shingles(spark):
    rng = random.Random(8)
    rows, copies, others = [], [], []
    for i in range(40):
        words = [f"w{rng.randint(0, 400)}" for _ in range(260)]
        rows.append((i, " ".join(words), "en", "s", 1))
        close, apart = list(words), list(words)
        for k in rng.sample(range(10, 250), 3):
            close[k] = "changed"
        for k in range(0, 260, 9):
            apart[k] = "other"
        copies.append((100 + i, " ".join(close), "en", "s", 1))
        others.append((200 + i, " ".join(apart), "en", "s", 1))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows + copies + others, DOCS)).collect()}
    assert {r[0] for r in rows} <= kept and {r[0] for r in others} <= kept
    assert len(kept & {r[0] for r in copies}) <= 8


def test_candidates_are_within_reach(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 32)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = base.copy()
    for _ in range(7):
        near ^= np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)
    prints = [int(x) for x in np.unique(np.concatenate([base, near])).view(np.int64)]
    found = {(r.a, r.b) for r in simhash.candidates(spark.createDataFrame([(x,) for x in prints], "fp long"), 4, 9).collect()}
    bits = {(a, b): bin((a ^ b) & (2**64 - 1)).count("1") for i, a in enumerate(prints) for b in prints[:i]}
    wanted = {tuple(sorted(pair)) for pair, n in bits.items() if 4 < n <= 9}
    assert found == wanted


def test_keep_one_keeps_all_columns_and_one_row_per_component(spark):
    docs = clashing(spark)
    kept = simhash.keep_one(docs, similar=None)
    assert simhash.keep_one(docs).count() <= kept.count()
    assert kept.columns == docs.columns
    rows = kept.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    assert len(set(components(prints, 4))) == len(rows)
    brute = components([plain_fingerprint(r[1]) for r in documents()], 4)
    assert len(rows) == len(set(brute))
    assert all(r.doc_id is not None for r in rows if r.text != "nobody knows this one")


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)]])
def test_connected(spark, edges):
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert {x: found.get(x, x) for x in parent} == parent


def shares(a, b, shingle=5):
    """Jaccard of two texts' shingles."""
    sets = []
    for text in (a, b):
        words = text.lower().split()
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_keep_one_finds_nearly_all_texts_that_share_eight_tenths(spark):
    """Copies just above 0.8, which differ in 9.7 of 64 bits on average."""
    rng = random.Random(11)
    rows, copies = [], []
    for i in range(120):
        words = [f"w{rng.randint(0, 900)}" for _ in range(260)]
        rows.append((i, " ".join(words), "en", "s", 1))
        for k in range(10, 260, 50):
            words[k] = "changed"
        copies.append((1000 + i, " ".join(words), "en", "s", 1))
    assert all(0.8 <= shares(a[1], b[1]) < 0.85 for a, b in zip(rows, copies))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows + copies, DOCS)).collect()}
    assert {r[0] for r in rows} <= kept
    assert len(kept & {r[0] for r in copies}) <= 3


def test_similar_links_go_past_a_nearest_text_that_fails(spark):
    """Text 0 is nearest to text 1, which shares too little; text 2 is further off and shares enough."""
    texts = {i: " ".join(map(str, words)) for i, words in {0: range(100), 1: range(75, 175), 2: range(8, 108)}.items()}
    assert shares(texts[0], texts[1]) < 0.8 <= shares(texts[0], texts[2])
    docs = spark.createDataFrame(list(texts.items()), "i long, text string")
    prints = spark.createDataFrame([(0, 0), (1, 1), (2, 14)], "i long, p long")
    key = F.xxhash64("text").alias("text_key")
    table = docs.join(prints, "i").select(key, F.col("i").alias("root"), "p", F.lit(0).cast("long").alias("q"))
    found = simhash.similar_links(table, docs, F.col("text"), simhash.Similar())
    assert [tuple(sorted(r)) for r in found.collect()] == [(0, 2)]


def test_similar_links_join_what_all_pairs_join(spark, monkeypatch):
    """Dense families of texts around the limit, small leaves and units: the same as every owned pair."""
    monkeypatch.setattr(simhash, "LEAF", 16)
    monkeypatch.setattr(simhash, "UNIT", 16)
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
        for _ in range(25):
            words = list(base)
            for k in rng.sample(range(120), rng.randint(0, 4)):
                words[k] = f"x{rng.randint(0, 99)}"
            texts.append(" ".join(words))
    texts = sorted(set(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    keys = {r.i: r.k for r in docs.select("i", F.xxhash64("text").alias("k")).collect()}
    prints = [simhash.wide_prints(simhash.shingle_hashes(t, 5)) for t in texts]
    table = spark.createDataFrame([(keys[i], i, *prints[i]) for i in keys], "text_key long, root long, p long, q long")
    found = simhash.similar_links(table, docs, F.col("text"), simhash.Similar()).collect()
    assert all(shares(texts[r.a], texts[r.b]) >= 0.8 for r in found)

    def close(i, j):
        differ = [(a ^ b) & (2**64 - 1) for a, b in zip(prints[i], prints[j])]
        segments = [bin(x >> s & (1 << w) - 1).count("1") for x in differ for s, w in simhash.WIDE_SEGMENTS]
        return sum(bin(x).count("1") for x in differ) <= 32 and min(segments) <= 1 and shares(texts[i], texts[j]) >= 0.8

    def groups(pairs):
        parent = list(range(len(texts)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in pairs:
            parent[max(find(i), find(j))] = min(find(i), find(j))
        return [find(i) for i in range(len(texts))]

    every = [(i, j) for i in range(len(texts)) for j in range(i) if close(i, j)]
    assert groups((r.a, r.b) for r in found) == groups(every)


def test_keep_one_keeps_a_row_of_each_component_when_ids_repeat(spark):
    """Id 1 names two texts of their own; id 5 a copy of the text of id 3 and a text of its own."""
    rng = random.Random(2)
    a, b, c, d = (" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(50)) for _ in range(4))
    rows = [(1, a), (1, b), (3, c), (5, c), (5, d), (1, a), (3, c)]
    docs = spark.createDataFrame([(i, text, "en", "s", 1) for i, text in rows], DOCS)
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(1, a), (1, b), (3, c), (5, d)])


def test_wide_prints_have_as_many_shards_however_many_there_are(spark):
    """40 shards a row at both sizes; whoever is one bit apart in a segment meets, in one shard that owns the pair."""
    rng = np.random.default_rng(12)
    for n in (300, 6000):
        values = rng.integers(-(2**63), 2**63, (n, 2))
        values[1], values[3] = values[0], values[2] ^ (np.int64(1) << np.arange(2) * 17)
        prints = spark.createDataFrame([(int(p), int(q), i) for i, (p, q) in enumerate(values)], "p long, q long, root long")
        rows = simhash._close(prints, 1).toPandas()
        assert len(rows) == 40 * n and rows["shard"].nunique() <= 10 * (2**9 + 3 * 2**10)
    for pair in ((0, 1), (2, 3)):
        p, q = (values[list(pair), i].view(np.uint64) for i in range(2))
        shards = [set(rows.loc[rows["root"] == i, "shard"]) for i in pair]
        owned = [s for s in shards[0] & shards[1] if simhash._owned(p, q, slice(0, 2), int(s), simhash.Similar())[0, 1]]
        assert len(owned) == 1


@pytest.mark.parametrize("unit", [16, 64])
def test_similar_links_join_what_all_pairs_join_in_cut_shards(spark, monkeypatch, unit):
    monkeypatch.setattr(simhash, "WIDE_UNIT", unit)
    test_similar_links_join_what_all_pairs_join(spark, monkeypatch)
