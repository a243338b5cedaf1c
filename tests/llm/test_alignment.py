import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from corpus import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smeltery.llm import alignment, queries

TEXTS = [
    "Hello world, this is plain.",
    "über die Brücke — naïve café",
    "emoji 👩‍👩‍👧 and 漢字かな交じり文 ☃",
    "  leading blanks\tand\n\nlines  ",
    "<|endoftext|> <s> </s> <unk> <0x41> are text",
    "a lower ▁ block is a blank to one of them",
    "nul \0 and \x7f and \x01",
    "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 ​ zero width",
    "x",
    " ",
    "",
    None,
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
    "Hello world, this is plain.",
]


@pytest.fixture(scope="module")
def tools():
    return alignment.tokenizers(f"{alignment.FOLDER}/{alignment.FILE_A}", f"{alignment.FOLDER}/{alignment.FILE_B}")


def plain_one(text, tools):
    """Groups by common ends, links by comparing every A token with every B token."""
    if not text:
        return [], [], []
    found_a = tools.a.encode(" " + text, add_special_tokens=False).ids
    found_b = tools.b.encode(text)
    spans = []
    for ids, table in ((found_a, tools.a_bytes), (found_b, tools.b_bytes)):
        at, mine = 0, []
        for i in ids:
            mine.append((at, at + len(table[i]), i))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return [], [], []
        spans.append(mine)
    a, b = spans
    cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    groups, low = [], 0
    for cut in cuts:
        groups.append([[i for s, _, i in side if low <= s < cut] for side in spans])
        low = cut
    links = [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e]
    return spans, groups, links


def plain(texts, tools):
    found = [plain_one(t, tools) for t in texts]
    count = Counter(pair for _, _, links in found for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    result = []
    for spans, groups, links in found:
        text = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        sizes = [len(side) for side in spans] or [0, 0]
        best = sum(count[p] == most[p[0]] for p in links)
        result.append((*sizes, len(groups), len(links), digest, best, sum(count[p] for p in links)))
    return result


COLUMNS = [*alignment.COUNTS, "groups_sha256", "n_best", "count_sum"]


def test_query_equals_brute_force(spark, tools, tmp_path):
    texts = TEXTS + [t for _, t, *_ in documents(40) if t is None or len(t) < 2000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "Hello"), (3, TEXTS[3]), (3, TEXTS[3])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_cross_tokenizer_alignment(spark, str(tmp_path))
    expected = plain([t for _, t in rows], tools)
    assert sorted((str(r["doc_id"]), *[r[c] for c in COLUMNS]) for r in found.collect()) == sorted(
        (str(i), *x) for (i, _), x in zip(rows, expected)
    )
    assert sum(x[0] == 0 for x in expected) >= 3 and any(x[3] > x[2] for x in expected)


def test_bytes_of_ids_rebuild_texts(tools):
    for text in TEXTS:
        a, b = tools.encode([text or ""])
        if a[0]:
            assert b"".join(tools.a_bytes[i] for i in a[0]) == b"".join(tools.b_bytes[i] for i in b[0]) == (" " + text).encode()
    assert tools.encode([TEXTS[5]]) == ([[]], [[]])
    assert 50256 not in tools.encode([TEXTS[4]])[0][0]


LATIN = st.text(st.one_of(st.sampled_from(" \t\n\r'sStTrRvVeEmMlLdD0129½²ª\xad×ßÿĀɏ.,-_<|>"), st.characters(max_codepoint=0x300)), max_size=60)


@settings(max_examples=400, deadline=None)
@given(LATIN)
def test_words_looked_up_are_words_encoded(tools, text):
    assert tools.encode_a(text) == tools.a.encode(text, add_special_tokens=False).ids


def test_documents_encode_as_by_the_library(tools):
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()
    assert all(tools.encode_a(" " + t) == tools.a.encode(" " + t, add_special_tokens=False).ids for (t,) in rows)


def test_words_held_are_bounded(tools, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS_HELD", 5)
    for i in range(20):
        tools.encode_a(f"word{i} other{i} {'x' * 100}")
    assert len(tools.words) < 20 and all(len(w) <= alignment.LONGEST_WORD for w in tools.words)


def test_words_that_come_again_stay(tools, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS_HELD", 100)
    asked = []
    words = alignment.WordIds(type("Model", (), {"tokenize": lambda _, word: asked.append(word) or tools.a.model.tokenize(word)})(), len(tools.a_bytes))
    for i in range(1000):
        assert words["again"] and words[f"word{i}"]
        words.age()
        assert words.held() <= 102
    assert asked.count("again") == 1 and len(asked) == 1001


def test_workers_get_batches_bounded_by_bytes(spark, monkeypatch):
    """However many rows and pairs a task has, no block has more than a batch, nor does the session keep the bound."""
    blocks = []
    monkeypatch.setattr(alignment, "stored", lambda df, purpose, store=alignment.stored: blocks.append(store(df, purpose)) or blocks[-1])
    ids = F.sequence(F.lit(1), F.lit(400)).cast("array<int>")
    rows = spark.range(0, 6000, 1, 1).select("id", ids.alias("pair_a"), ids.alias("pair_b"), ids.alias("pair_links"))
    before = spark.conf.get(alignment.BATCH_SETTING)
    scored = alignment.link_scores(rows)
    assert spark.conf.get(alignment.BATCH_SETTING) == before
    pairs = [sum(r["sizes"]) for r in blocks[0].select("sizes").collect()]
    assert sum(pairs) == 6000 * 400 and max(pairs) * 12 <= alignment.BATCH_BYTES
    assert scored.agg(F.count("*"), F.min("count_sum"), F.max("count_sum")).first()[:] == (6000, 6000 * 80200, 6000 * 80200)


def test_coalescing_joins_chains_of_overlaps():
    starts, ends = np.array([0, 4, 6, 0, 2, 6]), np.array([4, 6, 9, 2, 6, 9])
    order, group = alignment.coalesce(starts, ends, np.array([0, 0, 0, 1, 1, 1]))
    assert group[np.argsort(order)].tolist() == [0, 0, 1, 0, 0, 1]
    a, b = alignment.expand(starts[:3], ends[:3], starts[3:], ends[3:])
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_blocks_change_nothing(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    texts = [t for _, t, *_ in documents(30) if t is None or len(t) < 1000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = alignment.link_scores(alignment.align(docs)).orderBy("doc_id").collect()
    assert [(r["n_best"], r["count_sum"]) for r in found] == [x[-2:] for x in plain(texts, tools)]


def test_a_very_long_text(spark, tools):
    text = " ".join(t for _, t, *_ in documents() if t)
    assert len(text) > 100_000
    row = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    a, b = tools.encode([text])
    assert (row["n_a"], row["n_b"]) == (len(a[0]), len(b[0])) and row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "")], [(1, "word"), (1, "word")]])
def test_odd_tables_and_clashing_names(spark, tools, rows):
    names = "row rows block sizes place links codes held at count best of a.b text2".split()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(f"own {n}") for n in names})
    docs = docs.withColumns({n: F.lit("own") for n in ("n_a", "pair_a", "n_best")})
    found = alignment.link_scores(alignment.align(docs))
    assert set(found.columns) == {"doc_id", "text", *names, *alignment.COUNTS, "groups", "n_best", "count_sum"}
    expected = plain([t for _, t in rows], tools)
    assert [(*[r[c] for c in alignment.COUNTS], r["n_best"], r["count_sum"], r["a.b"]) for r in found.collect()] == [
        (*x[:4], *x[5:], "own a.b") for x in expected
    ]
