import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import DOCS, clashing, documents

from smeltery.llm import lm


def words_of(text):
    return (text or "").encode().lower().split() + [b""]


@pytest.mark.parametrize("head", [1 << 17, 20, 0])
def test_base_score_equals_the_formula(spark, monkeypatch, head):
    """With all, few and no words known to the tasks: the join gives the same."""
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    docs = clashing(spark)
    train = docs.where("doc_id % 3 <> 0")
    model, counts = lm.fit(train)
    found = lm.score(docs, model, counts)
    assert sorted(found.columns) == sorted([*docs.columns, "n_tokens", "n_known", "base_score"])
    seen = Counter(w for r in train.collect() for w in words_of(r.text))
    total = sum(seen.values()) + 0.1 * (len(seen) + 1)
    rows = found.collect()
    assert len(rows) == len(documents()) and model.tokens == sum(seen.values())
    for r in rows:
        words = words_of(r.text)
        assert r.n_tokens == len(words) and r.n_known == sum(seen[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 0.1) / total) for w in words))


def test_score_is_the_log_probability_of_the_model(spark):
    docs = spark.createDataFrame(documents(), DOCS)
    model, counts = lm.fit(docs)
    numbers = {bytes(r.token): r.n for r in counts.collect()}
    bias = model.bias
    for r in lm.score(docs, model, counts).collect():
        if r.n_tokens > 200:
            continue
        expected = 0.0
        words = words_of(r.text)
        features = lm.features_of(np.array([lm.crc32(w) for w in words[:-1]], np.uint32)).astype(int)
        for word, row in zip(words, features):
            kind = int(model.classes[model.words[word]]) if word in model.words else lm.shared_class(word)
            group = kind // lm.GROUP
            base = row * (lm.GROUPS + 1)
            for at, wanted, own in ((base, group, bias[0]), (base + 1 + group, kind % lm.GROUP, bias[1 + group])):
                logits = own + model.weights[at].sum(axis=0)
                expected += (logits[wanted] - np.log(np.exp(logits).sum())) / math.log(10)
            expected += math.log10((numbers.get(word, 0) + 0.1) / model.totals[kind])
        assert r.score == pytest.approx(expected, rel=1e-4)


def test_probabilities_of_the_next_token_sum_to_one(spark):
    model, counts = lm.fit(spark.createDataFrame(documents(), DOCS))
    by_class = np.zeros(lm.CLASSES)
    for r in counts.collect():
        word = bytes(r.token)
        kind = int(model.classes[model.words[word]]) if word in model.words else lm.shared_class(word)
        by_class[kind] += r.n + 0.1
    by_class[-lm.SHARED :] += 0.1
    kinds = np.arange(lm.CLASSES)
    features = np.repeat(lm.features_of(np.array([lm.crc32(b"the")], np.uint32))[1:].astype(int), lm.CLASSES, axis=0)
    chance = np.exp(lm._log_probability(features, kinds, model.weights, model.bias))
    assert (chance * by_class / model.totals).sum() == pytest.approx(1, abs=1e-4)


def test_held_out_texts_are_likelier_than_under_unigrams(spark):
    docs = spark.createDataFrame(documents(400, seed=9), DOCS)
    model, counts = lm.fit(docs.where("doc_id % 5 <> 0"), rounds=3)
    rows = lm.score(docs.where("doc_id % 5 = 0"), model, counts).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.02 * sum(r.n_tokens for r in rows)


def test_nothing_to_learn_and_nothing_to_score(spark):
    docs = spark.createDataFrame(documents()[:20] + documents()[90:94], DOCS)
    model, counts = lm.fit(docs.limit(0))
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in lm.score(docs, model, counts).collect())
    model, counts = lm.fit(docs)
    assert lm.score(docs.limit(0), model, counts).count() == 0


def chance_of_leaf(trees, leaf, keys):
    """The way down to a leaf, one step after the other."""
    chance = 1.0
    for at in range(trees.first[leaf], trees.first[leaf + 1]):
        rows = [(int(key) ^ (int(trees.nodes[at]) * 0x9E3779B1 % 2**32)) * 0x2C1B3C6D % 2**32 for key in keys]
        size = len(trees.weights).bit_length() - 1
        logits = trees.bias[trees.nodes[at]] + trees.weights[[row >> (32 - size) for row in rows]].sum(axis=0)
        part = np.exp(np.clip(logits.astype(float), -60, 60))
        chance *= part[trees.branches[at]] / part.sum()
    return chance


@pytest.mark.parametrize("head", [1 << 17, 60, 0])
def test_context_predicts_words_inside_their_classes(spark, monkeypatch, head):
    """Scores equal a walk down the trees; in every class the words' probabilities sum to one."""
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    docs = spark.createDataFrame(documents(), DOCS)
    plain, counts = lm.fit(docs.where("doc_id % 3 <> 0"))
    model, counts = lm.fit(docs.where("doc_id % 3 <> 0"), word_context=True)
    numbers = {bytes(r.token): r.n for r in counts.collect()}
    trees, bias = model.trees, model.bias
    assert trees.weights.any()

    def log_word(word, row, keys):
        kind = int(model.classes[model.words[word]]) if word in model.words else lm.shared_class(word)
        group, found = kind // lm.GROUP, 0.0
        base = row * (lm.GROUPS + 1)
        for at, wanted, own in ((base, group, bias[0]), (base + 1 + group, kind % lm.GROUP, bias[1 + group])):
            logits = own + model.weights[at].sum(axis=0)
            found += logits[wanted] - np.log(np.exp(logits).sum())
        if word in model.words:
            return found + math.log(chance_of_leaf(trees, model.words[word], keys)), kind
        cell = int(lm.cells_of(np.array([kind]), np.array([lm.crc32(word)]), trees.cells)[0])
        share = (numbers.get(word, 0) + 0.1) / trees.cell_totals[cell]
        return found + math.log(share * chance_of_leaf(trees, len(model.words) + cell, keys)), kind

    for r in lm.score(docs, model, counts).collect():
        words = words_of(r.text)
        if len(words) < 200:
            hashes = np.array([lm.crc32(w) for w in words[:-1]], np.uint32)
            rows = zip(words, lm.features_of(hashes).astype(int), lm.step_keys(hashes))
            assert r.score == pytest.approx(sum(log_word(*x)[0] for x in rows) / math.log(10), rel=1e-4)

    hashes = np.array([lm.crc32(b"the")], np.uint32)
    features, keys = lm.features_of(hashes).astype(int)[1], lm.step_keys(hashes)[1]
    for i in range(lm.SHARED):
        own = [n for n in range(len(model.words)) if model.classes[n] == lm.SINGLES + 1 + i]
        own += range(len(model.words) + i * trees.cells, len(model.words) + (i + 1) * trees.cells)
        assert sum(chance_of_leaf(trees, leaf, keys) for leaf in own) == pytest.approx(1, abs=1e-4)
    seen = [log_word(word, features, keys)[0] for word in numbers]
    assert sum(map(math.exp, seen)) < 1 + 1e-4
    rare = np.array([word not in model.words for word in numbers])
    assert rare.any() == (head < 1 << 17) and plain.trees is None


def test_two_words_of_one_class_are_told_apart_by_the_word_before(spark):
    """Both words are as frequent and end alike, so only context inside the class can tell them apart."""
    filler = " ".join(f"{a}{b}" for a in "abcdefg" for b in "uvwxyz")
    rows = [(i, f"{filler} {'red likeness' if i % 2 else 'blue kindness'} {filler}") for i in range(300)]
    tests = [(1000, "red likeness"), (1001, "red kindness")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gaps = {}
    for word_context in (False, True):
        model, counts = lm.fit(docs, word_context=word_context)
        found = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(tests, docs.schema), model, counts).collect()}
        gaps[word_context] = found[1000] - found[1001]
    # What comes after the word is as likely in both.
    assert gaps[True] > gaps[False] + 0.3


def test_texts_are_read_together_as_they_would_be_alone(spark, monkeypatch):
    """Words are those of word_list, no context crosses from text to text, and batches end where they are full."""
    texts = [r[1] for r in documents()] + ["\x1c a\x00b\x1f", " A\x0bb\x0cÉ c\t\n", "nb\u00a0sp   q", "Ä ö"]
    model, _ = lm.fit(spark.createDataFrame(documents()[:40], DOCS), word_context=True)
    words, starts = lm.words_of(pa.array(texts))
    assert words.to_pylist() == [word for text in texts for word in lm.word_list(text)]
    assert np.diff(starts).tolist() == [len(words_of(text)) for text in texts]
    together = model.read(pa.array(texts))
    assert together.unseen and together.starts.tolist() == starts.tolist()
    for text, start, end in zip(texts, starts, starts[1:]):
        alone = model.read(pa.array([text], pa.string()))
        for name in ("features", "classes", "numbers", "leaves", "keys"):
            assert np.array_equal(getattr(alone, name), getattr(together, name)[start:end])
    monkeypatch.setattr(lm, "BATCH", 500)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = [x.tolist() for x in map(np.concatenate, zip(*lm._batches(iter([batch]), model)))]
    monkeypatch.setattr(lm, "READ_BYTES", 300)
    parts = list(lm._batches(iter([batch]), model))
    assert [x.tolist() for x in map(np.concatenate, zip(*parts))] == whole
    assert all(500 <= len(x[1]) < 1000 for x in parts[:-1]) and sum(len(x[1]) for x in parts) == starts[-1]
