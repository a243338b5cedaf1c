import base64

import numpy as np
from corpus import DOCS, clashing, documents
from pyspark.sql import functions as F

from smeltery.llm import langid


def test_held_out_accuracy_and_odd_rows(spark):
    docs = clashing(spark)
    filters = langid.learn(docs.where("doc_id % 2 = 0"))
    assert filters.languages == ["de", "en", "es"]
    found = langid.predict(docs, filters)
    assert sorted(found.columns) == sorted([*docs.columns, "lang_pred"])
    rows = found.collect()
    assert len(rows) == len(documents())
    odd = {r.text: (r.lang_pred, r.score) for r in rows if r.doc_id in (90, 91, 92, 93)}
    assert odd == {t: ("und", 0.0) for t in (None, "", " \t\n", "1234 !!! 5678")}
    held = [r for r in rows if r.doc_id is not None and r.doc_id % 2 and r.doc_id < 90]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_every_typical_gram_is_in_its_filter(spark):
    docs = spark.createDataFrame(documents(), DOCS)
    filters = langid.learn(docs)
    for _, text, lang, _, _ in documents()[:20]:
        grams = np.unique(np.concatenate(list(langid.grams_of(text))))
        mask = np.bitwise_and.reduce([filters.masks[s] for s in langid.slots_of(grams)])
        assert ((mask >> filters.languages.index(lang)) & 1).mean() > 0.9


def test_text_in_pieces_gives_the_same_grams(monkeypatch):
    text = documents()[94][1]
    whole = np.concatenate(list(langid.grams_of(text)))
    monkeypatch.setattr(langid, "BYTES_AT_ONCE", 100)
    assert (np.concatenate(list(langid.grams_of(text))) == whole).all()


def test_recognised_keeps_rows_unchanged(spark):
    docs = clashing(spark)
    kept = langid.recognised(docs, langid.learn(docs))
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)
    )


def test_recognised_rejects_an_unlearned_script_and_junk(spark):
    docs = spark.createDataFrame(documents(), DOCS)
    junk = ["Привет мир это проверка неизвестного алфавита", "这是一个没有学习过的文字", base64.b64encode(bytes(range(256))).decode()]
    good = [documents()[i][1] for i in range(3)]
    rows = spark.createDataFrame([(i, text, None, "s", 1) for i, text in enumerate(junk + good)], DOCS)
    filters = langid.learn(docs)
    assert [r.doc_id for r in langid.recognised(rows, filters).orderBy("doc_id").collect()] == [3, 4, 5]
    assert "und" not in {r.lang_pred for r in langid.predict(rows, filters).collect()}


def test_nothing_to_learn_and_nothing_to_predict(spark):
    docs = spark.createDataFrame(documents(), DOCS)
    filters = langid.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(docs, filters).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.learn(docs)).count() == 0


def test_ties_go_to_the_first_language(spark):
    rows = [(1, "abcdef ghijk", "zz", "s", 1), (2, "abcdef ghijk", "aa", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(docs)).collect()} == {"aa"}


def test_many_languages_need_wider_masks(spark):
    rows = [(i, f"{chr(97 + i % 26) * 4}{chr(97 + i // 26) * 4} word{chr(97 + i % 26)}", f"l{i:02d}", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    filters = langid.learn(docs)
    assert filters.masks.dtype == np.uint64
    found = langid.predict(docs, filters).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found > 0.9


def test_marks_that_are_no_letters_are_undetermined(spark):
    filters = langid.learn(spark.createDataFrame(documents(), DOCS))
    texts = ["½ ² ③", "٣ 12", "_", "½ ² ③ the and of that", "ª"]
    found = langid.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string"), filters)
    assert [r.lang_pred == "und" for r in found.orderBy("doc_id").collect()] == [True, True, True, False, False]


def test_any_column_name(spark):
    filters = langid.learn(spark.createDataFrame(documents(), DOCS))
    names = "row text2 _read a.b score lang_pred _row".split()
    docs = spark.createDataFrame([(1, "the and of that")], "doc_id int, text string").withColumns({n: F.lit(f"own {n}") for n in names})
    row = langid.predict(docs, filters).first().asDict()
    assert row["a.b"] == "own a.b" and row["row"] == "own row" and row["_read"] == "own _read" and row["lang_pred"] == "en"
