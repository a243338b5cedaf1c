from collections import Counter, defaultdict

import pytest
from corpus import clashing, documents
from pyspark.sql import functions as F

from smeltery.llm import lines


def plain(rows, ratio, least):
    pages, holding = Counter(r[3] for r in rows), defaultdict(Counter)
    for r in rows:
        holding[r[3]].update({x for x in (r[1] or "").split("\n") if x.strip(" ")})
    result = []
    for r in rows:
        if r[1] is None:
            result.append((str(r[0]), None, 0, 0))
            continue
        own = r[1].split("\n")
        stay = [x for x in own if holding[r[3]][x] < least or holding[r[3]][x] / pages[r[3]] <= ratio]
        result.append((str(r[0]), "\n".join(stay), len(own), len(own) - len(stay)))
    return sorted(result, key=str)


def cases():
    rows = [list(r) for r in documents(60)]
    for i in range(0, 60, 2):
        rows[i][1] += "\nAll rights reserved.\n\nAll rights reserved."
    for i in range(0, 60, 7):
        rows[i][1] = "Home\n" + rows[i][1]
    rows += [[700 + i, "only line", "en", None, 1] for i in range(4)] + [[800, "alone", "en", "lonely", 1]]
    return [tuple(r) for r in rows]


@pytest.mark.parametrize(("ratio", "least"), [(0.05, 3), (0.5, 1), (0.0, 1), (1.0, 1)])
def test_equals_brute_force(spark, ratio, least):
    docs = clashing(spark, cases()).withColumn("n_dropped", F.lit("own"))
    found = lines.drop_boilerplate(docs, ratio=ratio, least=least)
    assert sorted(found.columns) == sorted([*docs.columns, "n_lines"])
    got = sorted(((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=str)
    assert got == plain(cases(), ratio, least)


def test_empty_table(spark):
    assert lines.drop_boilerplate(clashing(spark, cases()).limit(0)).count() == 0


def test_any_column_name(spark):
    names = "row _host _dropped _part _of_part _lines _stay line total count a.b n_lines".split()
    docs = spark.createDataFrame([(1, "one\ntwo", "h"), (2, None, None)], "doc_id int, text string, source string")
    rows = lines.drop_boilerplate(docs.withColumns({n: F.lit(f"own {n}") for n in names})).orderBy("doc_id").collect()
    assert [(r["a.b"], r["_host"], r["row"], r["text"], r["n_lines"]) for r in rows] == [
        ("own a.b", "own _host", "own row", "one\ntwo", 2), ("own a.b", "own _host", "own row", None, 0)
    ]
