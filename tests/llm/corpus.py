"""Small corpora with every awkward row: NULLs, empty and very long texts, ties, repeated rows."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and of that with this from have were which their would there been into more after other".split(),
    "de": "der die und das nicht sich auch werden einer durch nach über können wurde zwischen schon noch".split(),
    "es": "los las una que para como pero más este entre cuando desde niño años también según donde".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    """Lines of up to twelve words of a language."""
    words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "ed"]) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


def documents(n: int = 90, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de", "es")[i % 3]
        text = prose(rng, lang, rng.randint(5, 120))
        rows.append((i, text, lang, f"src{0 if i % 3 == 0 else i % 5}", len(text)))
    rows.append((n, None, "en", "src1", None))
    rows.append((n + 1, "", None, None, 0))
    rows.append((n + 2, " \t\n", "en", "src1", 3))
    rows.append((n + 3, "1234 !!! 5678", None, "src2", 13))
    rows.append((n + 4, prose(rng, "en", 20_000), "en", "src2", 1))
    rows.append((None, rows[0][1], "en", "src0", 1))
    rows.append((None, "nobody knows this one", None, "src0", 1))
    rows.append((n + 5, rows[1][1], "de", "src1", 1))
    rows.append((n + 6, "One two", "en", "src1", 7))
    return rows + [rows[2], rows[2]]


def clashing(spark, rows=None, **columns):
    """The documents with further columns, whose names operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(documents() if rows is None else rows, DOCS)
    names = "id fp shard slot score size copies target template host row place bucket part unit token _row2 items spans".split()
    return docs.withColumns({name: F.lit(f"own {name}") for name in names})
