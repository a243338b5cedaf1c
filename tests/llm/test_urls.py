import importlib
import random

import duckdb
from compare import difference
from pyspark.sql import functions as F

from smeltery.llm import queries, urls

ODD = [
    None, "", "no scheme", "http://", "https://Sub.Example.NET/en/x?q=/de/", "x://example.com", "x://example.com#/de/",
    "http://example.com/de", "http://example.com/de/1", "http://notexample.com/de/1", "http://org/fr/", "http://a.b.org/fr/y#z",
    "http://ÄB.Org/FR/", "http://net", "http://net/", "http://a.net?x", "u://v://w/en/", "http://example.net/en/", "http://h/" + "p/" * 3000,
]


def plain(url):
    """Host, path, rule and action, by string methods."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def judged(spark, addresses, **how):
    pages = spark.createDataFrame([(i, a, "own") for i, a in enumerate(addresses)], "page_id int, url string, template string")
    return {r.page_id: r for r in urls.judge(pages, **how).collect()}


def test_host_path_and_rules(spark):
    rows = judged(spark, ODD + ODD[:3])
    assert len(rows) == len(ODD) + 3
    for i, url in enumerate(ODD):
        host, path, rule, action = plain(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == (action or "allow")


def test_pure_template_is_blocked_without_a_rule(spark):
    """Pages of one template, nearly all blocked by rules for single pages, take the rest along."""
    rules = [("block", "h.test", f"/spam/{i}/") for i in range(30)] + [("allow", "h.test", "/good/1")]
    addresses = [f"http://h.test/spam/{i}/x" for i in range(40)] + [f"http://h.test/good/{i}" for i in range(40)]
    rows = judged(spark, addresses, rules=rules)
    assert {rows[i].verdict for i in range(40)} == {"block"}
    assert {rows[i].verdict for i in range(40, 80)} == {"allow"}
    assert rows[35].rule is None and rows[35].template.startswith("/spam/")


def test_mixed_template_is_allowed(spark):
    rules = [("block", "h.test", f"/p/{i}/") for i in range(10)] + [("allow", "h.test", f"/p/{i}/") for i in range(10, 20)]
    rows = judged(spark, [f"http://h.test/p/{i}/" for i in range(30)], rules=rules)
    assert [rows[i].verdict for i in range(30)] == ["block"] * 10 + ["allow"] * 20


def test_many_thin_children_are_one_wildcard(spark):
    names = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    rows = judged(spark, [f"http://h.test/user/{n}" for n in names] + ["http://h.test/about"])
    assert {rows[i].template for i in range(100)} == {"/user/*"} and rows[100].template == "/about"


def test_alike_branches_merge(spark):
    addresses = [f"http://h.test/{c}/{i}" for c in ("a", "b", "c") for i in range(20)]
    rules = [("block", "h.test", "/a/"), ("block", "h.test", "/b/"), ("allow", "h.test", "/c/")]
    rows = judged(spark, addresses, rules=rules)
    assert rows[0].template != rows[59].template
    both = judged(spark, addresses[:40], rules=rules[:2])
    assert both[0].template == both[39].template == "/+/+"


def test_deep_siblings_are_told_apart(spark):
    """Pages below a fifth level blocked by a rule do not take their siblings along."""
    rules = [("block", "h.test", f"/x/y/z/v/spam/{i}") for i in range(40)] + [("allow", "h.test", "/x/y/z/v/news/0")]
    deep = [f"http://h.test/x/y/z/v/spam/{i}/p" for i in range(50)]
    rest = ["http://h.test/x/y/z/v/news/story", "http://h.test/x/y/z/v/about", "http://h.test/x/y", "http://h.test/x/y/z/v/"]
    rows = judged(spark, deep + rest, rules=rules)
    assert {rows[i].verdict for i in range(50)} == {"block"}
    assert {rows[50 + i].verdict for i in range(len(rest))} == {"allow"}


def test_sql_gives_the_same_verdicts_at_any_depth(spark, monkeypatch, request):
    """Random trees in which merging, wildcards and pure templates all happen."""
    rng = random.Random(6)
    paths = ["/".join(rng.choice(["de", "en", "fr", "a1", "b", "c", "x" * 40]) for _ in range(rng.randint(0, 7))) for _ in range(600)]
    paths += [f"en/user/{chr(97 + i % 26)}{chr(97 + i // 26)}/de/{i % 3}" for i in range(120)] + ["en", "en/", "en/user"] * 3
    hosts = ["example.com", "example.net", "other.net", "h.test", "org"]
    pages = [(i, f"http://{rng.choice(hosts)}/{path}") for i, path in enumerate(paths)]
    for name, value in (("KIDS", 5), ("LABELS", 2), ("PURE", 0.5)):
        monkeypatch.setattr(urls, name, value)
    sql = importlib.reload(queries).SQL["op8_url_filters"]
    request.addfinalizer(lambda: (monkeypatch.undo(), importlib.reload(queries)))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    con = duckdb.connect()
    con.register("pages", frame.toPandas())
    found = urls.judge(frame)
    assert difference(found.select("page_id", "host", "path", "rule", "verdict"), con, sql) == ""
    by_template = found.groupBy("verdict").agg(F.countDistinct("template").alias("n")).collect()
    assert {r.verdict for r in by_template} == {"allow", "block"}
    assert found.where("template LIKE '%/+%'").count() and found.where("template LIKE '%/*%'").count()


def test_any_column_name(spark):
    names = "row host path rule verdict segments action own a.b labels pages judged _action _segments".split()
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id int, url string").withColumns({n: F.lit(f"own {n}") for n in names})
    row = urls.judge(pages).first().asDict()
    assert row["a.b"] == "own a.b" and row["_action"] == "own _action" and row["own"] == "own own" and row["host"] == "a.net"


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_hot_host(spark):
    pages = spark.range(20_000).select(F.concat(F.lit("http://hot.net/en/"), "id").alias("url"))
    assert urls.judge(pages).where("verdict = 'block'").count() == 20_000
