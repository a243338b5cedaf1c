from collections import Counter

from corpus import DOCS, clashing, documents

from smeltery.llm import sharding


def test_rows_law_and_gapless_slots(spark):
    docs = clashing(spark).repartition(5)
    found = sharding.shard(docs, shards=4, bucket_bytes=4096)
    rows = found.collect()
    assert sorted(found.columns) == sorted(docs.columns)
    assert sorted(Counter((r.doc_id, r.text) for r in rows).items(), key=str) == sorted(
        Counter((r[0], r[1]) for r in documents()).items(), key=str
    )
    counts = Counter(r.shard for r in rows)
    assert set(counts) == {0, 1, 2, 3} and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_order_is_shuffled_and_reruns_agree(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(5000).selectExpr("id as doc_id", "string(id) as text").write.parquet(path)
    first = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(spark.read.parquet(path)).collect()}
    assert first == {r.doc_id: (r.shard, r.slot) for r in sharding.shard(spark.read.parquet(path)).collect()}
    assert first != {r.doc_id: (r.shard, r.slot) for r in sharding.shard(spark.read.parquet(path), seed=1).collect()}
    order = sorted(first, key=first.get)
    assert sum(b == a + 1 for a, b in zip(order, order[1:])) < 50


def test_equal_rows_scatter(spark):
    docs = spark.range(3000).selectExpr("1 as doc_id", "'same' as text")
    counts = Counter(r.shard for r in sharding.shard(docs, shards=7, bucket_bytes=64).collect())
    assert sorted(counts.values()) == [428, 428, 428, 429, 429, 429, 429]


def test_fewer_rows_than_shards_and_none(spark):
    docs = spark.createDataFrame(documents()[:3], DOCS)
    assert sorted((r.shard, r.slot) for r in sharding.shard(docs).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard(docs.limit(0)).count() == 0


def test_written_shards_hold_their_rows(spark, tmp_path):
    docs = spark.createDataFrame(documents(), DOCS)
    sharding.write_shards(sharding.shard(docs, shards=3), str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert again.count() == len(documents()) and again.select("shard").distinct().count() == 3
