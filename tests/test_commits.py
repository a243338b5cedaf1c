import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from smeltery.sources import commits, readers, writers
from smeltery.sources.schemas import schema_of

AWKWARD = [None, "", " ", "a", "b:c", "d/e", "x=y", "50%", "{curly}", "[1]", "*?", "__HIVE_DEFAULT_PARTITION__", "2024", "ä\n"]
ROWS = [(i, text, 2024 if i % 3 else None) for i, text in enumerate(AWKWARD)]
SCHEMA = "id int, region string, year int"


def got(spark, path):
    return sorted(map(tuple, commits.read_table(spark, path).collect()), key=str)


@pytest.mark.parametrize("partition_by", [["region"], ["year", "region"], ["year"], []])
def test_any_value_survives_writes_and_replays(spark, tmp_path, partition_by):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(ROWS, SCHEMA)
    commits.write_batch(rows.where("id < 5"), 0, path, partition_by)
    commits.write_batch(rows.where("id >= 5").withColumn("region", F.lit("first:try")), 1, path, partition_by)
    for _ in range(2):
        assert commits.write_batch(rows.where("id >= 5"), 1, path, partition_by) == len(ROWS) - 5
        assert got(spark, path) == sorted(ROWS, key=str)
    commits.write_batch(rows.where("id < 0"), 1, path, partition_by)
    assert got(spark, path) == sorted(ROWS[:5], key=str)
    commits.write_batch(rows.where("id < 0"), 0, path, partition_by)
    assert got(spark, path) == []


def test_partition_columns_of_any_type_come_back_as_they_were(spark, tmp_path):
    schema = "id int, f double, t timestamp, d date, b boolean, m decimal(9,2), n long"
    rows = [
        (1, 0.1, dt.datetime(2024, 1, 1, 1, 2, 3, 456), dt.date(2024, 1, 1), True, Decimal("1.50"), 2**60),
        (2, None, None, None, None, None, None),
        (3, -0.0, dt.datetime(1969, 12, 31), dt.date(1, 1, 1), False, Decimal("-7.00"), -1),
    ]
    path = str(tmp_path / "t")
    table = spark.createDataFrame(rows, schema)
    commits.write_batch(table, 0, path, ["f", "t", "d", "b", "m", "n"])
    back = commits.read_table(spark, path)
    assert sorted(map(tuple, back.collect())) == rows and [f.dataType for f in back.schema] == [f.dataType for f in table.schema]


def test_a_killed_write_leaves_the_table_readable(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(ROWS, SCHEMA)
    commits.write_batch(rows, 0, path, ["region"])
    fail = F.udf(lambda x: 1 // (x - 7), "int")
    with pytest.raises(Exception, match="division"):
        commits.write_batch(rows.withColumn("id", fail("id")), 0, path, ["region"])
    assert got(spark, path) == sorted(ROWS, key=str)
    with monkeypatch.context() as patch:  # all files written, killed before they are named
        patch.setattr(commits, "_written_files", lambda *_: 1 // 0)
        with pytest.raises(ZeroDivisionError):
            commits.write_batch(rows.where("id = 1"), 0, path, ["region"])
        with pytest.raises(ZeroDivisionError):
            commits.write_batch(rows.where("id = 1"), 1, path, ["region"])
    assert got(spark, path) == sorted(ROWS, key=str)
    commits.write_batch(rows.where("id = 1"), 1, path, ["region"])
    assert len(got(spark, path)) == len(ROWS) + 1
    named = {f for row in commits.current(spark, path).collect() for f in row["files"]}
    assert commits.unnamed_files(spark, path).count() > 0 and not any(
        r["path"].endswith(f) for f in named for r in commits.unnamed_files(spark, path).collect()
    )


def test_compaction_is_one_switch(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(ROWS, SCHEMA)
    assert commits.compact(spark, path, ["year"]) is None
    for i in range(6):
        commits.write_batch(rows.where(F.col("id") % 6 == i).repartition(3), i, path, ["year"])
    with monkeypatch.context() as patch:
        patch.setattr(commits, "_written_files", lambda *_: 1 // 0)
        with pytest.raises(ZeroDivisionError):
            commits.compact(spark, path, ["year"])
    assert got(spark, path) == sorted(ROWS, key=str)
    commits.compact(spark, path, ["year"], files_per_partition=1)
    assert got(spark, path) == sorted(ROWS, key=str)
    live = commits.current(spark, path).collect()
    assert sorted((r["batch"], r["upto"]) for r in live) == [(-1, 4), (5, -1)]
    assert commits.write_batch(rows, 3, path, ["year"]) is None  # taken in already
    commits.write_batch(rows.where("id % 6 = 5").withColumn("region", F.lit("new")), 5, path, ["year"])  # the last may be replayed
    commits.write_batch(rows.where("id = 0"), 6, path, ["year"])
    commits.compact(spark, path, ["year"], files_per_partition=1)
    expected = [r for r in ROWS if r[0] % 6 != 5] + [(i, "new", y) for i, _, y in ROWS if i % 6 == 5] + [ROWS[0]]
    assert got(spark, path) == sorted(expected, key=str)
    assert sum(len(r["files"]) for r in commits.current(spark, path).collect()) <= 4


def test_a_stream_runs_on_beside_compactions(spark, tmp_path):
    schema = schema_of("id int, region string, year int")
    for start in range(4):
        spark.createDataFrame([(start * 2 + i, f"r{i}:", 2024) for i in range(2)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = readers.parquet_stream(spark, str(tmp_path / "in"), schema)
        writers.transform_stream(
            stream, lambda b: b, str(tmp_path / "out"), str(tmp_path / "check"), ["year", "region"], every=None
        ).awaitTermination()
        if start % 2:
            commits.compact(spark, str(tmp_path / "out"), ["year", "region"])
    assert [r[0] for r in got(spark, str(tmp_path / "out"))] == list(range(8))


def test_folders_of_whole_numbers_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.write_batch(spark.createDataFrame([(i, "x", 2000 + i) for i in range(9)], SCHEMA), 0, path, ["year", "region"])
    plan = commits.read_table(spark, path).where("year = 2003")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_emptied_partitions_by_value(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(ROWS[:8], SCHEMA)
    writers.overwrite_table(rows, path, ["year", "region"])
    left = rows.where("id <> 4 AND id <> 5")
    writers.overwrite_partitions(left, path, ["year", "region"], F.lit(True))
    assert sorted(r["id"] for r in spark.read.schema(rows.schema).parquet(path).collect()) == [0, 1, 2, 3, 6, 7]
