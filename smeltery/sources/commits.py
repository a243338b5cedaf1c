"""Tables of micro-batches in which a file counts once a commit names it.

Below the table's folder, ``data`` holds the files of every try of a batch, in a folder of its own,
and ``commits`` holds one row per successful try: which batch it was and which files it wrote. The
newest commit of a batch is the batch; readers look at its files and at no others. So a replay
takes the place of what it replays whatever partitions the two have, a try that was killed was
never there, and nothing is deleted or renamed while others read.

A compaction is a commit that stands for all batches up to a number. It is one row as well, so
readers see either the batches or their compaction.

Files are compared, never the texts of partition folders. Values that a folder name cannot hold
as they are (texts, numbers with a fraction, times) stay in the files, and the folder carries
their hash. One writer at a time commits batches to a table; a compaction may run beside it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "batch long, try long, upto long, try_id string, files array<string>, rows long, schema string"
#: The number that commits of compactions carry instead of a batch.
COMPACTION = -1
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)
FOLDER_OF = "__key_of_"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All commits of a table; none if it does not exist yet."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The commits that make up the table: the last compaction and the later batches."""
    newest = Window.partitionBy("batch").orderBy(F.desc("upto"), F.desc("try"))
    last = commits(spark, path).withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")
    compacted = F.max("upto").over(Window.partitionBy())
    return last.withColumn("__compacted", compacted).where(
        (F.col("batch") == COMPACTION) | (F.col("batch") > F.col("__compacted"))
    ).drop("__compacted")


def _folders(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows and the columns that name their folders."""
    kinds = {f.name: f.dataType for f in df.schema}
    hashed = [name for name in partition_by if not isinstance(kinds[name], EXACT)]
    keyed = df.withColumns({FOLDER_OF + name: F.hex(F.xxhash64(name)) for name in hashed})
    return keyed, [FOLDER_OF + name if name in hashed else name for name in partition_by]


def _written_files(spark: SparkSession, folder: str) -> list[str]:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    name = folder.rsplit("/", 1)[1]
    return sorted(row["path"].split(f"/{name}/", 1)[1] for row in listed.load(folder).select("path").collect())


def _commit(df: DataFrame, path: str, partition_by: Sequence[str], batch: int, number: int, upto: int) -> int:
    """Write the rows, list what was written, then name it in one new row."""
    spark, try_id, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    folder = f"{path}/data/try_id={try_id}"
    keyed, folders = _folders(df, partition_by)
    keyed.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*folders).parquet(folder)
    rows = seen.get["rows"]
    entry = (batch, number, upto, try_id, _written_files(spark, folder), rows, df.schema.json())
    spark.createDataFrame([entry], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return rows


def write_batch(df: DataFrame, batch_id: int, path: str, partition_by: Sequence[str] = ()) -> int | None:
    """Write one micro-batch; a batch that was written before is replaced as a whole.

    Returns the number of rows, or None for a batch that a compaction has taken in already: its
    rows are in the table and stay as they are.
    """
    known = commits(df.sparkSession, path).agg(
        F.max("upto").alias("upto"), F.max(F.when(F.col("batch") == batch_id, F.col("try"))).alias("try")
    )
    state = known.first()
    if state["upto"] is not None and batch_id <= state["upto"]:
        return None
    return _commit(df, path, partition_by, batch_id, 0 if state["try"] is None else state["try"] + 1, -1)


def _rows_of(spark: SparkSession, path: str, live: Sequence[Row]) -> DataFrame:
    """The rows of the given commits, with the columns and types of the newest."""
    newest = max(live, key=lambda row: (row["batch"], row["upto"]))
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    files = [f"{path}/data/try_id={row['try_id']}/{name}" for row in live for name in row["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*files)
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows, with the columns and types they were written with.

    Filters on whole-number, date and boolean partition columns prune folders; the others skip
    files by their statistics. The driver sees the list of files, as it does for any table.
    """
    live = current(spark, path).collect()
    if not live:
        raise FileNotFoundError(f"{path} has no committed batch")
    return _rows_of(spark, path, live)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows of one batch that is not compacted yet; none, in the given shape, if there is no such batch."""
    tries = commits(spark, path).where(F.col("batch") == batch_id).orderBy(F.desc("try")).limit(1).collect()
    return _rows_of(spark, path, tries) if tries else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] = (), files_per_partition: int = 8) -> int | None:
    """Write all batches but the last anew, with few files per partition, as one commit.

    The last batch may still be replayed, so it stays out. Returns the number of rows, or None if
    there is nothing to do. A run that is killed leaves the table as it is. Runs beside the
    stream that writes the table.
    """
    live = current(spark, path).collect()
    batches = sorted(row["batch"] for row in live if row["batch"] != COMPACTION)
    if len(batches) < 2:
        return None
    upto = batches[-2]
    rows = _rows_of(spark, path, [row for row in live if row["batch"] <= upto])
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(files_per_partition))
    whole = rows.repartition(*[F.col(f"`{c}`") for c in partition_by], spread)
    return _commit(whole, path, partition_by, COMPACTION, 0, upto)


def unnamed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of data files that the table does not consist of: replaced, compacted, or of killed tries.

    Whoever manages the storage may delete them once no reader started before the last commit.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = listed.load(f"{path}/data").select("path", F.regexp_extract("path", "/data/try_id=([0-9a-f]+)/", 1).alias("try_id"))
    return files.join(current(spark, path).select("try_id"), "try_id", "left_anti").select("path")
