"""Helpers that the corpus operators share: tables, stored results, words, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again.

    Cuts the lineage: what follows reads files that every executor reaches, and a lost
    executor costs only its running tasks.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(key.cast("string")) % modulus


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for NULL.

    A word starts where a character that is no white space follows the start or white space:
    white space is made blank, runs of it one, and the blanks left are counted.
    """
    blank = F.trim(F.regexp_replace(text, SPACES, " "))
    words = F.length(blank) - F.length(F.replace(blank, F.lit(" "), F.lit(""))) + 1
    return F.when(F.coalesce(F.length(blank), F.lit(0)) == 0, 0).otherwise(words).cast("long")


def word_list(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) UTF-8 words between ASCII white space; none for NULL."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def with_columns_of(batch: pa.RecordBatch, names: list[str], **more: pa.Array) -> pa.RecordBatch:
    """The named columns of a batch, with further arrays appended."""
    arrays = [batch.column(name) for name in names] + list(more.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *more])


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root the smallest node.

    Alternates large-star and small-star steps; every step is a grouped minimum, which Spark
    combines before the shuffle, and an inner join, whose hot partitions adaptive execution
    splits. Nodes that are their own root are not returned. Each round is a stored table; the
    driver sees one count and one checksum per round.
    """
    state = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        row = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(row)


def packed(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns as one struct ``row``, in which any name is safe."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))


def unpacked(names: list[str]) -> list[Column]:
    return [F.col(f"row.`{name}`") for name in names]


def texts_of(batch: pa.RecordBatch, names: list[str], text_column: str) -> pa.Array:
    """The texts in the ``row`` column of a batch, as strings."""
    return batch.column("row").field(names.index(text_column)).cast(pa.string())


def slices(n: int, size: int):
    """Slices that cover ``range(n)``, ``size`` long at most."""
    return (slice(i, min(i + size, n)) for i in range(0, n, size))


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)
