"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the records uniformly into buckets of bounded bytes by a seeded hash; the
exchange sends each bucket to a partition of its own, together with one row that tells where
the bucket starts in the whole order. Pass two puts each bucket in Fisher-Yates
order (Spark's ``shuffle`` of an array is one) and numbers it. The buckets in turn are one
random order of all records; cut into equal runs, it gives shards whose row counts differ by
one at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text a bucket should hold.
BUCKET_BYTES = 16 << 20


def shard(
    docs: DataFrame,
    shards: int = 16,
    text_column: str = "text",
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0).

    Shard sizes differ by one row at most. The hash takes the row's place in the input, so equal
    rows, NULL ids and a hot source scatter like all others; the same stored table read with the
    same split settings gives the same buckets. ``docs`` should be read from storage, because
    places must not change when a lost task is run again. NULL texts count one byte; a text
    longer than a bucket makes its bucket as much longer. An empty table gives an empty result.
    Input columns named ``shard`` or ``slot`` are replaced; all others are kept.
    """
    payload = [c for c in docs.columns if c not in ("shard", "slot")]
    size = F.coalesce(F.octet_length(F.col(text_column).cast("string")), F.lit(0)) + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(shards, -(-int(total) // bucket_bytes))
    placed = docs.select(
        F.monotonically_increasing_id().alias("place"), F.struct(*[F.col(f"`{c}`") for c in payload]).alias("row")
    ).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(buckets)).cast("int"))

    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("bucket").count().withColumn("sum", F.coalesce(F.sum("count").over(order), F.lit(0)))
    total_rows = F.sum("count").over(Window.partitionBy())
    starts = counts.select("bucket", F.struct(F.col("sum").alias("start"), total_rows.alias("total")).alias("head"))

    scattered = placed.unionByName(starts, allowMissingColumns=True).repartitionById(buckets, F.col("bucket"))
    item = F.when(F.col("place").isNotNull(), F.struct("place", "row"))
    filled = scattered.groupBy("bucket").agg(F.max("head").alias("head"), F.sort_array(F.collect_list(item)).alias("rows"))
    placed_rows = filled.select("head", F.shuffle("rows", seed).alias("rows")).select(
        "head.start", "head.total", F.posexplode("rows").alias("at", "item")
    )

    position = F.col("start") + F.col("at")
    short, longer = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    border = longer * (short + 1)
    number = F.when(position < border, F.expr(f"(start + at) div (total div {shards} + 1)")).otherwise(
        longer + F.floor((position - border) / F.greatest(short, F.lit(1)))
    )
    numbered = placed_rows.select(position.alias("position"), number.cast("int").alias("shard"), "total", "item")
    first = F.col("shard") * short + F.least(F.col("shard"), longer)
    return numbered.select(
        *[F.col("item.row").getField(c).alias(c) for c in payload],
        "shard",
        (F.col("position") - first).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard; rows are in order of their slots within each file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
