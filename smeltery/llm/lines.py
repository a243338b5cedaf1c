"""Line deduplication by site-relative frequency.

A line is boilerplate of a host when more than ``ratio`` of the host's pages, and at least
``least`` of them, contain it. Lines are counted as 128-bit hashes, once per page; a host has at
most (mean distinct lines per page) / ratio such lines, so its boilerplate is a short array that
joins the host's pages, in ``PARTS`` parts, without a shuffle of single lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a host's pages beyond which a line is boilerplate, and pages it must be on.
RATIO, LEAST = 0.05, 3
#: Parts of a host's pages that meet its boilerplate, so that a large host is many tasks' work.
PARTS = 64


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """``_host, _dropped``: the hashes of each host's boilerplate lines; hosts without any are left out."""
    of_page = F.array_distinct(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), _key))
    counts = pages.select(host.alias("_host"), F.explode(of_page).alias("line")).groupBy("_host", "line").count()
    totals = pages.groupBy(host.alias("_of")).agg(F.count("*").alias("total"))
    frequent = counts.where(F.col("count") >= least).join(totals, F.col("_host").eqNullSafe(F.col("_of")))
    frequent = frequent.where(F.col("count") / F.col("total") > ratio)
    return frequent.groupBy("_host").agg(F.collect_list("line").alias("_dropped"))


def drop_boilerplate(
    pages: DataFrame, host_column: str = "source", text_column: str = "text", ratio: float = RATIO, least: int = LEAST
) -> DataFrame:
    """All rows and columns of ``pages`` without boilerplate lines in the text.

    Adds ``n_lines`` and ``n_dropped``, counting repeated lines each time. Lines end at a line
    feed and are compared whole; blank lines are never dropped. A NULL text stays NULL with no
    lines; an empty text is one blank line; NULL hosts are one host. Repeated rows stay and count
    each time. Other columns may have any name, and those named like the result's are replaced; an
    empty table gives an empty result.
    """
    kept = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    text, host = F.col(f"row.`{text_column}`").cast("string"), F.col(f"row.`{host_column}`")
    lines = F.split(text, "\n", -1)
    found = boilerplate(packed, host, lines, ratio, least)
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    part = F.pmod(F.xxhash64(text), F.lit(PARTS)).cast("int")
    same = host.eqNullSafe(F.col("_host")) & (F.col("_part") == F.col("_of_part"))
    joined = packed.withColumn("_of_part", part).join(found.withColumn("_part", parts), same, "left")
    stay = F.when(F.col("_dropped").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col("_dropped"), _key(x)))
    )
    cut = joined.select("row", lines.alias("_lines"), stay.alias("_stay"))
    return cut.select(
        *[F.array_join("_stay", "\n").alias(c) if c == text_column else F.col(f"row.`{c}`") for c in kept],
        F.greatest(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.size("_lines") - F.size("_stay"), F.lit(0)).cast("long").alias("n_dropped"),
    )
