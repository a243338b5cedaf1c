"""From raw documents to shuffled training shards, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import decontaminate, langid, mixing, sharding, simhash
from smeltery.llm.common import stored, table, word_count

#: No stage but the last rests on relations alone, so SQL cannot give the pipeline's rows.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language; filters are learned from those with ``lang``.

    NULL texts, texts without a letter and texts that no learned language accounts for go.
    """
    return langid.recognised(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies.

    Near copies are texts whose fingerprints lie within 4 bits, or which share 0.8 of their
    five-word shingles.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source's words come near its target."""
    return mixing.drawn(docs, word_count(F.col("text")))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in shuffled shards, with ``shard`` and ``slot``."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
