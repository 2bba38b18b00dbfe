"""A training-corpus pipeline over ``documents``.

toxic documents go; lines that align with an earlier document go; of each group of near
duplicates one document stays; sources are mixed to their target weights; what is left is packed
into sequences. Each stage is written and read again, and works on all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import line_dedup, mixing, packing, simhash, toxicity
from fieldlens.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# seeded draws, fingerprints and token ids have no form in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
