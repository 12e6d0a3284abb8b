"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, packing.

Each stage takes the documents that the one before kept, with all their columns; the last gives packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm import decontam, langid, packing, pii, simhash
from wardflow.llm.common import ready, table
from wardflow.llm.queries import tokenizer_path
from wardflow.session import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without an identifiable language; the model is learned from the documents."""
    ready(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates."""
    ready(spark)
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window."""
    ready(spark)
    return decontam.keep_clean(docs, decontam.blocks(table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts."""
    ready(spark)
    return pii.mask(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of full length: each piece with its ids (little-endian, 32 bits) and its place."""
    ready(spark)
    return packing.pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: The models and the fingerprints cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    out = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, out, sf_dir)
        out = out if name == STAGES[-1][0] else settle(out)
    return out
