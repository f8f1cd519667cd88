"""The corpus pipeline: quality classifier, near duplicates, benchmark
decontamination, mixing and sharding over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tanimart.llm import decontam, mixing, ngram_join, quality, sharding
from tanimart.llm.common import read, save, ship
from tanimart.llm.queries import QUALITY_LEAST, quality_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep(docs, quality_model(spark, sf_dir), QUALITY_LEAST)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five words, 0.8) the first stays."""
    ship(spark)
    return ngram_join.one_of_each(docs, 5, 80, 100)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat or thin out to shares of the square roots of their counts."""
    return mixing.mix(docs).select(docs.columns)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (0 to 15, equal bytes) and slot."""
    return sharding.place(docs, 16)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]

#: Classifier, hashes and edit distances have no SQL form; tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
