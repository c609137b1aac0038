"""From raw documents to the shards of a training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet
and reread as the next one's documents. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlake.llm import decontam, mixing, near, quality, sharding
from txlake.llm.common import staged, tune
from txlake.plans.registry import Query, portable
from txlake.session import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    tune(prepare(spark))
    return quality.accepted(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    tune(prepare(spark))
    return near.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    tune(prepare(spark))
    return decontam.without_items(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its coin say."""
    tune(prepare(spark))
    return mixing.repeat_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot."""
    tune(prepare(spark))
    return sharding.with_shards(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", mix),
    ("sharding", shard),
]

# Trained weights and components cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(tune(prepare(spark)), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return portable(STAGES[-1][1](spark, docs, sf_dir))


QUERY = Query("pipeline", run, ORACLE_SQL)
