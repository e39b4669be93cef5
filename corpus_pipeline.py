"""The training-data pipeline: five stages over the documents, each written and read again.

A stage is a function of (spark, docs, sf_dir) that returns a DataFrame: the documents it keeps with all
their columns, and for the last stage the shards.  It works on all that its predecessor kept; the other
tables it needs are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.decontam import decontaminate
from linkloom.llm.mixing import label_domains, mix_documents
from linkloom.llm.quality import keep_quality
from linkloom.llm.sharding import shard_documents
from linkloom.llm.shared import own_tables, remove
from linkloom.llm.simhash import keep_one

#: Shares of the tokens after mixing: clean documents stay once, what is left of the others is thinned.
TARGETS = {"clean": 0.994, "low": 0.003, "toxic": 0.003}
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go."""
    return keep_quality(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: three-word shingles, three bits."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay by their rate; toxic ones and those of low quality are thinned out."""
    return mix_documents(docs, label_domains(_table(spark, sf_dir, "labels")), TARGETS, keep="clean")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document, with its other columns."""
    return shard_documents(docs, SHARDS, carry=tuple(docs.columns))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A trained network and fitted rates have no SQL form; tests hold each stage against a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents, each result written before the next stage reads it.

    What a stage writes for itself is deleted with its end, and a stage's result when the next one has
    read it; only what the shards are read from stays.
    """
    docs, before = _table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with own_tables(spark) as keep:
            kept = keep(stage(spark, docs, sf_dir))
        if before is not None:
            remove(before)
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
