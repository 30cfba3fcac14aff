"""From raw documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next one's ``docs``.  All but the last
return the columns of ``documents``.  Nulls in any column, repeated rows, empty
texts and empty tables are treated as each operator says; no stage fails on
them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldtally.llm import minhash, packing, quality, toxicity
from fieldtally.llm.common import Table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = quality.quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("quality.predicted = 1").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    scored = toxicity.toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("toxicity.predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("packing", pack_sequences),
]

#: The classifiers are trained and the packing is planned: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    earlier = None
    for name, stage in STAGES[:-1]:
        table = Table(stage(spark, docs, sf_dir), name)
        if earlier is not None:
            earlier.drop()  # all that was read of it is written
        earlier, docs = table, table.read()
    return STAGES[-1][1](spark, docs, sf_dir)
