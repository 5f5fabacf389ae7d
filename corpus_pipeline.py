"""Corpus preparation: five stages over documents, each reading what the one before has written.

Quality rules drop what they reject; of each group of near-duplicates the document with the least
id stays; documents contaminated by the benchmark go; sources are mixed to their target weights,
which repeats documents; the last stage deals the mix to shards of nearly equal size.

Defined results for all stages: no column but ``text`` and ``doc_id`` (and ``source`` in the mix)
decides anything, so nulls and clashing names elsewhere are passed on; rows that are equal in these are
interchangeable; very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import decontaminate, jaccard, mix, quality, shard
from kinfold.llm.store import forget, settle

SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy keeps.  A null or empty text has too few words and goes; repeated rows
    stay or go together."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component; repeated rows of one id and text are one.
    Texts without words are linked with nothing and stay, all of them."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination; a null or empty text has none and stays."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a text cut where its source's target ends.  Texts without
    words are never taken; a null source is a source, the last one."""
    return mix.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``; a null text has size 1, as an empty one; columns of these
    names are replaced."""
    return shard.shard(docs, SHARDS, key=shard.text_key(), size=shard.text_size())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: Components and the schedule of the mix are beyond SQL; a brute-force version tests the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
            if before is not None:  # a stage's table is read by the next one alone
                forget(spark, before)
            before = docs
    return docs
