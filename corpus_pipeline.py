"""The corpus pipeline: toxicity, exact and near duplicates, mixing and packing of ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.

Null texts are empty in every stage, null ids are ids like others that come last, rows that repeat an id are judged one
by one, extra columns pass through under any name, an empty table stays empty, and texts may be of any length. What a
stage decides on ties is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from pairloom.llm.common import materialise
from pairloom.sources import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of the labelled training rows among ``docs``.

    Without labelled rows of both classes the score is the share of toxic ones. Equal texts score alike.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts agree without white space: the most code points, then the smallest id.

    Of rows that also share the id one stays; null and empty texts are one group.
    """
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class by SimHash, or by five-word shingles of similarity 0.8 or more: the smallest id.

    Of rows that share the smallest id one stays.
    """
    return simhash.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 times), dealt to shards and shuffled.

    Rows that repeat id, source and text share their fate; a null source is a source, the last one.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset; repeated rows are packed one by one."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.mark()
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
        scratch.remove(spark, since, keep=docs)  # the stored result is all the next stage needs
    return docs
