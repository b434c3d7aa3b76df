"""Encoders: record text to vectors. Any callable from records (id, text) to (id, vec) is one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .tfidf import term_counts, vocabulary, weights


def hashed_tfidf(records: DataFrame, dims: int = 256, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """id, vec: TF-IDF weights added, with a hashed sign, into ``dims`` hashed places.

    Every record has a vector; one without words has zeros. The exchange by (id, place) is combined before, and a
    vector is gathered from at most ``dims`` places. The vectors are stored, as searches read them several times.
    """
    counts = term_counts(records, "id", "text")
    held = weights(counts, vocabulary(counts, records.count(), min_df, max_df))
    h = F.xxhash64("term")
    signed = F.when(F.shiftrightunsigned(h, 40).bitwiseAND(1) == 1, F.col("weight")).otherwise(-F.col("weight"))
    places = held.groupBy("id", F.pmod(h, F.lit(dims)).cast("int").alias("place")).agg(F.sum(signed).alias("x"))
    vectors = places.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("place", "x"))).alias("m"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    return materialise(records.select(F.col("id").cast("long").alias("id")).join(vectors, "id", "left").select("id", vec.alias("vec")))


def cached(path: str, records: DataFrame, encoder=hashed_tfidf) -> DataFrame:
    """The vectors stored at ``path``; encoded and stored there first if there are none."""
    spark = records.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        encoder(records).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
