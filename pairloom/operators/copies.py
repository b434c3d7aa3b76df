"""Rows of equal values as classes, so that a search compares values, not rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise


def classes(rows: DataFrame, value: Column) -> DataFrame:
    """id, rep (a stored table): the smallest id of the rows whose ``value`` is equal; rows without id are left out."""
    own = rows.filter("id is not null").select(F.col("id").cast("long").alias("id"), value.alias("_v"))
    least = own.groupBy("_v").agg(F.min("id").alias("rep")).withColumnRenamed("_v", "_of")
    return materialise(own.join(least, F.col("_v").eqNullSafe(F.col("_of"))).select("id", "rep"))


def neighbours(found: DataFrame, of: DataFrame, k: int) -> DataFrame:
    """i, j, score, rank: the ``k`` best rows for each row of ``of`` (``classes``), ties to the smaller id, itself left out.

    ``found`` (i, j, score) has for each class its ``k + 1`` best classes, itself among them, ties to the smaller rep. No
    row beyond those can be among the best: a class before that of a row has a row before it.
    """
    few = Window.partitionBy("rep").orderBy("id")
    first = of.withColumn("_nth", F.row_number().over(few)).filter(F.col("_nth") <= k + 1)
    first = materialise(first.groupBy(F.col("rep").alias("j")).agg(F.collect_list("id").alias("_ids")).filter(F.size("_ids") > 1))  # none or few where rows differ
    best = Window.partitionBy("i").orderBy(F.col("score").desc(), "id")
    rows = found.select("i", "j", "score").join(first, "j", "left").select("i", F.explode(F.coalesce("_ids", F.array("j"))).alias("id"), "score")
    rows = rows.withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= k + 1)
    lists = rows.groupBy(F.col("i").alias("rep")).agg(F.sort_array(F.collect_list(F.struct("_nth", "id", "score"))).alias("_best"))
    near = F.slice(F.filter("_best", lambda x: x["id"] != F.col("i")), 1, k)
    each = of.withColumnRenamed("id", "i").join(lists, "rep").select("i", F.posexplode(near).alias("_at", "_b"))
    return each.select("i", F.col("_b.id").alias("j"), F.col("_b.score").alias("score"), (F.col("_at") + 1).cast("int").alias("rank"))
