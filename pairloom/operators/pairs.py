"""Pair tables: orientation, set operations, labels, exclusion and quota retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the smaller id first."""
    return pairs.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def combine(a: DataFrame, b: DataFrame, mode: str = "union") -> DataFrame:
    """Unordered ``union``, ``intersection`` or either side (``first``, ``second``) of two pair tables."""
    a, b = unordered(a), unordered(b)
    modes = {"union": lambda: a.union(b).distinct(), "intersection": lambda: a.intersect(b), "first": lambda: a, "second": lambda: b}
    if mode not in modes:
        raise ValueError(f"unknown mode {mode!r}; one of {sorted(modes)}")
    return modes[mode]()


def combine_ids(a: DataFrame, b: DataFrame, mode: str = "union") -> DataFrame:
    """Distinct ``union``, ``intersection`` or ``difference`` of two tables of one column; also of truth pairs."""
    modes = {"union": lambda: a.union(b).distinct(), "intersection": lambda: a.intersect(b), "difference": lambda: a.distinct().join(b, a.columns, "left_anti")}
    if mode not in modes:
        raise ValueError(f"unknown mode {mode!r}; one of {sorted(modes)}")
    return modes[mode]()


def assert_disjoint(*tables: DataFrame) -> None:
    """A ValueError if two of the tables share a row; only one shared row is looked for."""
    for k, a in enumerate(tables):
        for b in tables[k + 1 :]:
            if not a.intersect(b).isEmpty():
                raise ValueError("the tables share rows")


def label_by_cluster(pairs: DataFrame, clusters: DataFrame, rule: str = "equal") -> DataFrame:
    """``pairs`` with ``label``: 1 if both sides (``clusters``: id, cluster) have the same cluster.

    Rules: ``equal``; ``equal_nonzero`` and ``equal_nonempty`` never match the cluster 0 or the empty one. Pairs with an
    unknown side are dropped; a null cluster matches nothing.
    """
    a, b = clusters.select(F.col("id").alias("i"), F.col("cluster").alias("_a")), clusters.select(F.col("id").alias("j"), F.col("cluster").alias("_b"))
    label = same_cluster(F.col("_a"), F.col("_b"), rule)
    return pairs.join(a, "i").join(b, "j").select(*pairs.columns, label.alias("label"))


def same_cluster(a: Column, b: Column, rule: str = "equal") -> Column:
    """1 if the clusters ``a`` and ``b`` match by the ``rule`` of ``label_by_cluster``, else 0."""
    same = {"equal": a == b, "equal_nonzero": (a == b) & (a != 0), "equal_nonempty": (a == b) & (a.cast("string") != "")}
    if rule not in same:
        raise ValueError(f"unknown rule {rule!r}; one of {sorted(same)}")
    return F.coalesce(same[rule], F.lit(False)).cast("int")


def label_by_truth(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs`` with ``label``: 1 if the unordered pair is in ``truth`` (i, j)."""
    known = unordered(truth).withColumn("_hit", F.lit(1)).select(F.col("i").alias("_i"), F.col("j").alias("_j"), "_hit")
    hit = (F.least("i", "j") == F.col("_i")) & (F.greatest("i", "j") == F.col("_j"))
    return pairs.join(known, hit, "left").select(*pairs.columns, F.coalesce("_hit", F.lit(0)).alias("label"))


def lookup_texts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` with text1, text2 (``records``: id, text)."""
    a, b = records.select(F.col("id").alias("i"), F.col("text").alias("text1")), records.select(F.col("id").alias("j"), F.col("text").alias("text2"))
    return pairs.join(a, "i").join(b, "j").select(*pairs.columns, "text1", "text2")


def exclude_clusters(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``records`` (id, cluster) whose cluster has no record in ``pairs``."""
    used = pairs.select(F.explode(F.array("i", "j")).alias("id")).join(records.select("id", "cluster"), "id").select("cluster").distinct()
    return records.join(used, "cluster", "left_anti").select(*records.columns)


def quota_topk(scored: DataFrame, k: int, share: float = 0.3) -> DataFrame:
    """i, j, score, is_match, rank: of each query's candidates ``int(k * share)`` matches and non-matches for the rest.

    What one kind can't fill comes from the best candidates left; the result is ranked by score again.
    """
    n = int(k * share)
    by = Window.partitionBy("i", "is_match").orderBy(F.col("score").desc(), "j")
    first = F.when(F.col("is_match") == 1, F.lit(n)).otherwise(F.lit(k - n))
    ranked = scored.withColumn("_chosen", (F.row_number().over(by) <= first).cast("int"))
    fill = ranked.withColumn("_nth", F.row_number().over(Window.partitionBy("i").orderBy(F.col("_chosen").desc(), F.col("score").desc(), "j"))).filter(F.col("_nth") <= k)
    return fill.withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy(F.col("score").desc(), "j")).cast("int")).select("i", "j", "score", "is_match", "rank")
