"""Reproducible sampling, splitting and resampling: every random choice is an order by a hash of seed and key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise


FEW = 10_000


def hash_order(seed, *keys: str) -> list[Column]:
    """Sort columns that permute rows by ``keys``."""
    return [F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))), *(F.col(k) for k in keys)]


def with_rank(df: DataFrame, seed, keys: list[str], by: list[str] | None = None, name: str = "_rank", few: bool = False, total: str | None = None) -> DataFrame:
    """``df`` with the 1-based place of each row in the permutation, within ``by`` if given; ``total`` names their number.

    Without ``by``, or where it has ``few`` values (labels, splits), the place is computed without a one-task sort: rows
    are dealt to 4096 buckets by their hash's first three digits, ranked within and offset by the sizes of the buckets
    before.
    """
    order = hash_order(seed, *keys)
    if by and not few:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    by = by or []
    dealt = df.withColumn("_h", order[0]).withColumn("_bucket", F.substring("_h", 1, 3))
    sizes = dealt.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))  # 4096 rows at most for each value of ``by``
    whole = Window.partitionBy(*by)
    before = sizes.withColumn("_before", F.sum("_n").over(whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n"))
    before = before.withColumn("_total", F.sum("_n").over(whole)).select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_bucket").alias("_of"), "_before", "_total")
    ranked = dealt.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_h", *order[1:])))
    same = F.col("_bucket") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = ranked.join(F.broadcast(before), same).withColumn(name, F.col("_own") + F.col("_before"))
    return out.select(*df.columns, name, *([F.col("_total").alias(total)] if total else []))


def take(df: DataFrame, n: int, seed, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """``n`` rows without replacement, of each ``by`` if given.

    More than ``FEW`` rows are neither sorted nor sent to one task: buckets by the first digits of the hash are counted,
    whole ones stay, and only the one that holds the border is sorted. ``df`` is read twice then.
    """
    if by is None and n <= FEW:
        return df.orderBy(*hash_order(seed, *keys)).limit(n)
    if by is None:
        dealt = df.withColumn("_h", hash_order(seed, *keys)[0]).withColumn("_bucket", F.substring("_h", 1, 3))
        left = n
        for r in sorted(dealt.groupBy("_bucket").count().collect()):  # 4096 rows at most
            if r["count"] > left:
                border = dealt.filter(F.col("_bucket") == r["_bucket"]).orderBy("_h", *keys).limit(left)
                return dealt.filter(F.col("_bucket") < r["_bucket"]).unionByName(border).select(*df.columns)
            left -= r["count"]
        return df
    return with_rank(df, seed, keys, by).filter(F.col("_rank") <= n).drop("_rank")


def anchors(df: DataFrame, target_pairs: int | None, top_k: int, seed, key: str) -> DataFrame:
    """As many rows as give about ``target_pairs`` pairs of ``top_k`` each: between 1 and all; all without a target."""
    if not target_pairs or target_pairs <= 0:
        return df
    return take(df, max(1, target_pairs // max(1, top_k)), seed, [key])


def _label_split(rank: Column, train: Column, valid: Column) -> Column:
    return F.when(rank <= train, "train").when(rank <= train + valid, "valid").otherwise("test")


def random_split(df: DataFrame, seed, keys: list[str], train: float = 0.8, valid: float = 0.1, least: int = 0) -> DataFrame:
    """``df`` with ``split``: the floors of the shares, ``least`` rows at least in train and valid, the rest is test."""
    share = lambda x: F.greatest(F.lit(least).cast("long"), F.floor(F.col("_n") * F.lit(x)))
    return with_rank(df, seed, keys, total="_n").withColumn("split", _label_split(F.col("_rank"), share(train), share(valid))).drop("_rank", "_n")


def guarded_split(df: DataFrame, seed, keys: list[str], label: str = "label", train: float = 0.8, valid: float = 0.1) -> DataFrame:
    """``stratified_split``, or ``random_split`` where there is one label only or a label has one row."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.count("*").alias("labels"), F.min("n").alias("least")).first()
    if sizes["labels"] < 2 or sizes["least"] < 2:
        return random_split(df, seed, keys, train, valid)
    return stratified_split(df, seed, keys, label, train, valid)


def size_matched(a: DataFrame, b: DataFrame, seed, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables cut, by hash, to the rows of the smaller one."""
    a, b = materialise(a), materialise(b)
    n = min(a.count(), b.count())
    return take(a, n, seed, keys), take(b, n, seed, keys)


def stratified_split(df: DataFrame, seed, keys: list[str], label: str = "label", train: float = 0.8, valid: float = 0.1) -> DataFrame:
    """``df`` with ``split``, split within each label; each label has a training row at least."""
    ranked = with_rank(df.filter(F.col(label).isNotNull()), seed, keys, [label], few=True, total="_n")
    n_train = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(train)))
    return ranked.withColumn("split", _label_split(F.col("_rank"), n_train, F.floor(F.col("_n") * F.lit(valid)))).select(*df.columns, "split")


def cluster_split(pairs: DataFrame, clusters: DataFrame, seed, train: float = 0.8, valid: float = 0.1) -> DataFrame:
    """``pairs`` (i, j, ...) with the split both sides' clusters share; pairs across splits are dropped.

    ``clusters``: id, cluster. Clusters, not pairs, are split, so no entity is in two splits.
    """
    named = random_split(clusters.select("cluster").distinct(), seed, ["cluster"], train, valid)
    of = clusters.join(named, "cluster").select("id", "split")
    a, b = of.toDF("i", "split"), of.toDF("j", "_other")
    return pairs.join(a, "i").join(b, "j").filter(F.col("split") == F.col("_other")).select(*pairs.columns, "split")


def ratio_resample(df: DataFrame, ratio: float, seed, keys: list[str], label: str = "label") -> DataFrame:
    """All positives and so many negatives that positives are ``ratio`` of all; all negatives if there are fewer."""
    df = materialise(df)
    n_pos = df.filter(F.col(label) == 1).count()
    n_neg = round(n_pos * (1 - ratio) / ratio)
    negatives = take(df.filter(F.col(label) == 0), n_neg, seed, keys)
    return df.filter(F.col(label) == 1).unionByName(negatives)


def resampled_split(df: DataFrame, ratio: float, seed, keys: list[str], label: str = "label", train: float = 0.8, valid: float = 0.1) -> DataFrame:
    """``stratified_split`` of ``ratio_resample`` in the same order, without storing or exchanging ``df``.

    Rows of a label are counted by the first digits of their hash. A bucket that lies in one share as a whole gives its
    rows that split; only the buckets in which a share ends are sorted. ``df`` is made three times.
    """
    dealt = df.filter(F.col(label).isin(0, 1)).withColumn("_h", hash_order(seed, *keys)[0]).withColumn("_bucket", F.substring("_h", 1, 3))
    sizes = {0: {}, 1: {}}
    for r in dealt.groupBy(label, "_bucket").count().collect():  # 4096 rows at most for each label
        sizes[r[label]][r["_bucket"]] = r["count"]
    n = {x: sum(s.values()) for x, s in sizes.items()}
    n[0] = min(n[0], round(n[1] * (1 - ratio) / ratio))
    edge, whole, sorted_split = F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string")
    for x, most in n.items():
        first = max(1, math.floor(most * train))
        ends = [min(most, first), min(most, first + math.floor(most * valid)), most]
        held, left = [], 0  # the buckets in which a share ends and the rows before each
        for b in sorted(sizes[x]):
            if any(left < e <= left + sizes[x][b] for e in ends):
                held.append((b, left))
            left += sizes[x][b]
        own = lambda e: next((b for b, before in held if before < e <= before + sizes[x][b]), "")  # noqa: B023, E731
        share = lambda inside: F.when(inside[0], "train").when(inside[1], "valid").when(inside[2], "test")
        place = F.col("_nth")
        for b, before in held:
            place = F.when(F.col("_bucket") == b, F.col("_nth") + before).otherwise(place)
        this = F.col(label) == x
        edge = edge | (this & F.col("_bucket").isin([b for b, _ in held]))
        whole = F.when(this, share([F.col("_bucket") < own(e) for e in ends])).otherwise(whole)
        sorted_split = F.when(this, share([place <= e for e in ends])).otherwise(sorted_split)
    nth = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_h", *keys))
    inside = dealt.filter(~edge).withColumn("split", whole)
    across = dealt.filter(edge).withColumn("_nth", nth).withColumn("split", sorted_split)
    out = [*df.columns, "split"]
    return inside.select(*out).unionByName(across.select(*out)).filter(F.col("split").isNotNull())


def capped_resample(df: DataFrame, ratio: float, target: int, seed, keys: list[str], label: str = "label") -> DataFrame:
    """As ``ratio_resample`` with at most ``target // 2`` positives and truncated counts; empty without positives."""
    df = materialise(df)
    positives = take(df.filter(F.col(label) == 1), target // 2, seed, keys)
    n = positives.count()
    return positives.unionByName(take(df.filter(F.col(label) == 0), int(n * (1 - ratio) / ratio) if n else 0, seed, keys))


def balance(df: DataFrame, total: int, most_per_positive: int, seed, keys: list[str], label: str = "label") -> DataFrame:
    """At most ``most_per_positive`` negatives a positive, at least as many negatives as positives, ``total`` rows at most."""
    n_pos = min(df.filter(F.col(label) == 1).count(), total // 2)
    n_neg = max(n_pos, min(n_pos * most_per_positive, total - n_pos))
    return take(df.filter(F.col(label) == 1), n_pos, seed, keys).unionByName(take(df.filter(F.col(label) == 0), n_neg, seed, keys))


def diverse_clusters(sizes: DataFrame, n: int, bins: int, seed) -> DataFrame:
    """cluster, bin of ``n`` clusters spread over ``bins`` equal bins by size (``sizes``: cluster, n).

    The bins are cut where a single sort by size and name would cut them, without such a sort: only the sizes that
    straddle a border are ranked by name.
    """
    counts = sizes.groupBy("n").agg(F.count("*").alias("_k"))  # a row for each distinct size
    every = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = counts.withColumn("_lo", F.sum("_k").over(every) - F.col("_k")).withColumn("_total", F.sum("_k").over(Window.partitionBy()))
    size, more = F.floor(F.col("_total") / bins), F.col("_total") % bins
    wide = more * (size + 1)  # the first bins have one more
    of = lambda place: F.when(place < wide, F.floor(place / (size + 1))).otherwise(more + F.floor((place - wide) / F.greatest(size, F.lit(1)))).cast("int") + 1
    runs = runs.withColumn("_first", of(F.col("_lo"))).withColumn("_last", of(F.col("_lo") + F.col("_k") - 1))
    placed = sizes.join(runs, "n")
    inside = placed.filter("_first = _last").select("cluster", F.col("_first").alias("bin"))
    rank = F.row_number().over(Window.partitionBy("n").orderBy("cluster")) - 1
    across = placed.filter("_first < _last").withColumn("bin", of(F.col("_lo") + rank)).select("cluster", "bin")
    quota = F.lit(n // bins) + F.when(F.col("bin") <= n % bins, 1).otherwise(0)
    return with_rank(inside.union(across), seed, ["cluster"], ["bin"], few=True).filter(F.col("_rank") <= quota).select("cluster", "bin")


def naive_pairs(ids: DataFrame, m: int, seed, id_col: str) -> DataFrame:
    """i, j: ``m`` random pairs with replacement, without self pairs and repeats."""
    numbered = with_rank(ids.select(F.col(id_col).alias("id")), seed, ["id"], name="_nth")
    n = ids.count()
    place = lambda side: F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(side), F.col("id").cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(n)) + 1
    drawn = ids.sparkSession.range(m).select(place("a").alias("a"), place("b").alias("b"))
    left, right = numbered.select(F.col("_nth").alias("a"), F.col("id").alias("i")), numbered.select(F.col("_nth").alias("b"), F.col("id").alias("j"))
    return drawn.join(left, "a").join(right, "b").filter("i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
