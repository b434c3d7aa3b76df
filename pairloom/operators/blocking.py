"""Candidate pairs from shared keys: character n-grams, words or any array column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import copies, overlap, tfidf
from .sampling import hash_order, take


#: From so many classes on, only those that share a rare key meet.
MANY = 20_000


def shared_key_topk(df: DataFrame, keys: Column, k: int, id_col: str = "id", max_block: int | None = None) -> DataFrame:
    """i, j, shared, rank: the ``k`` rows that share most keys with each row; ties go to the smaller id.

    Rows of equal keys (by MD5) are one class. Classes meet as tiles of blocks (see ``tfidf.topk``), so a key of all rows
    costs neither shuffle nor skew, and a row gets its neighbours from its class. ``MANY`` classes or more meet by their
    rare keys instead (see ``overlap.topk``), with the same result. ``max_block`` leaves out keys of more rows, which say
    little.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), keys.alias("keys")).filter("id is not null")
    if max_block:
        each = rows.select("id", F.explode("keys").alias("key"))
        each = each.join(each.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") <= max_block).select("key"), "key", "left_semi")
        rows = each.groupBy("id").agg(F.collect_list("key").alias("keys"))
    elif not rows.groupBy("id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))
    rows = rows.filter(F.size("keys") > 0)
    value = F.md5(F.array_join(F.transform(F.sort_array(F.transform("keys", lambda x: x.cast("string"))), lambda x: F.concat(F.length(x), F.lit(":"), x)), ""))
    of = copies.classes(rows, value)
    reps = of.filter("id = rep").select("id")
    held, n = rows.join(reps, "id", "left_semi"), reps.count()
    found = overlap.topk(held, k + 1) if n >= MANY else None
    if found is None:
        held = held.select("id", F.explode("keys").alias("term"), F.lit(1.0).alias("weight"))
        found = tfidf.topk(held, held, k + 1, sizes=(n, n))
    return copies.neighbours(found, of, k).select("i", "j", F.col("score").cast("long").alias("shared"), "rank")


def blocks(df: DataFrame, keys: Column, seed, block_cap: int | None = 1000, id_col: str = "id") -> DataFrame:
    """id, keys: for each row the sorted keys of the blocks that hold it and another row.

    Blocks keep ``block_cap`` rows chosen by hash: a block is a sample of at most so many rows; None keeps all.
    """
    each = df.select(F.col(id_col).cast("long").alias("id"), F.explode(keys).alias("key")).filter("key is not null")
    if block_cap is not None:  # rows of one id and key tie, so they need not be made distinct before
        nth = F.dense_rank().over(Window.partitionBy("key").orderBy(*hash_order(seed, "key", "id")))
        each = each.withColumn("_nth", nth).filter(F.col("_nth") <= block_cap).drop("_nth")
    whole = Window.partitionBy("key")
    each = each.withColumn("_first", F.min("id").over(whole)).withColumn("_last", F.max("id").over(whole)).filter("_first < _last")
    return each.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))


def block_pairs(held: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """i, j (i < j): the pairs of rows of ``held`` (id, keys: sorted) with a common key, each once.

    A pair is made by the first of its common keys only, so pairs are neither exchanged nor compared to be distinct.
    The columns ``carry`` of both rows follow, as ``<name>_i`` and ``<name>_j``.
    """
    each = held.select("id", F.explode("keys").alias("key"), "keys", *carry)
    each = each.select("key", "id", F.filter("keys", lambda x: x < F.col("key")).alias("before"), *carry)
    side = lambda name: each.select("key", F.col("id").alias(name), F.col("before").alias(f"_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in carry))
    known = (F.size("_i") > 0) & (F.size("_j") > 0) & F.arrays_overlap("_i", "_j")
    return side("i").join(side("j"), "key").filter("i < j").filter(~known).select("i", "j", *(f"{c}_{n}" for n in "ij" for c in carry))


def in_blocks(found: DataFrame, held: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``found`` (i, j) with ``_both``: whether ``held`` (id, keys) has a common key of the two; ``carry`` as in ``block_pairs``.

    With ``carry`` pairs of a row that ``held`` does not have are dropped; its keys may be null there.
    """
    for n in "ij":
        side = held.select(F.col("id").alias(n), F.col("keys").alias(f"_{n}"), *(F.col(c).alias(f"{c}_{n}") for c in carry))
        found = found.join(side, n, "inner" if carry else "left")
    return found.select("i", "j", *(f"{c}_{n}" for n in "ij" for c in carry), F.coalesce(F.arrays_overlap("_i", "_j"), F.lit(False)).alias("_both"))


def combine_blocks(held: DataFrame, found: DataFrame, mode: str = "union", carry: tuple[str, ...] = ()) -> DataFrame:
    """Unordered ``union`` or ``intersection`` of the pairs of blocks (``held``: id, keys) and ``found`` (distinct, i < j).

    As ``pairs.combine`` of ``block_pairs``, but only ``found`` is exchanged: that a pair is in a block is seen from the
    keys of its two rows. ``carry`` as in ``in_blocks``.
    """
    if mode not in ("union", "intersection"):
        raise ValueError(f"unknown mode {mode!r}; one of ['intersection', 'union']")
    marked = in_blocks(found, held, carry)
    if mode == "intersection":
        return marked.filter("_both").drop("_both")
    return block_pairs(held.filter("keys is not null"), carry).unionByName(marked.filter("not _both").drop("_both"))


def key_block_pairs(df: DataFrame, keys: Column, seed, block_cap: int | None = 1000, id_col: str = "id") -> DataFrame:
    """i, j (i < j): distinct pairs of rows in a common block; blocks keep ``block_cap`` rows chosen by hash.

    The cap is the operator's own sampling rule: a block is a sample of at most ``block_cap`` rows; None keeps all.
    """
    return block_pairs(materialise(blocks(df, keys, seed, block_cap, id_col)))


def cap_per_record(pairs: DataFrame, cap: int, seed, total: int | None = None) -> DataFrame:
    """Pairs whose place in the hash order is among the first ``cap`` of both records, in whichever position; then ``total``."""
    order = hash_order(seed, "i", "j")
    ends = pairs.select("i", "j", F.explode(F.array("i", "j")).alias("id")).withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    passing = ends.groupBy("i", "j").agg(F.max("nth").alias("nth")).filter(F.col("nth") <= cap).select("i", "j")
    return take(passing, total, seed, ["i", "j"]) if total else passing
