"""Exact deduplication against a minimal perfect hash over the distinct historical digests.

Method: the distinct digests of the history fall into small buckets, and runs of buckets make shards of bounded
size. Each shard gets a minimal perfect hash of the hash-and-displace kind: a bucket's pilot is the first number that
sends all its keys to free slots, of which a shard has as many as keys. A slot holds the whole 32-byte digest and the
locator of the winner (id, code points, row, group size). A document looks up its bucket's pilot, computes its slot
and compares the whole digest stored there; members are repeats of the winner, non-members are grouped among
themselves.

Scale: pilots and slots are DataFrames, never broadcast by force and never on the driver. Digest groups are combined
before the exchange, so a group with a third of all rows is one row a task; the look-up joins are plain equi-joins
that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import located, materialise

_SHARD_KEYS = 20_000
_PER_BUCKET = 4


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, n_points (code points of the whole text), digest (SHA-256 of the text without ASCII white space), row (``row_col``, or numbered here)."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).alias("n_points"), F.unhex(F.sha2(bare, 256)).alias("digest"), row.alias("row"))


def winners(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_row, group_size: of each digest the row with the most code points, then the smallest id."""
    best = F.struct("n_points", F.bitwise_not("doc_id").alias("minus_id"), "row")  # ~x falls as x rises, without overflow
    grouped = rows.groupBy("digest").agg(F.max(best).alias("best"), F.count("*").alias("group_size"))
    return grouped.select("digest", F.bitwise_not("best.minus_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


def hash_longs(*values):
    """numpy counterpart of Spark's ``xxhash64`` over long columns (XXH64 of each 8-byte value, seeded by the last)."""
    import numpy as np

    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = np.uint64(42)
    with np.errstate(over="ignore"):
        for v in values:
            h = (h + p5 + np.uint64(8)) ^ (turn(np.asarray(v).astype(np.uint64) * p2, 31) * p1)
            h = turn(h, 27) * p1 + p4
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            h = h ^ (h >> np.uint64(32))
    return h.astype(np.int64)


def perfect_hash(low, buckets):
    """Pilots (one a bucket) that map the distinct 64-bit keys ``low`` one to one onto ``range(len(low))``.

    A key's slot is ``pmod(hash_longs(low, pilot), len(low))``. Large buckets choose first.
    """
    import numpy as np

    n, n_buckets = len(low), int(buckets.max()) + 1 if len(buckets) else 0
    pilots, taken = np.zeros(n_buckets, np.int64), np.zeros(n, bool)
    order = np.argsort(buckets, kind="stable")
    ends = np.cumsum(np.bincount(buckets, minlength=n_buckets))
    sizes = np.diff(np.r_[0, ends])
    placed = 0
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        keys, first, width = low[order[ends[b] - sizes[b] : ends[b]]], 0, 16
        free = max(1, n - placed) / n
        width = int(min(65_536, 16 / free ** float(sizes[b])))
        while True:
            tries = np.arange(first, first + width)
            slots = hash_longs(np.broadcast_to(keys, (width, len(keys))), np.broadcast_to(tries[:, None], (width, len(keys)))) % n
            good = ~taken[slots].any(1)
            if sizes[b] > 1:
                s = np.sort(slots, 1)
                good &= (s[:, 1:] != s[:, :-1]).all(1)
            if good.any():
                k = int(good.argmax())
                pilots[b] = first + k
                taken[slots[k]] = True
                placed += len(keys)
                break
            first, width = first + width, min(width * 2, 65_536)
            if first > 1 << 32:
                raise ValueError("two distinct digests of a shard agree in 64 hash bits")
    return pilots


def _build(pdf):
    """One shard: rows (kind 0: bucket with its pilot; kind 1: slot with digest and locator)."""
    import numpy as np
    import pandas as pd

    low, n = pdf["low"].to_numpy(), len(pdf)
    used, local = np.unique(pdf["bucket"].to_numpy(), return_inverse=True)
    pilots = perfect_hash(low, local)
    slots = hash_longs(low, pilots[local]) % n
    shard = pdf["shard"].iloc[0]
    a = pd.DataFrame({"kind": 0, "shard": shard, "place": used, "pilot": pilots, "n_slots": n})
    b = pdf[["digest", "keep_id", "keep_row", "group_size"]].assign(kind=1, shard=shard, place=slots)
    out = pd.concat([a, b], ignore_index=True)
    out["digest"] = out["digest"].astype(object).where(out["digest"].notna(), None)
    whole = ["pilot", "n_slots", "keep_id", "keep_row", "group_size"]
    out[whole] = out[whole].astype("Int64")
    return out[["kind", "shard", "place", "pilot", "n_slots", "digest", "keep_id", "keep_row", "group_size"]]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(buckets))


def build_index(keys: DataFrame, shard_keys: int = _SHARD_KEYS) -> tuple[DataFrame, int]:
    """(the stored index over ``keys``, its number of buckets); keys: digest (distinct), keep_id, keep_row, group_size."""
    keys = materialise(keys)
    buckets = max(1, -(-keys.count() // _PER_BUCKET))
    dealt = keys.withColumn("low", F.xxhash64("digest")).withColumn("bucket", _bucket(buckets)).withColumn("shard", F.floor(F.col("bucket") / (shard_keys // _PER_BUCKET)))
    dealt = dealt.withColumn("keep_id", F.col("keep_id").cast("long")).withColumn("keep_row", F.col("keep_row").cast("long"))
    schema = "kind int, shard long, place long, pilot long, n_slots long, digest binary, keep_id long, keep_row long, group_size long"
    return materialise(dealt.groupBy("shard").applyInPandas(_build, schema)), buckets


def look_up(rows: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with keep_id, keep_row, group_size of the slot that holds the same 32 bytes; group_size is null for non-members."""
    pilots = index.filter("kind = 0").select(F.col("place").alias("_bucket"), F.col("shard").alias("_shard"), "pilot", "n_slots")
    slots = index.filter("kind = 1").select(F.col("shard").alias("_shard"), F.col("place").alias("_slot"), F.col("digest").alias("_digest"), "keep_id", "keep_row", "group_size")
    found = rows.withColumn("_bucket", _bucket(buckets)).join(pilots, "_bucket", "left")
    found = found.withColumn("_slot", F.pmod(F.xxhash64(F.xxhash64("digest"), F.col("pilot")), F.col("n_slots"))).join(slots, ["_shard", "_slot"], "left")
    same = F.col("digest") == F.col("_digest")  # the byte check: whole digests
    return found.select(*rows.columns, *(F.when(same, F.col(c)).alias(c) for c in ("keep_id", "keep_row", "group_size")))


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when they agree without ASCII white space; a null text counts as empty. Without ``history`` the
    documents are their own history: of equal texts the row with the most code points stays, then the smallest id, then
    one of the repeated rows (a null id stays only if its group has no other). With ``history`` (same columns) documents
    found there are repeats of its winner and are not kept; the others are grouped among themselves. Other columns are
    ignored whatever their names; empty tables give no rows.
    """
    rows = materialise(digests(docs, id_col, text_col))
    past = None if history is None else digests(history, id_col, text_col)
    return _decided(rows, past).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _decided(rows: DataFrame, past: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, row, keep_id, keep_row, group_size, kept of stored ``digests``."""
    index, buckets = build_index(winners(rows if past is None else past))
    found = look_up(rows, index, buckets)
    own = F.lit(past is None)
    members = found.filter("group_size is not null").withColumn("kept", own & (F.col("row") == F.col("keep_row")))
    rest = found.filter("group_size is null").select("doc_id", "n_points", "digest", "row")
    alone = rest.join(winners(rest), "digest").withColumn("kept", F.col("row") == F.col("keep_row"))
    return members.unionByName(alone)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without the repeats that ``exact_dedup`` finds: one row of each group, whatever its id."""
    docs, row = located(docs, id_col)
    kept = _decided(materialise(digests(docs, id_col, text_col, row))).filter("kept")
    if row:
        return docs.join(kept.select(F.col("row").alias(row)), row, "left_semi").drop(row)
    return docs.join(kept.select(F.col("doc_id").alias("_kept_id")), F.col(id_col).cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")
