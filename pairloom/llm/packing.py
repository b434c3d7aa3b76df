"""Best-fit packing of token sequences by minimum bin slack.

Method: the piece lengths form a histogram with at most ``capacity`` entries. For each bin the longest length left
opens it and a bitset subset-sum dynamic programme over the available lengths finds the fullest combination for the
room left; the combination is removed as often as the counts allow, so the number of distinct bin patterns depends
on the capacity and not on the number of documents. The plan (a few rows a length) is broadcast and pieces find
their slot from their rank within their length, which is computed per (length, hash bucket): a length shared by a
third of all pieces is dealt over all buckets.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load_ranks, load_tokenizer, materialise, slices, tokenizer_file
from .token_counts import pre_tokens

_CACHE = 250_000
_TAIL = ".,;:!?)"


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths (at most ``counts`` of each) whose sum is the largest not above ``room``.

    Bit s of ``reach`` says that some choice sums to s; longer lengths come first, counts are split binarily.
    """
    mask, reach, layers = (1 << room + 1) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            layers.append((length, take, reach))
            reach |= reach << take * length & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    s, use = reach.bit_length() - 1, {}
    for length, take, before in reversed(layers):
        if not before >> s & 1:
            s -= take * length
            use[length] = use.get(length, 0) + take
    return use


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths with their copies, how many bins) patterns that use up ``counts`` exactly."""
    counts, plan = {k: v for k, v in counts.items() if v > 0}, []
    while counts:
        seed = max(counts)
        left = {k: v - (k == seed) for k, v in counts.items() if v > (k == seed)}
        use = fullest(left, capacity - seed)
        use[seed] = use.get(seed, 0) + 1
        times = min(counts[k] // n for k, n in use.items())
        plan.append((use, times))
        for k, n in use.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return plan


class _Ids(dict):
    """Little-endian unsigned 32-bit ids of the parts of texts; keeps the parts seen last in two generations."""

    def __init__(self, tokenizer: str, led: str):
        self.tok, self.ranks, self.led, self.old = load_tokenizer(tokenizer), load_ranks(tokenizer), led, {}
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def __missing__(self, part):
        if len(self) >= _CACHE:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(part)
        if ids is None:
            ids = self._encode(self.led + part)
        self[part] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        if self.ranks is not None and not any(s in text for s in self.specials):
            return array("I", self.ranks.encode_ordinary(text)).tobytes()
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()


def _pieces(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        led, first, tail = _Ids(tokenizer, " "), _Ids(tokenizer, ""), end_id.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    head, *rest = pre_tokens(text)
                    ids = first[head] + b"".join(map(led.__getitem__, rest)) + tail
                    n = len(ids) // 4
                    at = n % capacity if n > capacity else n
                    cuts = [0, *range(at or capacity, n + 1, capacity)]
                    for k in range(len(cuts) - 1):
                        a, b = cuts[k], cuts[k + 1]
                        out.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                cols = list(zip(*out, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids with ``end_id`` behind, longer ones cut.

    All pieces of a cut document but its first are ``capacity`` long. A null or empty text is the end id alone.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_pieces(tokenizer or tokenizer_file(), capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """``parts`` (a stored table with doc_id, piece, ids_crc32 and length 1..capacity) with sequence_id and offset."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    buckets = max(64, sum(counts.values()) // 50_000)
    slots, used, bins = [], {}, 0
    for use, times in plan_bins(counts, capacity):
        at = 0
        for length, n in sorted(use.items(), reverse=True):
            slots.append((length, used.get(length, 0), used.get(length, 0) + n * times, n, bins, at))
            used[length] = used.get(length, 0) + n * times
            at += length * n
        bins += times
    schema = "length long, lo long, hi long, copies long, bin long, at long"
    plan = spark.createDataFrame(slots, schema)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    keyed = parts.withColumn("_bucket", bucket)
    before = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_rank", F.row_number().over(order) - 1).join(before.drop("_n"), ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
    hit = (F.col("p.length") == F.col("s.length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    # the plan's size depends on the capacity alone: a few patterns for each of `capacity` lengths
    placed = ranked.alias("p").join(F.broadcast(plan.alias("s")), hit)
    nth = F.col("_rank") - F.col("lo")
    return placed.select(
        *(F.col(f"p.{c}") for c in parts.columns),
        (F.col("bin") + F.floor(nth / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("copies")) * F.col("p.length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    Pieces in a sequence are gapless from offset 0 and hold at most ``capacity`` tokens. Null and empty texts are
    pieces of one token; repeated rows are packed one by one; null ids stay null; an empty table gives no rows; other
    columns are ignored whatever their names.
    """
    return place(materialise(pieces(docs, tokenizer, capacity, end_id, id_col, text_col)), capacity)
