"""Mixing sources to target weights: exact block quotas, dealt to output shards by a splitting tree.

Method: the documents of a source are permuted by a hash and cut into blocks of about 16 to 32 documents (larger ones
where that would make more than ``_ALL_BLOCKS`` blocks over all sources, so that their table stays small enough to be
broadcast). A source's target fixes how many passes over all its blocks and how many further blocks the mix
draws: its exact block quota. A tree over the output shards splits the quotas node by node with multivariate
hypergeometric draws, so that shards get what a full shuffle of all drawn blocks would give them. Each shard then
draws its own, disjoint run of the source's permuted blocks, and rows are shuffled within their shard. The last block
of a source is drawn document by document until its target is met.

Only DataFrame functions touch the data. The driver holds a number for each source and shard. Every look-up by document
is a map-side join with the sources, the blocks or the few documents of the last blocks, so documents are never shuffled
by source.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

_BLOCK_DOCS = 16
_MAX_BITS = 16
_ALL_BLOCKS = 1 << 18
_BROADCAST_ROWS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words to take of each source: ``share`` of all sizes by weight, none above ``most`` times its size.

    What a source can't take is shared again among the others by weight, until none is above.
    """
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in sorted(open_) if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` balls, drawn without replacement, are among the ``good`` ones; by inversion."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    lc = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = {mode: math.exp(lc(good, mode) + lc(bad, draws - mode) - lc(good + bad, draws))}
    up, x = p[mode], mode
    while x < high and up > 1e-18:
        up *= (good - x) * (draws - x) / ((x + 1) * (bad - draws + x + 1))
        x += 1
        p[x] = up
    down, x = p[mode], mode
    while x > low and down > 1e-18:
        down *= x * (bad - draws + x) / ((good - x + 1) * (draws - x + 1))
        x -= 1
        p[x] = down
    u = rng.random() * sum(p.values())
    for x in sorted(p):
        u -= p[x]
        if u <= 0:
            return x
    return max(p)


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each shard its blocks of each source: the exact ``quotas``, split recursively in halves."""

    def node(left: list[int], lo: int, hi: int) -> list[list[int]]:
        if hi - lo == 1:
            return [left]
        mid, rng = (lo + hi) // 2, random.Random(f"{seed}/{lo}/{hi}")
        draws, rest, first = sum(left) * (mid - lo) // (hi - lo), sum(left), []
        for q in left:
            rest -= q
            first.append(hypergeometric(rng, q, rest, draws))
            draws -= first[-1]
        return node(first, lo, mid) + node([a - b for a, b in zip(left, first, strict=True)], mid, hi)

    return node(list(quotas), 0, shards)


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small literal table, without RDDs."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= _BROADCAST_ROWS else df


def _order(seed: int, id_col: str, source_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(text_col))


def _prefix(bits: str) -> Column:
    return F.expr(f"shiftrightunsigned(shiftrightunsigned(_h, 1), 63 - {bits})")


def _bits(n: int, most: int = _MAX_BITS) -> int:
    return max(0, min(most, int(math.log2(max(1, n / _BLOCK_DOCS)))))


def _most_bits(counts: list[int]) -> int:
    """The largest bound on a source's block bits that leaves ``_ALL_BLOCKS`` blocks or fewer over all sources."""
    return next((m for m in range(_MAX_BITS, 0, -1) if sum(1 << _bits(n, m) for n in counts) <= _ALL_BLOCKS), 0)


class Mix:
    """The plan of one mix of ``docs``: targets, quotas and drawn blocks, all deterministic in ``seed``."""

    def __init__(self, docs: DataFrame, shards: int = 16, seed: int = 7, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
        spark = docs.sparkSession
        self.seed = seed
        words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
        order = _order(seed, id_col, source_col, text_col)
        self.sized = materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), order.alias("_h")))
        found = self.sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # a row a source
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        sizes = [r["size"] for r in found]
        goals = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
        state, most_bits = [], _most_bits([r["n"] for r in found])
        for i, (r, t) in enumerate(zip(found, goals, strict=True)):
            whole = int(min(most, t // r["size"])) if r["size"] else 0
            bits = _bits(r["n"], most_bits)
            state.append({"sid": i, "source": r["source"], "source_size": r["size"], "target": t, "whole": whole, "bits": bits, "depth": bits, "cut": 0, "left": t - whole * r["size"], "n": r["n"], "extra": 0})
        self._find_cuts(spark, state)
        for s in state:
            s["extra"] = (s["cut"] >> s["depth"] - s["bits"]) + 1 if s["left"] > 0 or s["cut"] else 0
        quotas = [s["whole"] * 2 ** s["bits"] + s["extra"] for s in state]
        self.quotas = split_quotas(quotas, shards, seed) if state else []
        for i, s in enumerate(state):
            s["quota"] = [row[i] for row in self.quotas]
        schema = "sid int, source string, source_size long, target double, whole int, bits int, depth int, cut long, left double, extra int, quota array<int>"
        plan = _table(spark, state, schema)
        self.sources = _small(plan.drop("quota"), len(state))
        self.picked = self._pick(sum(1 for s in state if s["left"] > 0))
        self._n_blocks = sum(2 ** s["bits"] for s in state)
        self.blocks = self._deal(plan)

    def _find_cuts(self, spark: SparkSession, state: list[dict]) -> None:
        """Per source the block in which the running sum of permuted blocks passes the target; split while it is large."""
        todo = [s for s in state if s["left"] > 0]
        schema = "sid int, source string, depth int, more int, cut long, left double"
        first = True
        while todo:
            rows = [{k: s[k] for k in ("sid", "source", "cut", "left")} | {"depth": 0 if first else s["depth"], "more": s["bits"] if first else s["more"]} for s in todo]
            at = _small(_table(spark, rows, schema).withColumnRenamed("source", "_source"), len(rows))
            inside = self.sized.join(at, F.col("source").eqNullSafe(F.col("_source"))).filter(_prefix("depth") == F.col("cut"))
            sums = inside.groupBy("sid", "left", _prefix("(depth + more)").alias("block")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            run = Window.partitionBy("sid").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
            hit = sums.withColumn("upto", F.sum("words").over(run)).filter(F.col("upto") > F.col("left")).groupBy("sid").agg(F.min(F.struct("block", "upto", "words", "n")).alias("b"))
            hits = {r["sid"]: r["b"] for r in hit.collect()}  # a row a source
            for s, row in zip(todo, rows, strict=True):
                s["depth"] = row["depth"] + row["more"]
                if b := hits.get(s["sid"]):
                    s["cut"], s["left"], s["n"] = b["block"], s["left"] - (b["upto"] - b["words"]), b["n"]
                else:  # rounding: the target is the whole of what is there
                    s["cut"], s["left"] = (s["cut"] + 1 << row["more"]) - 1, float("inf")
                    s["n"] = 0
                s["more"] = min(_bits(s["n"]), 60 - s["depth"])
            todo = [s for s in todo if s["more"] > 0]
            first = False
        for s in state:
            if s["left"] == float("inf"):
                s["left"] = 1e18

    def _pick(self, n: int) -> DataFrame:
        """sid, _h, doc_id of the documents of the last block that the mix draws once more: the longest first, if they fit."""
        last = self.sized.join(self.sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).filter((F.col("left") > 0) & (_prefix("depth") == F.col("cut")))
        last = last.groupBy("sid", "left", "_h", "doc_id").agg(F.sum("size").alias("size"))  # repeated rows share their fate, however many
        lists = last.groupBy("sid", "left").agg(F.sort_array(F.collect_list(F.struct("size", "_h", "doc_id")), asc=False).alias("docs"))  # about 32 documents

        def step(acc, x):
            fits = x["size"] <= acc["left"]
            return F.struct(F.when(fits, acc["left"] - x["size"]).otherwise(acc["left"]).alias("left"), F.when(fits, F.array_append(acc["ids"], F.struct(x["_h"].alias("_h"), x["doc_id"].alias("doc_id")))).otherwise(acc["ids"]).alias("ids"))

        start = F.struct(F.col("left").cast("double").alias("left"), F.expr("cast(array() as array<struct<_h: bigint, doc_id: bigint>>)").alias("ids"))
        took = lists.select("sid", F.explode(F.aggregate("docs", start, step)["ids"]).alias("x"))
        self._picks = n * 4 * _BLOCK_DOCS
        return took.select("sid", F.col("x._h").alias("_h"), F.col("x.doc_id").alias("_id"), F.lit(1).alias("_more")).distinct()

    def _deal(self, plan: DataFrame) -> DataFrame:
        """sid, block, shards: for each drawn block the shard of each of its copies, the partial last copy behind."""
        copies = F.explode(F.sequence(F.lit(1), F.col("whole") + 1)).alias("copy")
        draws = plan.select("sid", "bits", "whole", "extra", copies)
        until = F.when(F.col("copy") <= F.col("whole"), F.expr("shiftleft(1, bits)")).otherwise(F.col("extra"))
        draws = draws.withColumn("until", until).filter("until > 0").select("sid", "copy", F.explode(F.sequence(F.lit(0), F.col("until") - 1)).alias("block"))
        rank = F.row_number().over(Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(self.seed), "sid", "copy", "block"), "copy", "block")) - 1
        # a source's places, shard after shard, as many as it has drawn blocks
        places = plan.select("sid", F.posexplode(F.flatten(F.transform("quota", lambda n, shard: F.array_repeat(shard, n)))).alias("nth", "shard"))
        dealt = draws.withColumn("nth", rank).join(places, ["sid", "nth"])
        lists = dealt.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("c"))
        return lists.select("sid", F.col("block").cast("long").alias("_block"), F.col("c.shard").alias("_all"))

    def decide(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, source, _h and one more) with sid, source_size, target and _shards, one entry for each copy taken."""
        s = self.sources.withColumnRenamed("source", "_source")
        out = rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_block", _prefix("bits"))
        picked = self.picked.select(F.col("sid").alias("_psid"), F.col("_h").alias("_ph"), F.col("_id").alias("_pid"), "_more")
        out = out.join(_small(picked, self._picks), (F.col("sid") == F.col("_psid")) & (F.col("_h") == F.col("_ph")) & F.col("doc_id").eqNullSafe(F.col("_pid")), "left")
        blocks = self.blocks.withColumnRenamed("sid", "_bsid").withColumnRenamed("_block", "_bblock")
        out = out.join(_small(blocks, self._n_blocks), (F.col("sid") == F.col("_bsid")) & (F.col("_block") == F.col("_bblock")), "left")
        more = F.when((F.col("extra") > 0) & (_prefix("depth") < F.col("cut")), 1).otherwise(F.coalesce("_more", F.lit(0)))
        return out.withColumn("_shards", F.coalesce(F.slice("_all", F.lit(1), F.col("whole") + more), F.expr("cast(array() as array<int>)")))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards (of each copy) for every row of ``docs``.

    Sizes are words ``[^\\x20\\x09-\\x0D]+``; a null text has none. Sources weigh 3, 1, 2, repeating, by code point, the
    null source last. Documents are taken whole, at most twice. Empty texts take 0 words; an empty table gives no rows;
    rows that repeat id, source and text share their fate, null ids included. Other columns are ignored whatever their names. With the same
    seed reruns agree.
    """
    m = Mix(docs, **options)
    out = m.decide(m.sized)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("_shards")).cast("long").alias("taken"), F.col("_shards").alias("shards"))


def mix(docs: DataFrame, shards: int | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: all columns of ``docs``, a row for each copy taken, partitioned by shard and shuffled within.

    As many shards as the session has shuffle partitions, if not given. Edge cases are those of ``mix_report``; a row's
    columns travel as one struct, so their names are free.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = Mix(docs, shards=shards, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    order = _order(seed, id_col, source_col, text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), order.alias("_h"))
    out = m.decide(keyed).select("row", F.posexplode("_shards").alias("_copy", "_shard"), "_h")
    return out.repartition(shards, "_shard").sortWithinPartitions("_shard", F.xxhash64("_h", "_copy")).select("row.*")
