"""Exact top-k by the number of shared keys over many sets: only rows that share a rare key meet."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import mark, materialise, remove, settled
from .vectors import table

PART = 32768
VOCABULARY = 200_000
_KINDS = 2048
_CELLS = 1 << 22
_NONE = (1 << 63) - 1


def _coder(terms: pa.Array, common: int):
    """id, size, rare, common: keys as their place by frequency; places from ``common`` on are kept apart as bytes."""

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            keys = batch.column("keys")
            flat, ends = keys.flatten(), np.cumsum(np.asarray(keys.value_lengths()))
            codes = pc.index_in(flat, value_set=terms).to_numpy(zero_copy_only=False).astype("<i4")
            row = np.repeat(np.arange(len(batch)), np.diff(ends, prepend=0))
            codes = codes[np.lexsort((codes, row))]
            few = codes < common
            cuts = np.r_[0, np.cumsum(few)][np.r_[0, ends]].astype("i4")
            often, at = codes[~few], np.r_[0, np.cumsum(~few)][np.r_[0, ends]]
            rest = pa.array([often[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
            cols = [batch.column("id"), pa.array(np.diff(ends, prepend=0).astype("i4")), pa.ListArray.from_arrays(pa.array(cuts), pa.array(codes[few])), rest]
            yield pa.RecordBatch.from_arrays(cols, ["id", "size", "rare", "common"])

    return run


def _meet(k: int, base, whole: bool):
    """The best of a group: rows that ask (``asks``) against rows that are asked (``asked``).

    ``base`` has the common keys that two kinds share. In a group of one rare key all rows share that one. A row that
    asks gets its ``k`` best, ties to the smaller id, and, but in a ``whole`` group, only rows that come before the row
    ``last`` of ``least`` shared keys and lack the key ``met``: it has met the others.
    """

    def run(group: pa.Table) -> pa.Table:
        import numpy as np

        out = [[], [], []]
        group = group.combine_chunks()
        read = lambda t, c: t.column(c).to_numpy()
        x, q = group.filter(group.column("asked")).sort_by("id"), group.filter(group.column("asks"))
        if not x.num_rows or not q.num_rows:
            return table(out)
        own = group.column("g")[0].as_py()

        def postings(t):
            lists = t.column("rare").combine_chunks()
            codes, n = lists.flatten().to_numpy(), np.asarray(lists.value_lengths())
            row = np.repeat(np.arange(t.num_rows), n)
            row, codes = row[codes != own], codes[codes != own]
            order = np.argsort(codes, kind="stable")
            kinds, starts = np.unique(codes[order], return_index=True)
            return row[order], kinds, np.r_[starts, len(codes)]

        kind = np.uint8 if base.max(initial=0) + pa.compute.max(pa.compute.list_value_length(x.column("rare"))).as_py() < 255 else np.int32
        ids, sig, small = read(x, "id"), read(x, "sig"), base.astype(kind)
        xr, xk, xs = postings(x)
        step = max(1, _CELLS // x.num_rows)
        for s in range(0, q.num_rows, step):
            part = q.slice(s, step)
            qids, least = read(part, "id"), read(part, "least")
            worst, last, met = least, read(part, "last"), read(part, "met")
            score = np.take(small[read(part, "sig")], sig, axis=1)
            if own >= 0:
                score += 1
            qr, qk, qs = postings(part)
            _, a, b = np.intersect1d(qk, xk, assume_unique=True, return_indices=True)
            for m, n in zip(a.tolist(), b.tolist(), strict=True):
                score[qr[qs[m] : qs[m + 1], None], xr[xs[n] : xs[n + 1]]] += 1
            for c in np.unique(met[met >= 0]).tolist():
                at = np.searchsorted(xk, c)
                if at < len(xk) and xk[at] == c:
                    score[np.flatnonzero(met == c)[:, None], xr[xs[at] : xs[at + 1]]] = 0
            n = min(k, len(ids))
            if whole:
                least = np.maximum(least, np.partition(score, len(ids) - n, axis=1)[:, len(ids) - n])
            least = np.maximum(least, 1)
            rows = max(1, (_CELLS >> 2) // len(ids))
            for p in range(0, len(qids), rows):
                r, col = np.nonzero(score[p : p + rows] >= least[p : p + rows, None])
                value = score[p + r, col]
                better = (value > worst[p + r]) | (ids[col] < last[p + r])
                r, col, value = r[better], col[better], value[better]
                order = np.lexsort((col, -value.astype("i4"), r))
                r, col, value = r[order], col[order], value[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                for c, v in zip(out, (qids[p + r[keep]], ids[col[keep]], value[keep].astype("f8")), strict=True):
                    c.append(v)
        return table(out)

    return run


def _groups(rows: DataFrame, asks: Column, parts: DataFrame) -> DataFrame:
    """``rows`` (with ``g``) dealt to the groups (g, a, b) of ``parts`` (g, n): part a of those that ask, b of those asked."""
    dealt = rows.withColumn("asks", asks).join(F.broadcast(parts), "g")
    mine, every = F.pmod(F.xxhash64("id"), F.col("n")), F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    to = lambda a, b, x, y: F.struct(a.alias("a"), b.alias("b"), F.lit(x).alias("asked"), F.lit(y).alias("asks"))
    asked, asking = F.transform(every, lambda a: to(a, mine, True, False)), F.transform(every, lambda b: to(mine, b, False, True))
    zero = F.lit(0).cast("long")
    both = F.when(F.col("n") == 1, F.array(F.struct(zero.alias("a"), zero.alias("b"), F.lit(True).alias("asked"), F.col("asks").alias("asks"))))
    places = both.otherwise(F.when(F.col("asks"), F.concat(asked, asking)).otherwise(asked))
    only = [F.when(F.col("_to.asks"), F.col(c)).otherwise(F.lit(0).cast(t)).alias(c) for c, t in (("least", "int"), ("last", "long"), ("met", "int"))]
    return dealt.withColumn("_to", F.explode(places)).select("g", "_to.*", "id", "sig", "rare", *only)


def topk(rows: DataFrame, k: int, part: int = PART, vocabulary: int = VOCABULARY) -> DataFrame | None:
    """i, j, score: at least the ``k`` best rows for each row of ``rows`` (id, keys: distinct), itself among them.

    Ties go to the smaller id; only pairs that share a key. Nothing is left out: a row first meets the rows that have its
    rarest key. If its kth best of these shares t of its s keys, a better row shares one of the s - t + 1 rarest, so the
    row meets the rows of those keys as well; where that would be no less than a quarter of all rows, it meets all. Only
    what comes before its kth best is sent on then. Keys of a twentieth of the rows or more are counted by kind of row. None
    if there are more than ``vocabulary`` keys, which the driver would hold.
    """
    since = mark()
    rows = materialise(rows.select(F.col("id").cast("long").alias("id"), F.col("keys").cast("array<string>").alias("keys")))
    spark, n = rows.sparkSession, rows.count()
    known = rows.select(F.explode("keys").alias("key")).groupBy("key").count().orderBy("count", "key").limit(vocabulary + 1).toArrow()
    if known.num_rows > vocabulary:
        return None
    terms, df = known.column("key").combine_chunks(), known.column("count").to_pylist()
    for share in (0.05, 0.2, 0.5, 2):  # of few enough kinds; above 1 no key is common and all rows are one kind
        common = sum(d < share * n for d in df)
        coded = materialise(rows.mapInArrow(_coder(terms, common), "id long, size int, rare array<int>, common binary"))
        kinds = [bytes(r["common"]) for r in coded.select("common").distinct().limit(_KINDS + 1).collect()]
        if len(kinds) <= _KINDS:
            break
    import numpy as np

    flags = np.zeros((len(kinds), max(1, len(df) - common)), "f4")
    for r, c in enumerate(kinds):
        flags[r, np.frombuffer(c, "<i4") - common] = 1
    base = (flags @ flags.T).astype("i4")
    remove(spark, since, keep=coded)
    named = spark.createDataFrame([(c, r) for r, c in enumerate(kinds)], "common binary, sig int")
    coded = coded.join(F.broadcast(named), "common").drop("common")

    def parts(of) -> DataFrame:
        return spark.createDataFrame([(g, -(-(df[g] if g >= 0 else n) // part)) for g in of], "g int, n long")

    def met(groups, whole):
        return groups.groupBy("g", "a", "b").applyInArrow(_meet(k, base, whole), "i long, j long, score double")

    first = [r["g"] for r in coded.filter("size(rare) > 0").select(F.col("rare")[0].alias("g")).distinct().collect() if df[r["g"]] < n // 4]
    each = coded.select(F.explode("rare").alias("g"), "id", "sig", "rare", F.lit(0).alias("least"), F.lit(_NONE).alias("last"), F.lit(-1).alias("met"))
    near = settled(spark, lambda: met(_groups(each, F.col("g") == F.col("rare")[0], parts(first)), True))
    best = F.get(F.sort_array(F.collect_list(F.struct((-F.col("score")).cast("int").alias("s"), "j"))), F.lit(k - 1))
    kth = near.groupBy(F.col("i").alias("id")).agg(best.alias("_k")).select("id", (-F.col("_k.s")).alias("_t"), F.col("_k.j").alias("_j"))
    asking = coded.join(kth, "id", "left").withColumn("least", F.coalesce("_t", F.lit(0))).withColumn("_p", F.col("size") - F.col("least") + 1)
    often = spark.createDataFrame([(df[:common],)], "df array<long>")
    cost = F.aggregate(F.slice("rare", 2, F.greatest(F.col("_p") - 1, F.lit(0))), F.lit(0).cast("long"), lambda z, c: z + F.get("df", c))
    asking = asking.crossJoin(F.broadcast(often)).withColumn("_all", (F.col("_p") > F.size("rare")) | (cost * 4 >= n))
    asking = asking.withColumn("met", F.when(F.get("df", F.get("rare", F.lit(0))) < n // 4, F.get("rare", F.lit(0))).otherwise(-1))
    ask = F.when(F.col("_all"), F.array(F.lit(-1))).otherwise(F.slice("rare", 2, F.greatest(F.col("_p") - 1, F.lit(0))))
    asking = settled(spark, lambda: asking.select("id", "sig", "rare", "least", F.coalesce("_j", F.lit(_NONE)).alias("last"), "met", ask.alias("ask")))
    used = [r["g"] for r in asking.select(F.explode("ask").alias("g")).distinct().collect()]
    rest = asking.select(F.explode(F.concat("rare", F.array(F.lit(-1)))).alias("g"), "id", "sig", "rare", "least", "last", "met", "ask")
    far = settled(spark, lambda: met(_groups(rest, F.array_contains("ask", F.col("g")), parts(used)), False))
    found = near.unionByName(far)
    remove(spark, since, keep=found)
    found = found.repartition("i").dropDuplicates(["i", "j"])
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.col("score").desc(), "j"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
