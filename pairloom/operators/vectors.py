"""Top-k by cosine over dense vectors: exact in blocks, approximate by cells."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import copies

BLOCK = 4096
_ROWS, _PAIRS = 256, 1 << 17
_NEAR = 1.1e-6  # scores of 6 places that agree are no further apart than 1e-6
_PACKED = "block long, dim int, ids binary, raw binary"


def _pack(rows: pa.Table) -> pa.Table:
    """One row for each vector length of a block: its ids and unit vectors."""
    import numpy as np

    ids, v, out = rows.column("id").to_numpy(), rows.column("vec").combine_chunks(), []
    sizes = np.asarray(v.value_lengths())
    flat, ends = v.flatten().to_numpy().astype(np.float64), np.cumsum(sizes)
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        m = flat[(ends[at] - d)[:, None] + np.arange(d)]
        out.append({"block": rows.column("block")[0].as_py(), "dim": d, "ids": ids[at].astype("<i8").tobytes(), "raw": m.tobytes()})
    return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("raw", pa.binary())]))


def _length2(m):
    """Squared lengths of the rows, added from the first place to the last."""
    import numpy as np

    out = np.zeros(len(m))
    for c in range(m.shape[1]):
        out += m[:, c] * m[:, c]
    return out


def _cosine(q, m, q2, m2, r, col):
    """Cosines of rows ``r`` of q with rows ``col`` of m, as a plain loop over the places gives them; 0 for a zero vector.

    A matrix product adds in another order, and a last bit decides what is rounded up.
    """
    import numpy as np

    out = np.zeros(len(r))
    for c in range(q.shape[1]):
        out += q[r, c] * m[col, c]
    both = np.sqrt(q2[r] * m2[col])
    return np.clip(np.divide(out, both, out=np.zeros(len(r)), where=both > 0), -1, 1)


def round6(x):
    """``x`` to 6 places, halves away from zero."""
    import numpy as np

    y = x * 1e6
    whole = np.trunc(y)
    return (whole + np.where(np.abs(y - whole) >= 0.5, np.copysign(1, y), 0)) / 1e6 + 0.0


def select_top(score, qids, ids, k: int):
    """(i, j, score) of the ``k`` best columns of each row of ``score``; -inf is no candidate, ties go to the smaller id."""
    import numpy as np

    n = min(k, len(ids))
    edge = -np.partition(-score, n - 1, axis=1)[:, n - 1]
    r, col = np.nonzero((score >= edge[:, None]) & (score > -np.inf))  # with all ties at the edge
    order = np.lexsort((ids[col], -score[r, col], r))
    r, col = r[order], col[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    r, col = r[keep], col[keep]
    return qids[r], ids[col], score[r, col]


def _best(q, qids, m, ids, k: int, exclude_self: bool):
    """(i, j, score) of the ``k`` best columns of each row by cosine; ties to the smaller id.

    The product of unit vectors selects all that may round to the score of the best, a plain sum gives their scores.
    """
    import numpy as np

    q2, m2 = _length2(q), _length2(m)
    unit = lambda x, x2: x / np.sqrt(np.where(x2 > 0, x2, 1))[:, None]
    uq, um, out = unit(q, q2), unit(m, m2).T, [[], [], []]
    n = min(k, len(ids))
    for s in range(0, len(qids), _ROWS):
        score = uq[s : s + _ROWS] @ um
        if exclude_self:
            score[qids[s : s + _ROWS, None] == ids] = -np.inf
        edge = -np.partition(-score, n - 1, axis=1)[:, n - 1]
        r, col = np.nonzero((score >= edge[:, None] - _NEAR) & (score > -np.inf))
        exact = np.concatenate([round6(_cosine(q, m, q2, m2, r[p : p + _PAIRS] + s, col[p : p + _PAIRS])) for p in range(0, len(r), _PAIRS)] or [np.zeros(0)])
        order = np.lexsort((ids[col], -exact, r))
        r, col, exact = r[order], col[order], exact[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        for x, y in zip(out, (qids[r[keep] + s], ids[col[keep]], exact[keep]), strict=True):
            x.append(y)
    return out


def table(parts) -> pa.Table:
    import numpy as np

    cols = [pa.array(np.concatenate(x) if x else np.zeros(0, t)) for x, t in zip(parts, ("i8", "i8", "f8"), strict=True)]
    return pa.Table.from_arrays(cols, ["i", "j", "score"])


def _tile(k: int, exclude_self: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        out = [[], [], []]
        for c in left.to_pylist():
            ids, m = np.frombuffer(c["ids"], "<i8"), np.frombuffer(c["raw"]).reshape(-1, c["dim"])
            for a in right.to_pylist():
                if a["dim"] != c["dim"]:
                    continue
                qids, q = np.frombuffer(a["ids"], "<i8"), np.frombuffer(a["raw"]).reshape(-1, c["dim"])
                for x, y in zip(out, _best(q, qids, m, ids, k, exclude_self), strict=True):
                    x += y
        return table(out)

    return run


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        def raw(t):
            v = t.column("vec").combine_chunks()
            return v.flatten().to_numpy().astype(np.float64).reshape(len(v), -1)

        if not left.num_rows or not right.num_rows:
            return table([[], [], []])
        return table(_best(raw(right), right.column("i").to_numpy(), raw(left), left.column("id").to_numpy(), k, True))

    return run


def _top(df: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.col("score").desc(), "j"))
    return df.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def dense_topk(corpus: DataFrame, k: int, anchors: DataFrame | None = None, exclude_self: bool = True, block: int = BLOCK) -> DataFrame:
    """i, j, score, rank: for each anchor its ``k`` most similar rows of ``corpus`` (id, vec), by cosine to 6 places.

    Anchors default to the corpus. Rows are dealt to blocks of about ``block`` by a hash of their id; blocks meet as
    matrix tiles, one group of bounded size each, and every tile sends k rows an anchor on. Where many vectors are equal
    they are compared once, and a row gets its neighbours from its class. Ties go to the smaller id;
    null vectors take no part; fewer rows give fewer neighbours.
    """
    pick = lambda df: df.select(F.col("id").cast("long").alias("id"), "vec").filter("id is not null and vec is not null")
    rows, asked = pick(corpus), pick(corpus if anchors is None else anchors)
    if anchors is None and exclude_self:
        own = rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct(F.xxhash64("vec")).alias("kinds")).first()
        if own["kinds"] < 0.8 * own["n"] and own["ids"] == own["n"]:
            of = copies.classes(rows, F.struct(*(F.xxhash64(F.lit(n), "vec") for n in (1, 2))))  # 128 bits, not the vectors, are exchanged
            reps = rows.join(of.filter("id = rep").select("id"), "id", "left_semi")
            return copies.neighbours(dense_topk(reps, k + 1, reps, exclude_self=False, block=block), of, k)
    n_left = max(1, -(-rows.count() // block))
    n_right = n_left if anchors is None else max(1, -(-asked.count() // block))
    pack = lambda df, n: df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n))).groupBy("block").applyInArrow(_pack, _PACKED)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("other")
    left, right = pack(rows, n_left).select("*", every(n_right)), pack(asked, n_right).select("*", every(n_left))
    found = left.groupBy("block", "other").cogroup(right.groupBy("other", "block")).applyInArrow(_tile(k, exclude_self), "i long, j long, score double")
    return _top(found, k)


def cell_topk(corpus: DataFrame, k: int, centroids: DataFrame, probes: int, anchors: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Approximate ``dense_topk``: rows lie in the cell of their nearest centroid and anchors probe ``probes`` cells.

    ``centroids`` (id, vec) are rows of the corpus or a trained quantiser's.
    """
    rows = corpus.select(F.col("id").cast("long").alias("id"), "vec")
    asking = rows if anchors is None else anchors.select(F.col("id").cast("long").alias("id"), "vec")
    cell = dense_topk(centroids, 1, rows, exclude_self=False).select(F.col("i").alias("id"), F.col("j").alias("cell"))
    asked = dense_topk(centroids, probes, asking, exclude_self=False).select("i", F.col("j").alias("cell"))
    # a cell's rows are dealt to parts of about `block` rows, and its queries to chunks of as many; a group is one of each
    sizes = cell.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    chunks = asked.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("long").alias("chunks"))
    plan = sizes.join(chunks, "cell")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = cell.join(rows, "id").join(plan, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), every("chunks").alias("chunk"), "id", "vec")
    right = asked.join(asking.withColumnRenamed("id", "i"), "i").join(plan, "cell").select(F.col("cell").alias("c"), every("parts").alias("p"), F.pmod(F.xxhash64("i"), F.col("chunks")).alias("h"), "i", "vec")
    found = left.groupBy("cell", "part", "chunk").cogroup(right.groupBy("c", "p", "h")).applyInArrow(_cell(k), "i long, j long, score double")
    return _top(found, k)


def probes_for(corpus: DataFrame, k: int, centroids: DataFrame, anchors: DataFrame, recall: float = 0.9, sample: int = 500, seed: int = 7) -> tuple[int, float]:
    """(the least probes with which ``cell_topk`` finds ``recall`` of the exact neighbours, the share it finds).

    Measured by brute force for at most ``sample`` of ``anchors``: a neighbour is found if its cell is among the
    anchor's nearest ``probes`` cells.
    """
    from .sampling import take

    asked, cells = take(anchors.filter("vec is not null"), sample, seed, ["id"]).persist(), centroids.count()
    near = dense_topk(corpus, k, asked).select("i", "j")
    order = dense_topk(centroids, cells, asked, exclude_self=False).select("i", F.col("j").alias("cell"), F.col("rank").alias("nth"))
    cell = dense_topk(centroids, 1, corpus, exclude_self=False).select(F.col("i").alias("_j"), F.col("j").alias("cell")).withColumnRenamed("_j", "j")
    hits = near.join(cell, "j").join(order, ["i", "cell"]).groupBy("nth").agg(F.count("*").alias("n")).orderBy("nth").collect()  # a row a cell
    asked.unpersist()
    total, found = sum(r["n"] for r in hits), 0
    for r in hits:
        found += r["n"]
        if found >= recall * total:
            return r["nth"], found / total
    return cells, 1.0


def kmeans_centroids(corpus: DataFrame, cells: int, sample: int, seed: int = 7) -> DataFrame:
    """id, vec of ``cells`` centroids trained on at most ``sample`` rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from .sampling import take

    rows = take(corpus, sample, seed, ["id"]).select(array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("features"))
    centers = KMeans(k=cells, seed=seed).fit(rows).clusterCenters()
    return corpus.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "id long, vec array<double>")
