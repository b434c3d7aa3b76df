"""The nearest rows of the same cluster and of others, within the nearest of all: candidates of quota retrieval."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import pairs, vectors

BLOCK, _ASKED = 2048, 2048
_ROWS, _PAIRS = vectors._ROWS, vectors._PAIRS
_NAMES = ["block", "dim", "ids", "raw", "known", "clusters", "found"]
_PACKED = "block long, dim int, ids binary, raw binary, known binary, clusters binary, found binary"
_FOUND = [("score", "<f8"), ("j", "<i8"), ("is_match", "<i8")]


def _pack(rows: pa.Table) -> pa.Table:
    """One row for each vector length of a block: ids, vectors, clusters and, if rows have them, candidates in their order."""
    import numpy as np

    ids, v, c, out = rows.column("id").to_numpy(), rows.column("vec").combine_chunks(), rows.column("cluster").combine_chunks(), []
    found = rows.column("found").to_pylist() if "found" in rows.column_names else [[]] * len(ids)
    sizes, known, clusters = np.asarray(v.value_lengths()), np.asarray(c.is_valid()), np.asarray(c.fill_null(0))
    flat, ends, wide = v.flatten().to_numpy().astype(np.float64), np.cumsum(sizes), max(map(len, found))
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        wanted = np.full((len(at), wide), np.array((-np.inf, -1, 0), _FOUND))
        for n, x in enumerate(at.tolist()):
            wanted[n, : len(found[x])] = [(-y["neg"], y["j"], y["is_match"]) for y in found[x]]
        whole = (ids[at].astype("<i8"), flat[(ends[at] - d)[:, None] + np.arange(d)], known[at], clusters[at].astype("<i8"), wanted)
        out.append({"block": rows.column("block")[0].as_py(), "dim": d} | {name: x.tobytes() for name, x in zip(_NAMES[2:], whole, strict=True)})
    return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("dim", pa.int32()), *((name, pa.binary()) for name in _NAMES[2:])]))


class _Side:
    """A block of one vector length, read from its row."""

    def __init__(self, row: dict, prefix: str = ""):
        import numpy as np

        read = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.ids, self.known, self.clusters = read("ids", "<i8"), read("known", "?"), read("clusters", "<i8")
        found = read("found", _FOUND)
        self.v, self.found = read("raw", "<f8").reshape(len(self.ids), row[prefix + "dim"]), found.reshape(len(self.ids), len(found) // len(self.ids))
        self.length2 = vectors._length2(self.v)
        self.unit = (self.v / np.sqrt(np.where(self.length2 > 0, self.length2, 1))[:, None]).astype("f4")
        self.near = np.float32(vectors._NEAR + (self.v.shape[1] + 8) * 1.2e-7)  # with the error of the product in single precision

    def exact(self, other: _Side, r, col):
        import numpy as np

        part = lambda p: vectors.round6(vectors._cosine(self.v, other.v, self.length2, other.length2, r[p : p + _PAIRS], col[p : p + _PAIRS]))
        return np.concatenate([part(p) for p in range(0, len(r), _PAIRS)] or [np.zeros(0)])


class _Best(_Side):
    """Queries with their ``k`` best rows of each kind so far, and how many rows at most come before the last of them."""

    def __init__(self, row: dict, k: int):
        import numpy as np

        super().__init__(row, "_")
        self.k, self.seen = k, np.zeros(len(self.ids), "i8")
        self.score, self.j = np.full((2, len(self.ids), k), -np.inf), np.full((2, len(self.ids), k), -1)

    def meet(self, other: _Side) -> None:
        import numpy as np

        um, k = other.unit.T, min(self.k, len(other.ids))
        for s in range(0, len(self.ids), _ROWS):
            own = slice(s, s + _ROWS)
            near = self.unit[own] @ um
            near[self.ids[own, None] == other.ids] = -np.inf
            match = (self.clusters[own, None] == other.clusters) & self.known[own, None] & other.known
            edges = self.score[:, own, -1].astype("f4")
            if k == self.k and (edges == -np.inf).any():
                first = [-np.partition(np.where(of, -near, np.inf), k - 1, axis=1)[:, k - 1] for of in (~match, match)]
                edges = np.maximum(edges, first)
            r, col = np.nonzero((near >= np.where(match, edges[1, :, None], edges[0, :, None]) - self.near) & (near > -np.inf))
            exact, of = self.exact(other, r + s, col), match[r, col]
            for kind, mine in enumerate((~of, of)):
                self._keep(kind, r[mine] + s, other.ids[col[mine]], exact[mine])
            # what comes before the last of the end is not below the lesser edge of now
            self.seen[own] += np.count_nonzero(near >= self.score[:, own, -1].min(0).astype("f4")[:, None] - self.near, axis=1)

    def _keep(self, kind: int, r, j, score) -> None:
        import numpy as np

        rows, k = np.unique(r), self.k
        r = np.concatenate([r, np.repeat(rows, k)])
        j, score = np.concatenate([j, self.j[kind, rows].ravel()]), np.concatenate([score, self.score[kind, rows].ravel()])
        order = np.lexsort((j, -score, r))
        r, j, score = r[order], j[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        self.score[kind, r[keep], place[keep]], self.j[kind, r[keep], place[keep]] = score[keep], j[keep]

    def rows(self) -> pa.Table:
        import numpy as np

        kind, r, place = np.nonzero(self.score > -np.inf)
        cols = [self.ids[r], self.j[kind, r, place], self.score[kind, r, place], kind.astype("i4"), self.seen[r]]
        return pa.Table.from_arrays([pa.array(c) for c in cols], ["i", "j", "score", "is_match", "seen"])


class _Places(_Side):
    """Queries with candidates and how many rows come before each."""

    def __init__(self, row: dict, pool: int):
        import numpy as np

        super().__init__(row, "_")
        self.pool, self.before = pool, np.zeros(self.found.shape, "i8")

    def meet(self, other: _Side) -> None:
        import numpy as np

        um = other.unit.T
        for s in range(0, len(self.ids), _ROWS):
            own = slice(s, s + _ROWS)
            near = self.unit[own] @ um
            near[self.ids[own, None] == other.ids] = -np.inf
            for c in range(self.found.shape[1]):
                score, j = self.found["score"][own, c], self.found["j"][own, c]
                level = np.where(score > -np.inf, score, np.inf).astype("f4")[:, None]
                clear = near > level + self.near
                self.before[own, c] += clear.sum(1)
                r, col = np.nonzero((near >= level - self.near) & ~clear)
                exact = self.exact(other, r + s, col)
                ahead = (exact > score[r]) | ((exact == score[r]) & (other.ids[col] < j[r]))
                self.before[own, c] += np.bincount(r[ahead], minlength=len(score))

    def rows(self) -> pa.Table:
        import numpy as np

        r, c = np.nonzero((self.found["score"] > -np.inf) & (self.before < self.pool))
        own = self.found[r, c]
        cols = [self.ids[r], own["j"], own["score"], own["is_match"].astype("i4")]
        return pa.Table.from_arrays([pa.array(np.ascontiguousarray(x)) for x in cols], ["i", "j", "score", "is_match"])


def _stream(kind: type, n: int):
    """For a part of the queries and all blocks, one after the other."""

    def run(batches):
        asked = {}
        for batch in batches:
            for r in range(len(batch)):
                row = batch.slice(r, 1).to_pylist()[0]
                key = (row["_block"], row["_dim"])
                if key not in asked:
                    asked[key] = kind(row, n)
                if row["dim"] == row["_dim"]:
                    asked[key].meet(_Side(row))
        for x in asked.values():
            yield from x.rows().to_batches()

    return run


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    return materialise(rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy("block").applyInArrow(_pack, _PACKED))


def _search(corpus: DataFrame, asked: DataFrame, n: int, run, schema: str) -> DataFrame:
    """Each block of ``asked`` reads all blocks of ``corpus`` in one task, so nothing but its result is sent on."""
    blocks = max(1, -(-n // _ASKED), min(24, -(-n // 64)))
    mine = _packed(asked, blocks).select(*(F.col(c).alias(f"_{c}") for c in _NAMES)).repartition(blocks)
    return materialise(corpus.coalesce(1).crossJoin(mine.hint("shuffle_replicate_nl")).mapInArrow(run, schema))


def candidates(rows: DataFrame, k: int, pool: int, block: int = BLOCK) -> DataFrame:
    """i, j, score, is_match (a stored table): of the ``pool`` nearest rows of each the ``k`` best of its cluster and of others.

    ``rows``: id, vec, cluster (a whole number). Scores, ties and null vectors are those of ``vectors.dense_topk``, a null
    cluster matches nothing. The pool is not made: the best of each kind are kept while a task reads the blocks, with a
    bound of the rows before them. Only queries whose bound exceeds the pool are read again, to count those rows.
    """
    rows = rows.select(F.col("id").cast("long").alias("id"), "vec", F.col("cluster").cast("long").alias("cluster")).filter("id is not null and vec is not null")
    own = rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    if own["ids"] < own["n"]:  # repeated ids: each pair as often as joins give it
        return materialise(pairs.label_by_cluster(vectors.dense_topk(rows.select("id", "vec"), pool), rows).select("i", "j", "score", F.col("label").alias("is_match")))
    corpus = _packed(rows, max(1, -(-own["n"] // block)))
    best = _search(corpus, rows, own["n"], _stream(_Best, k), "i long, j long, score double, is_match int, seen long")
    sure = best.filter(F.col("seen") <= pool).drop("seen")
    if own["n"] <= pool + 1:
        return best.drop("seen")
    lists = best.filter(F.col("seen") > pool).groupBy(F.col("i").alias("id")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "j", "is_match"))).alias("found"))
    lists = materialise(lists)
    open_ = lists.count()
    if not open_:
        return sure
    counted = _search(corpus, rows.join(lists, "id"), open_, _stream(_Places, pool), "i long, j long, score double, is_match int")
    return sure.unionByName(counted)
