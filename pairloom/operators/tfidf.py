"""TF-IDF weights in long form and cosine top-k over tiles of postings."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..sources.scratch import materialise

BLOCK, LARGE = 2048, 4096  # the latter from 24 blocks on
_AT_ONCE, _TASKS, _FEW_DOCS = 1 << 15, 48, 8192
_NEAR = 1.1e-6  # scores of 6 places that agree are no further apart than 1e-6
_PACKED = "block long, ids binary, terms array<string>, starts binary, docs binary, weights binary"
_NAMES = ["ids", "terms", "starts", "docs", "weights"]


def spread(df: DataFrame, files: int = 8) -> DataFrame:
    """``df`` dealt over the shuffle partitions if it comes from few files, whose one row group each would be one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if len(df.inputFiles()) < files else df


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, term, tf of words of two characters or more."""
    words = spread(docs.select(id_col, text_col)).select(F.col(id_col).cast("long").alias("id"), F.explode(word_tokens(F.col(text_col), 2, distinct=False)).alias("term"))
    return words.groupBy("id", "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, n_docs: int, min_df: int = 2, max_df: float = 0.95, max_features: int | None = None) -> DataFrame:
    """term, idf of the terms kept: document frequency in bounds, then the ``max_features`` most frequent."""
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    terms = terms.filter("total >= df")  # always so; it keeps tf in the plan, whose exchange then serves the weights as well
    if max_features:
        terms = terms.orderBy(F.col("total").desc(), "term").limit(max_features)
    return terms.select("term", (F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def weights(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """id, term, weight: sublinear tf times idf, rows of length one."""
    raw = counts.join(vocab, "term").select("id", "term", ((F.log(F.col("tf").cast("double")) + 1.0) * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.select("id", "term", (F.col("w") / length).alias("weight"))


def _pack(rows: pa.Table) -> pa.Table:
    """One row: a block's postings, by term."""
    import numpy as np

    ids, local = np.unique(rows.column("id").to_numpy(), return_inverse=True)
    coded = rows.column("term").combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    starts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    whole = lambda x, t: pa.array([x.astype(t).tobytes()], pa.binary())
    terms = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string()))
    cols = [rows.column("block").combine_chunks()[:1], whole(ids, "<i8"), terms, whole(starts, "<i8"), whole(local[order], "<i4"), whole(rows.column("weight").to_numpy()[order], "<f8")]
    return pa.Table.from_arrays(cols, ["block", "ids", "terms", "starts", "docs", "weights"])


def _dense(rows: int, terms, starts, docs, weights):
    """The postings of ``terms`` as a matrix, a column a term."""
    import numpy as np

    sizes = starts[terms + 1] - starts[terms]
    at = _spans(starts[terms], sizes)
    out = np.zeros((rows, len(terms)))
    out[docs[at], np.repeat(np.arange(len(terms)), sizes)] = weights[at]
    return out


def _spans(starts, sizes):
    """The numbers from each start on, as many as its size."""
    import numpy as np

    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Block:
    """A packed block, read from its row."""

    def __init__(self, row: pa.RecordBatch, prefix: str = ""):
        import numpy as np

        read = lambda c, kind: np.frombuffer(row.column(prefix + c)[0].as_buffer(), kind)
        self.ids, self.starts, self.docs, self.weights = read("ids", "<i8"), read("starts", "<i8"), read("docs", "<i4"), read("weights", "<f8")
        self.terms = row.column(prefix + "terms")[0].values

    def scores(self, other: _Block):
        """The sums of the products of common terms, a row a document and a column one of ``other``."""
        import numpy as np
        import pyarrow.compute as pc

        out = np.zeros((len(self.ids), len(other.ids)))
        at = pc.fill_null(pc.index_in(other.terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False)
        both = np.flatnonzero(at >= 0)
        mine = at[both]
        own, met = self.starts[mine + 1] - self.starts[mine], other.starts[both + 1] - other.starts[both]
        work = own * met
        common = 512 * work > len(self.ids) * len(other.ids)
        for s in range(0, int(common.sum()), 512):  # a column of a matrix product each
            m, r = mine[common][s : s + 512], both[common][s : s + 512]
            x, y = _dense(len(self.ids), m, self.starts, self.docs, self.weights), _dense(len(other.ids), r, other.starts, other.docs, other.weights).T
            for p in range(0, len(x), 1024):
                out[p : p + 1024] += x[p : p + 1024] @ y
        # the postings of the others, each with those of the other side
        m, r, own, met = mine[~common], both[~common], own[~common], met[~common]
        a, sizes, first = _spans(self.starts[m], own), np.repeat(met, own), np.repeat(other.starts[r], own)
        row, weight, ends, flat, lo = self.docs[a].astype("i8") * len(other.ids), self.weights[a], np.cumsum(sizes), out.reshape(-1), 0
        while lo < len(a):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE)))
            b, n = _spans(first[lo:hi], sizes[lo:hi]), sizes[lo:hi]
            np.add.at(flat, np.repeat(row[lo:hi], n) + other.docs[b], np.repeat(weight[lo:hi], n) * other.weights[b])
            lo = hi
        return out


class _Best:
    """The ``k`` best rows so far of the documents of a block."""

    def __init__(self, block: _Block, k: int, exclude_self: bool):
        import numpy as np

        self.block, self.k, self.exclude_self = block, k, exclude_self
        self.score, self.j = np.full((len(block.ids), k), -np.inf), np.full((len(block.ids), k), -1)

    def meet(self, other: _Block, scores) -> None:
        import numpy as np

        k, nth = self.k, self.k + self.exclude_self - 1
        for s in range(0, len(scores), 512):
            part, edge = np.ascontiguousarray(scores[s : s + 512]), self.score[s : s + 512, -1]
            if nth < len(other.ids) and (edge == -np.inf).any():
                some = part[:, : max(1024, nth + 1)]  # the nth best of some is a bound
                edge = np.maximum(edge, -np.partition(-some, nth, axis=1)[:, nth])
            r, col = np.nonzero((part >= edge[:, None] - _NEAR) & (part > 0))  # weights are positive: 0 is no shared term
            if self.exclude_self:
                keep = self.block.ids[r + s] != other.ids[col]
                r, col = r[keep], col[keep]
            found = np.round(part[r, col], 6)
            rows = np.unique(r)
            r = np.concatenate([r, np.repeat(rows, k)])
            found, j = np.concatenate([found, self.score[rows + s].ravel()]), np.concatenate([other.ids[col], self.j[rows + s].ravel()])
            order = np.lexsort((j, -found, r))
            r, found, j = r[order], found[order], j[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            keep = place < k
            self.score[r[keep] + s, place[keep]], self.j[r[keep] + s, place[keep]] = found[keep], j[keep]

    def rows(self) -> pa.Table:
        import numpy as np

        r, place = np.nonzero(self.score > -np.inf)
        return pa.Table.from_arrays([pa.array(x) for x in (self.block.ids[r], self.j[r, place], self.score[r, place])], ["i", "j", "score"])


def _stream(k: int, exclude_self: bool, same: bool):
    """Blocks that ask meet the other blocks one after the other; a row has a block's postings only where it comes first.

    If the sides are the ``same``, two blocks meet once, here or where the other asks, and both get their best of it.
    """

    def run(batches):
        asked, other, back = {}, None, None
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1)
                if row.column("ids")[0].is_valid:
                    if back:
                        yield from back.rows().to_batches()
                    other, back = _Block(row), None
                    pa.default_memory_pool().release_unused()
                own, met = row.column("_block")[0].as_py(), row.column("block")[0].as_py()
                if own not in asked:
                    asked[own] = _Best(_Block(row, "_"), k, exclude_self)
                if same and own != met and (own < met) == bool((own + met) % 2):
                    continue
                scores = asked[own].block.scores(other)
                asked[own].meet(other, scores)
                if same and own != met:
                    back = back or _Best(other, k, exclude_self)
                    back.meet(asked[own].block, scores.T)
                del scores
        for best in [*asked.values(), *([back] if back else [])]:
            yield from best.rows().to_batches()

    return run


def topk(left: DataFrame, right: DataFrame, k: int, exclude_self: bool = False, sizes: tuple[int, int] | None = None, block: int | None = None) -> DataFrame:
    """i, j, score, rank: for each row of ``left`` its ``k`` nearest rows of ``right``; only pairs that share a term.

    Rows are dealt by a hash to blocks of about ``block`` and a block's postings are packed by term and stored. A task
    has some blocks of ``left`` and reads the blocks of ``right`` one after the other, where a term adds the products of
    its two postings; only the k best of a document are kept and sent on, so a frequent term costs neither shuffle nor
    skew. Few blocks of ``left`` read ``right`` in several tasks. ``sizes`` are the documents of both sides, counted here
    if not given. Scores have 6 places; ties go to the smaller id.
    """
    n = sizes or tuple(d.select("id").distinct().count() for d in (left, right))
    block = block or (LARGE if min(n) >= 24 * LARGE else BLOCK)
    parts = [max(1, -(-x // block)) for x in n]
    dealt = lambda d, p: d.select(F.pmod(F.xxhash64("id"), F.lit(p)).alias("block"), F.col("id").cast("long").alias("id"), "term", "weight").repartition(p, "block")
    pack = lambda d, p: materialise(dealt(d, p).groupBy("block").applyInArrow(_pack, _PACKED))
    same = right is left and parts[0] == parts[1]
    a = pack(left, parts[0])
    b = a if same else pack(right, parts[1])
    nth = lambda name: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(name)
    first = lambda once, names: (F.when(F.col(once) == 0, F.col(c)).alias(c) for c in names)
    asks = a.select(*(F.col(c).alias(f"_{c}") for c in ["block", *_NAMES]), nth("_nth"))
    met = b.coalesce(max(1, -(-_TASKS // parts[0]))).select("block", *_NAMES, nth("nth"))
    both = met.crossJoin(asks.hint("shuffle_replicate_nl")).select("block", "_block", *first("_nth", _NAMES), *first("nth", [f"_{c}" for c in _NAMES]))
    found = both.mapInArrow(_stream(k, exclude_self, same), "i long, j long, score double")
    if max(n) > _FEW_DOCS:  # else all blocks fit a batch or two
        conf, size = left.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
        usual = conf.get(size)
        conf.set(size, "1m")  # a row is a block; several at once would take an executor's memory beside its heap
        try:
            found = materialise(found)
        finally:
            conf.set(size, usual)
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.col("score").desc(), "j"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
