"""Exact top-k inner products over a bit-sliced index.

Method: quantised vectors are stored in blocks of rows, and in a block every attribute is a stack of bitmaps, one for
each binary digit of (value - smallest value). A query's score is the weighted sum of attributes: an attribute enters
once for every set digit of its weight, shifted by that digit (complemented for negative weights), and carry-save
adders over whole bitmaps reduce the stacks to one bitmap for each digit of the score. The k largest rows are then
selected from the most significant slice downward; rows that tie at the boundary are resolved by id. Every step is
exact integer arithmetic, in Python's integers where a score may need more than 62 digits.

Scale: the stated query set meets all rows in blocks. Blocks and query chunks are dealt to numbered parts by a hash, a
group is one pair of parts, and it sends k rows for each of its queries on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

_ROWS = 16_384
_CHUNK = 256
_CHUNKS = 32
_LIMIT = float(1 << 63)
_INDEX = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("digits", pa.int32()), ("ids", pa.binary()), ("bits", pa.binary())])
_QUERIES = pa.schema([("dim", pa.int32()), ("chunk", pa.int64()), ("qids", pa.binary()), ("q", pa.binary())])


def quantise(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, q (array of long): floor(scale * x) of the vectors that take part.

    Left out: null ids, null vectors and vectors that hold null or non-finite components. A component that does not fit
    a long after scaling stops the job.
    """
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    fine = F.forall("x", lambda v: F.coalesce((v > float("-inf")) & (v < float("inf")), F.lit(False)))  # NaN is larger than all
    scaled = lambda v: v * F.lit(float(scale))
    whole = lambda v: F.when((scaled(v) >= -_LIMIT) & (scaled(v) < _LIMIT), F.floor(scaled(v))).otherwise(F.raise_error(F.lit("a scaled component does not fit a long")).cast("long"))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).filter(fine).select("vec_id", F.transform("x", whole).alias("q"))


def _matrices(batch: pa.RecordBatch, rows: int):
    """(dimension, ids, matrix of longs) of consecutive rows of equal length."""
    import numpy as np

    ids, q = batch.column("vec_id").to_numpy(), batch.column("q")
    sizes = np.asarray(q.value_lengths())
    ends, flat = np.cumsum(sizes), q.flatten().to_numpy()
    for d in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == d)
        for k in range(0, len(own), rows):
            at = own[k : k + rows]
            yield d, ids[at], flat[(ends[at] - d)[:, None] + np.arange(d)] if d else np.zeros((len(at), 0), np.int64)


def slice_bits(matrix, base: int, digits: int):
    """uint64 bitmaps [attribute, digit, word] of ``matrix`` (rows by attributes) minus ``base``."""
    import numpy as np

    rows, dim = matrix.shape
    words = -(-rows // 64)
    padded = np.zeros((dim, words * 64), np.uint64)
    padded[:, :rows] = (matrix - base).T.astype(np.uint64)
    out = np.empty((dim, digits, words), np.uint64)
    for s in range(digits):
        out[:, s] = np.packbits((padded >> np.uint64(s) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
    return out


def add_slices(columns: list) -> list:
    """Carry-save addition: ``columns[w]`` stacks bitmaps of weight 2**w; returns one bitmap for each digit of the sum."""
    import numpy as np

    out, w = [], 0
    while w < len(columns):
        stack = columns[w]
        while len(stack) > 1:
            n = len(stack) // 3
            if n:
                a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
                half = a ^ b
                total, carry, rest = half ^ c, (a & b) | (half & c), stack[3 * n :]
            else:
                total, carry, rest = stack[:1] ^ stack[1:2], stack[:1] & stack[1:2], stack[2:]
            stack = np.concatenate([total, rest]) if len(rest) else total
            if w + 1 == len(columns):
                columns.append(carry)
            else:
                columns[w + 1] = np.concatenate([columns[w + 1], carry]) if len(columns[w + 1]) else carry
        out.append(stack[0] if len(stack) else None)
        w += 1
    return out


def score_slices(index, weights):
    """Digits of the sum over attributes of |weight| * (value - base), complemented for negative weights."""
    import numpy as np

    dim, digits, words = index.shape
    size, columns = np.abs(weights).astype(np.uint64), []
    for b in range(int(size.max()).bit_length() if dim else 0):
        on = size >> np.uint64(b) & np.uint64(1) == 1
        up, down = index[on & (weights > 0)], index[on & (weights < 0)]
        for s in range(digits):
            while len(columns) <= b + s:
                columns.append([])
            columns[b + s] += [up[:, s], ~down[:, s]]
    return add_slices([np.concatenate(c) if c else np.zeros((0, words), np.uint64) for c in columns])


def top_rows(slices, valid, k: int, ids):
    """Row numbers of the ``k`` largest sums among the ``valid`` rows, from the most significant slice downward."""
    import numpy as np

    sure, tied = np.zeros_like(valid), valid
    count = lambda x: int(np.bitwise_count(x).sum())
    if count(valid) > k:
        for s in reversed(slices):
            if s is None:
                continue
            more = sure | (tied & s)
            n = count(more)
            if n > k:
                tied = tied & s
            else:
                sure, tied = more, tied & ~s
                if n == k:
                    tied = np.zeros_like(tied)
                    break
    rows = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    first, rest = rows(sure), rows(tied)
    return np.r_[first, rest[np.argsort(ids[rest], kind="stable")][: k - len(first)]]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for dim, ids, matrix in _matrices(batch, _ROWS):
            base, top = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
            digits = max(1, (top - base).bit_length())
            bits = slice_bits(matrix, base, digits)
            row = {"dim": dim, "block": block, "base": base, "digits": digits, "ids": ids.astype("<i8").tobytes(), "bits": np.ascontiguousarray(bits).tobytes()}
            yield pa.RecordBatch.from_pylist([row], _INDEX)
            block += 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for dim, ids, matrix in _matrices(batch, _CHUNK):
            yield pa.RecordBatch.from_pylist([{"dim": dim, "chunk": chunk, "qids": ids.astype("<i8").tobytes(), "q": matrix.astype("<i8").tobytes()}], _QUERIES)
            chunk += 1


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        out = [[], [], []]
        for block in left.to_pylist():
            ids = np.frombuffer(block["ids"], "<i8")
            words = -(-len(ids) // 64)
            bits = np.frombuffer(block["bits"], "<u8").reshape(block["dim"], block["digits"], words)
            every = np.zeros(words * 64, np.uint8)
            every[: len(ids)] = 1
            every = np.packbits(every, bitorder="little").view(np.uint64)
            order = np.argsort(ids, kind="stable")
            for chunk in right.to_pylist():
                if chunk["dim"] != block["dim"]:
                    continue
                qids = np.frombuffer(chunk["qids"], "<i8")
                weights = np.frombuffer(chunk["q"], "<i8").reshape(len(qids), -1)
                for qid, w in zip(qids.tolist(), weights, strict=True):
                    slices = score_slices(bits, w)
                    valid = every
                    lo, hi = np.searchsorted(ids, [qid, qid + 1], sorter=order)
                    if lo < hi:
                        valid = every.copy()
                        for r in order[lo:hi].tolist():
                            valid[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
                    rows = top_rows(slices, valid, k, ids)
                    mask = (1 << block["digits"]) - 1
                    more = sum(w[w > 0].tolist()) * block["base"] + sum(w[w < 0].tolist()) * (mask + block["base"])
                    kind = np.int64 if len(slices) < 63 and abs(more) < 1 << 62 else object
                    score = np.zeros(len(rows), kind)
                    for s, bitmap in enumerate(slices):
                        if bitmap is not None:
                            score += (bitmap[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64).astype(kind) << s
                    score += more
                    if kind is object:
                        if any(not -(1 << 63) <= x < 1 << 63 for x in score.tolist()):
                            raise OverflowError("a score does not fit a long")
                        score = score.astype(np.int64)
                    out[0].append(np.full(len(rows), qid))
                    out[1].append(ids[rows])
                    out[2].append(score)
        cols = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(cols, ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its ``k`` largest inner products among ``vectors``.

    Both sides are quantised with ``quantise``; vectors meet queries of their own length; a row is no candidate of a
    query with its id. Ties go to the smaller id, fewer rows come back where there are fewer, queries that repeat an id
    count once (repeated candidates each). Empty tables give no rows; other columns are ignored whatever their names.
    """
    index = materialise(quantise(vectors, scale, id_col, vec_col).mapInArrow(_index, "dim int, block long, base long, digits int, ids binary, bits binary"))
    asked = quantise(queries, scale, id_col, vec_col).dropDuplicates(["vec_id"])
    chunks = materialise(asked.mapInArrow(_chunks, "dim int, chunk long, qids binary, q binary"))
    n_left, n_right = max(1, index.count()), max(1, -(-chunks.count() // _CHUNKS))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).alias("own")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("other")
    left, right = index.select("*", part("block", n_left), every(n_right)), chunks.select("*", part("chunk", n_right), every(n_left))
    found = left.groupBy("own", "other").cogroup(right.groupBy("other", "own")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
