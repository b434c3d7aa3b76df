"""SimHash near-duplicate classes by pigeonhole blocks.

Method: a 64-bit fingerprint is cut into r + b blocks for a radius r; two fingerprints within the radius agree on at
least b of them, so every choice of b blocks is a join key. b grows with the number of distinct fingerprints, so that
the keys stay selective. Fingerprints meet by key, their Hamming distance is verified, and what is within the radius
is linked. A bucket emits a star for each of its local components and no pairs; the links become components by label
propagation. Identical fingerprints are one vertex from the start.

Scale: a bucket of more than ``_TILE`` fingerprints is cut into tiles, and each pair of tiles is one group of bounded
size, so neither memory nor time of a task grows with the largest bucket, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import located, materialise, slices
from .components import connected_components
from .shingle_links import similar_classes

_TILE = 8192


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit i is set if it is set in over half of the XXH64 values (seed 42) of the word shingles, repeats included."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, 42)
    starts = np.cumsum(np.r_[0, np.fromiter(map(len, words), np.int64, len(words)) + 1])
    a, b = starts[: len(words) - shingle + 1].tolist(), (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[i:j], 42) for i, j in zip(a, b, strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (64 bits as a long); null and empty texts have fingerprint 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def block_choice(n: int, radius: int) -> tuple[int, int]:
    """(blocks, blocks in a key): the choice with the least keys plus expected candidates for ``n`` even fingerprints."""
    from math import comb

    def cost(b: int) -> float:
        tables, bits = comb(radius + b, b), 64 * b // (radius + b)
        return tables * n * (8 + n / 2.0**bits)

    b = min(range(1, 6), key=cost)
    return radius + b, b


def block_keys(fp, blocks: int, width: int) -> list:
    """(table, key bits) columns of a fingerprint: one for each choice of ``width`` of the ``blocks``."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for t, chosen in enumerate(combinations(range(blocks), width)):
        mask = 0
        for c in chosen:
            mask |= (1 << ends[c + 1]) - (1 << ends[c])
        mask = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(mask).cast("long")).alias("key")))
    return out


def _bits(x):
    """Set bits of each uint64."""
    import numpy as np

    return np.bitwise_count(x)


def _stars(fps, ids, tiles, radius: int):
    """(member, root) ids of the components of one bucket; with two tiles only pairs across them count."""
    import numpy as np

    n = len(fps)
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = np.argsort(tiles, kind="stable")
    fps, ids, tiles = fps[order], ids[order], tiles[order]
    cut = int((tiles == tiles[0]).sum()) if len(tiles) else 0
    left = range(n) if cut == n else range(cut)
    for i in left:
        lo = i + 1 if cut == n else cut
        near = np.flatnonzero(_bits(fps[lo:] ^ fps[i]) <= radius) + lo
        if len(near):
            a = find(i)
            for j in near[root[near] != a].tolist():
                b = find(j)
                if a != b:
                    a, b = (a, b) if ids[a] < ids[b] else (b, a)
                    root[b] = a
            root[near] = a
    top = np.array([find(i) for i in range(n)], np.int64)
    own = top != np.arange(n)
    return ids[own], ids[top[own]]


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held = None
        names = ["t", "key", "g", "h", "v", "fp", "tile"]

        def work(rows):
            change = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            starts = np.r_[0, change, len(rows)]
            sizes = np.diff(starts)
            out_a, out_b = [], []
            two = starts[:-1][sizes == 2]  # most buckets: one comparison, all at once
            if len(two):
                x, y = rows[two], rows[two + 1]
                ok = (_bits(x[:, 5].view(np.uint64) ^ y[:, 5].view(np.uint64)) <= radius) & ((x[:, 2] == x[:, 3]) | (x[:, 6] != y[:, 6]))
                out_a.append(np.maximum(x[ok, 4], y[ok, 4]))
                out_b.append(np.minimum(x[ok, 4], y[ok, 4]))
            for k in np.flatnonzero(sizes > 2).tolist():
                r = rows[starts[k] : starts[k + 1]]
                a, b = _stars(np.ascontiguousarray(r[:, 5]).view(np.uint64), r[:, 4], r[:, 6], radius)
                out_a.append(a)
                out_b.append(b)
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in names], 1)
            rows = rows if held is None else np.concatenate([held, rows])
            if not len(rows):
                continue
            same = (rows[:, :4] == rows[-1, :4]).all(1)
            at = len(rows) - int(same[::-1].argmin() if not same.all() else len(rows))
            held = rows[at:]
            if at:
                yield work(rows[:at])
        if held is not None and len(held):
            yield work(held)

    return run


def links(vertices: DataFrame, radius: int = 3, tile: int = _TILE, blocks: tuple[int, int] | None = None) -> DataFrame:
    """a, b: links within ``radius`` that give the components of ``vertices`` (v long, fp long; both distinct)."""
    n = vertices.count()
    keys = block_keys(F.col("fp"), *(blocks or block_choice(n, radius)))
    rows = vertices.select("v", "fp", F.explode(F.array(*keys)).alias("k")).select("v", "fp", F.col("k.t").cast("long").alias("t"), F.col("k.key").alias("key"))
    large = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    met = rows.join(large, ["t", "key"]).withColumn("m", F.ceil(F.col("n") / tile).cast("long")).withColumn("tile", F.pmod(F.xxhash64("v"), F.col("m")))
    other = F.explode(F.when(F.col("m") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))).alias("o")
    dealt = met.select("t", "key", "v", "fp", "tile", other).select("t", "key", F.least("tile", "o").alias("g"), F.greatest("tile", "o").alias("h"), "v", "fp", "tile")
    return dealt.repartition("t", "key", "g", "h").sortWithinPartitions("t", "key", "g", "h", "v").mapInArrow(_link(radius), "a long, b long").distinct()


def near_dedup(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a text with fewer words than a shingle is
    one shingle, one without words has fingerprint zero and is linked like any other. Fingerprints link at ``radius``
    or fewer differing bits; component_id is the smallest id reachable. Repeated rows share a component; a row whose id
    is null has its class's component, which is null if no row of it has an id; other columns are ignored whatever their names; an empty table gives no rows.
    """
    rows = materialise(fingerprints(docs, shingle, id_col, text_col))
    top = rows.agg(F.coalesce(F.max("doc_id"), F.lit(-1)).alias("top")).first()["top"]
    # a fingerprint that only rows without id have is a vertex behind all ids: links lead through it
    spare = F.lit(top) + 1 + F.monotonically_increasing_id()
    vertices = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("v")).withColumn("v", F.coalesce("v", spare)))
    labels = connected_components(links(vertices, radius))
    label = F.coalesce("label", "v")
    classes = vertices.join(labels, "v", "left").select("fp", F.when(label <= top, label).alias("component_id"))
    out = rows.join(classes, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, radius: int = 3, shingle: int = 3, similarity: float = 0.8, similarity_shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, one of each near-duplicate class: that with the smallest id.

    Two texts link if their fingerprints differ in ``radius`` or fewer bits, or if their sets of ``similarity_shingle``
    words have a Jaccard similarity of ``similarity`` or more (see ``shingle_links``). Rows that repeat an id or have
    none are judged each by its own text; null ids come behind all others, and one row stays of those that share the
    smallest id. Null texts are empty and link with each other; column names are free; an empty table gives no rows.
    """
    docs, row = located(docs, id_col)
    rows = docs.select(F.col(row or id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = materialise(fingerprints(rows, shingle))
    vertices = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("v")))
    copies = marked.join(vertices, "fp").filter("doc_id <> v").select(F.col("doc_id").alias("a"), F.col("v").alias("b"))
    classes = similar_classes(rows, copies.union(links(vertices, radius)), similarity_shingle, similarity)
    if row:
        ids = docs.select(F.col(row).alias("v"), F.col(id_col).cast("long").alias("id"))
        first = classes.join(ids, "v").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "v")).alias("first")).select("label", F.col("first.v").alias("stays"))
        gone = classes.join(first, "label").filter("v <> stays").select(F.col("v").alias(row))
        return docs.join(gone, row, "left_anti").drop(row)
    gone = classes.filter("v <> label").select(F.col("v").alias("_gone_id"))
    return docs.join(gone, F.col(id_col).cast("long") == F.col("_gone_id"), "left_anti")
