"""Links between texts whose word shingles agree to a given similarity; completes the SimHash classes of ``simhash``.

A 64-bit SimHash can't hold a radius wide enough for a Jaccard similarity of 0.8 (about ten of its bits differ, and
blocks narrow enough for that radius select nothing). So candidates share one of ``BANDS`` blocks of ``WIDTH`` min-wise
hashes, which a pair of similarity 0.8 misses with a chance of 5 in a million, and shingle sets decide.

Scale: every member of a bucket is compared with the bucket's smallest id first, one row a member, which joins a large
group of near copies in linear work; those who ask for one id are dealt to shares. Only buckets that still hold several
classes are searched further: members of the largest class meet the others, never each other, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices
from .components import connected_components

BANDS, WIDTH = 40, 6
_CHUNK = 512
_TILE = 512
_SHARE = 4096


def shingle_hashes(text: str, shingle: int):
    """Distinct XXH64 values of the word shingles; fewer words are one shingle, no words the empty one."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    flat = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(flat)], np.uint64)
    starts = np.cumsum(np.r_[0, np.fromiter(map(len, words), np.int64, len(words)) + 1])
    a, b = starts[: len(words) - shingle + 1].tolist(), (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(flat[i:j]) for i, j in zip(a, b, strict=True)], np.uint64))


def _constants():
    import numpy as np

    rng = np.random.default_rng(20)
    draw = lambda n, kind: rng.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True)
    return draw(BANDS * WIDTH, np.uint32)[:, None], draw(BANDS * WIDTH, np.uint32)[:, None] | np.uint32(1), draw(WIDTH, np.uint64) | np.uint64(1)


def _bands(shingle: int):
    """doc_id, text to v, bands (one key a band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        flip, odd, fold = _constants()
        for batch in batches:
            for part in slices(batch, "text"):
                bands = []
                for text in part.column("text").to_pylist():
                    high = (shingle_hashes(text, shingle) >> np.uint64(32)).astype(np.uint32)  # products of 32 bits are vectorised
                    low = np.full(BANDS * WIDTH, np.iinfo(np.uint32).max, np.uint32)
                    for k in range(0, len(high), _CHUNK):
                        low = np.minimum(low, ((high[k : k + _CHUNK] ^ flip) * odd).min(1))
                    bands.append((low.astype(np.uint64).reshape(BANDS, WIDTH) * fold).sum(1, dtype=np.uint64).view(np.int64))
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(bands)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), keys], ["v", "bands"])

    return run


def _sets(shingle: int):
    """doc_id, text to v, grams (the distinct shingle hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "text"):
                grams = [shingle_hashes(text, shingle).view(np.int64) for text in part.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, grams)]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(grams)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], ["v", "grams"])

    return run


def _across(similarity: float):
    """One bucket or pair of tiles to the links that join its classes; pairs inside a class are not looked at."""

    def run(table: pa.Table) -> pa.Table:
        import numpy as np

        table = table.sort_by("v").combine_chunks()
        v, root, tile = (table.column(c).to_numpy().copy() for c in ("v", "root", "tile"))
        one = bool((table.column("g").to_numpy() == table.column("h").to_numpy()).all())
        grams = table.column("grams").combine_chunks()
        size = np.asarray(grams.value_lengths()).astype(np.int64)
        flat, ends = grams.flatten().to_numpy(), np.r_[0, np.cumsum(size)]
        row = np.repeat(np.arange(len(v)), size)
        out_a, out_b = [], []
        for i in range(len(v)):
            can = (root != root[i]) & (np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i]) - 1e-9)
            can[: i + 1] = False
            if not one:
                can &= tile != tile[i]
            if not can.any():
                continue
            own = np.sort(flat[ends[i] : ends[i + 1]])
            pick = can[row]
            asked, of = flat[pick], row[pick]
            at = np.minimum(np.searchsorted(own, asked), len(own) - 1)
            both = np.bincount(of, own[at] == asked, len(v))
            for j in np.flatnonzero(can & (both >= similarity * (size + size[i] - both) - 1e-9)).tolist():
                if root[j] != root[i]:
                    out_a.append(v[j])
                    out_b.append(v[i])
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def similar_classes(rows: DataFrame, known: DataFrame, shingle: int = 5, similarity: float = 0.8, tile: int = _TILE, share: int = _SHARE) -> DataFrame:
    """v, label: the classes of ``rows`` (doc_id long, text string) by shared shingles and the links ``known`` (a, b).

    Two texts link if the Jaccard similarity of their sets of word shingles is at least ``similarity``; words as in
    ``simhash``. label is the smallest id of the class; ids without a link are not listed. Rows whose id is null take no
    part, null texts are empty, and empty texts link with each other. An empty table gives no rows.
    """
    rows = rows.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = materialise(rows.mapInArrow(_bands(shingle), "v long, bands array<long>")).select("v", F.posexplode("bands").alias("t", "key"))
    shared = keys.groupBy("t", "key").agg(F.min("v").alias("c"), F.count("*").alias("n")).filter("n > 1")
    met = materialise(keys.join(shared, ["t", "key"]))
    # only texts that share a block get their sets
    asked = rows.join(met.select(F.col("v").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = materialise(asked.mapInArrow(_sets(shingle), "v long, grams array<long>"))
    # one smallest id may be asked for by a third of all rows: its set goes once to each share of the askers
    shares = F.ceil(F.col("n") / share).cast("long")
    pairs = met.filter("v <> c").groupBy("v", "c").agg(F.max("n").alias("n")).select("v", "c", shares.alias("s")).withColumn("share", F.pmod(F.xxhash64("v"), F.col("s")))
    own = met.filter("v = c").select("c", shares.alias("s")).distinct().withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
    own = own.join(sets.select(F.col("v").alias("c"), F.col("grams").alias("other")), "c")
    pairs = pairs.join(sets, "v").join(own, ["c", "s", "share"])
    a, b, both = F.size("grams"), F.size("other"), F.size(F.array_intersect("grams", "other"))
    near = (F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9) & (both >= similarity * (a + b - both) - 1e-9)
    first = materialise(pairs.filter(near).select(F.col("v").alias("a"), F.col("c").alias("b")).union(known.select("a", "b")))
    labels = connected_components(first)

    several = met.filter("n > 2").join(labels, "v", "left").select("t", "key", "v", "n", F.coalesce("label", "v").alias("root"))
    sizes = several.groupBy("t", "key", "root").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v")).alias("members"))
    mixed = sizes.groupBy("t", "key").agg(F.max(F.struct("n", "root")).alias("major"), F.count("*").alias("roots"), F.bit_xor("members").alias("members"), F.sum("n").alias("n")).filter("roots > 1")
    # buckets of the same members are searched once
    chosen = mixed.groupBy("members", "n").agg(F.min(F.struct("t", "key", "major")).alias("k"))
    tiles = lambda n: F.ceil(n / tile).cast("long")
    chosen = chosen.select("k.t", "k.key", F.col("k.major.root").alias("major"), tiles(F.col("n") - F.col("k.major.n")).alias("p"), tiles(F.col("k.major.n")).alias("q"))
    # tiles 0 to p - 1 hold the smaller classes and meet all tiles, p to p + q - 1 the largest class and meet the former
    inner, place = F.col("root") == F.col("major"), F.xxhash64("v")
    dealt = several.join(chosen, ["t", "key"]).withColumn("tile", F.when(inner, F.col("p") + F.pmod(place, F.col("q"))).otherwise(F.pmod(place, F.col("p"))))
    last = F.when(inner, F.col("p")).otherwise(F.col("p") + F.col("q")) - 1
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), last))).join(sets, "v")
    dealt = dealt.select("t", "key", F.least("tile", "o").alias("g"), F.greatest("tile", "o").alias("h"), "v", "root", "tile", "grams")
    rest = materialise(dealt.groupBy("t", "key", "g", "h").applyInArrow(_across(similarity), "a long, b long"))
    if rest.isEmpty():
        return labels
    return connected_components(labels.select(F.col("v").alias("a"), F.col("label").alias("b")).union(rest))
