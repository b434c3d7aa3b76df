"""Removal of every byte that a repeated 200-byte string covers, by suffix arrays of shards.

Method: an exact filter first finds what can repeat at all. Every window of ``width`` bytes chooses its smallest hash of
``gram`` consecutive bytes as anchor, so equal windows choose equal anchors at equal places, and every repeated window
lies in the neighbourhoods of anchors that repeat: the bytes of all windows that choose the anchor, one run of them.
Neighbourhoods that repeat as wholes (equal in 128 bits of a SHA-256 of their bytes and in their anchor's hash) are
covered as wholes. Of the others, one of each kind goes to the shard of its anchor's hash; a shard's text is sorted by
induced sorting, permuted common prefixes give the runs of suffixes that agree in ``width`` bytes, and a run with two
different places in the corpus covers those places.

Equal texts are one row from the start. Texts are stored once, bucketed by key, and joined where they lie: what moves
are anchors, the neighbourhoods at the borders of repeats, and spans. Repeats inside a slice of the input are combined
before the exchange, so a passage of very many documents sends one row a slice. Anchors that many texts of a sample hold
are dealt by their kinds as well as by their hash (see ``_common``). A shard of more than ``_MOST`` kinds, as
a common passage has them whose surroundings differ, is split by the bytes beside its anchor (see ``_split``) until
none is larger, so no task grows with the most common passage.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binary_array, binary_view, materialise, scratch_dir
from .suffix_array import common_prefixes, suffix_array

_PIECE = 1 << 20
_ODD = 0xD1342543DE82EF95
_SHARD = 1 << 20
_MOST = 1024
_SAMPLE, _OFTEN, _HOT, _SALTS = 5000, 25, 4096, 1024
_KEY_BITS = 64


class Anchors:
    """Anchors of byte strings for one window width and gram length."""

    def __init__(self, width: int, gram: int):
        import numpy as np

        self.width, self.gram, self.span = width, gram, width - gram + 1
        n = 2 * _PIECE + width
        inverse = pow(_ODD, -1, 1 << 64)
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _ODD, np.uint64)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)])

    def find(self, data, starts, ends):
        """(positions, hashes, first and last window) of the anchors of the pieces ``data[start:end]``, in order.

        The windows that choose an anchor are consecutive; each window has one.
        """
        import numpy as np

        n, k = len(data), self.gram
        if n < self.width:
            none = np.zeros(0, np.int64)
            return none, np.zeros(0, np.uint64), none, none
        total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n])]
        h = (total[k:] - total[:-k]) * self.down[: n - k + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        low = np.uint64((1 << 22) - 1)
        m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= self.span:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < self.span:
            rest = self.span - size
            m = np.minimum(m[: len(m) - rest], m[rest:])
        live = np.zeros(len(m), bool)
        for a, b in zip(starts, ends, strict=True):
            live[a : max(a, b - self.width + 1)] = True
        window = np.flatnonzero(live)
        at = (m[window] & low).astype(np.int64)
        run = np.r_[True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)] if len(at) else np.zeros(0, bool)
        at = at[run]
        return at, h[at], window[run], window[np.r_[run[1:], True] if len(run) else run]


def _find(width: int, gram: int):
    """Rows of texts to rows of anchors; repeats inside a batch are combined (see module)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        anchors = Anchors(width, gram)
        for batch in batches:
            keys = batch.column("key").to_numpy()
            many = batch.column("copies").to_numpy() > 1
            data, at = binary_view(batch.column("text"))
            pieces = []  # (row, first byte, end) of at most _PIECE new windows each
            for r in np.flatnonzero(np.diff(at) >= width).tolist():
                for a in range(int(at[r]), int(at[r + 1]) - width + 1, _PIECE):
                    pieces.append((r, a, min(int(at[r + 1]), a + _PIECE + width - 1)))
            found = []
            i = 0
            while i < len(pieces):
                j, first = i + 1, pieces[i][1]
                while j < len(pieces) and pieces[j][2] - first <= _PIECE:
                    j += 1
                got = pieces[i:j]
                buffer = data[first : got[-1][2]]
                p, h, one, last = anchors.find(buffer, [g[1] - first for g in got], [g[2] - first for g in got])
                found.append((h, one + first, p - one, last - one + width))
                i = j
            if not found:
                continue
            h, base, left, size = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.searchsorted(at, base, "right") - 1
            snip, more = _digests(data.tobytes(), base.tolist(), (base + size).tolist(), left)
            want, pos = ~many[row], base - at[row]
            order = np.lexsort((snip, h))
            h, snip, more, row, pos, left, size, want = (x[order] for x in (h, snip, more, row, pos, left, size, want))
            new = np.r_[True, (h[1:] != h[:-1]) | (snip[1:] != snip[:-1]) | (more[1:] != more[:-1])]
            kind = np.cumsum(new) - 1
            n_kind = np.bincount(kind)
            rep = np.flatnonzero(new)
            whole = (n_kind[kind] > 1) & want
            key = keys[row]
            yield _rows(h[rep].view(np.int64), snip[rep], more[rep], key[rep], pos[rep], left[rep], size[rep], want[rep] & (n_kind == 1), (n_kind > 1) | ~want[rep], np.zeros(len(rep), bool))
            if whole.any():
                k, no = key[whole], np.zeros(int(whole.sum()), np.int64)
                yield _rows(k, no, no, k, pos[whole], left[whole], size[whole], no > 0, no > 0, no == 0)

    return run


def _digests(raw: bytes, starts: list[int], ends: list[int], left):
    """Two longs, 128 bits of the SHA-256 of each stretch of ``raw`` and of how far its anchor lies in it."""
    import numpy as np

    place = left.astype("<i4").tobytes()
    found = b"".join([hashlib.sha256(raw[a:b] + place[4 * i : 4 * i + 4]).digest() for i, (a, b) in enumerate(zip(starts, ends, strict=True))])
    two = np.frombuffer(found, "<i8").reshape(-1, 4)
    return two[:, 0].copy(), two[:, 1].copy()


_ROWS = pa.schema([("h", pa.int64()), ("snip", pa.int64()), ("more", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("left", pa.int32()), ("size", pa.int32()), ("flags", pa.int8())])


def _rows(h, snip, more, key, pos, left, size, want, many, whole) -> pa.RecordBatch:
    """pos, size: the neighbourhood; left: its bytes before the anchor; flags: 1 its spans are wanted, 2 it stands for several places, 4 covered as a whole."""
    flags = want * 1 + many * 2 + whole * 4
    cols = (pa.array(x).cast(f.type) for x, f in zip((h, snip, more, key, pos, left, size, flags), _ROWS, strict=True))
    return pa.RecordBatch.from_arrays(list(cols), schema=_ROWS)


def _match(hot: list[int]):
    """Anchors sorted by (h, snip, more) to what is covered as a whole (flags 4) and the kinds of a shard (flags 1 or 2).

    A kind alone in its shard is left out, but for the shards ``hot``, whose kinds are dealt to several tasks. Only the
    last kind crosses batches, with whether its shard has others.
    """
    return lambda batches: _matched(batches, hot)


def _matched(batches: Iterator[pa.RecordBatch], hot: list[int]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    held, others = None, False  # the rows of the last kind seen, combined; whether its shard had one before
    for batch in _padded(batches):
        if batch is not None:
            whole = batch["flags"] == 4
            if whole.any():
                yield _out(batch[whole])
            rows = batch[~whole]
            if not len(rows):
                continue
            rows = rows if held is None else np.concatenate([held, rows])
        elif held is not None:
            rows = held
        else:
            break
        new = np.r_[True, (rows["h"][1:] != rows["h"][:-1]) | (rows["snip"][1:] != rows["snip"][:-1]) | (rows["more"][1:] != rows["more"][:-1])]
        kind = np.cumsum(new) - 1
        several = np.bincount(kind) > 1
        done = rows[several[kind] & (rows["flags"] & 1 == 1)].copy()
        if len(done):
            done["flags"] = 4
            yield _out(done)
        kinds = rows[new].copy()
        kinds["flags"][several] = 2
        same = kinds["h"][1:] == kinds["h"][:-1]
        company = np.r_[others, same] | np.r_[same, False] | np.isin(kinds["h"], hot)
        if batch is None:
            out = kinds[company]
        else:  # the last kind may go on in the next batch
            out, held, others = kinds[:-1][company[:-1]], kinds[-1:], bool(same[-1]) if len(same) else others
        if len(out):
            yield _out(out)


def _padded(batches):
    """Packed rows of every batch, then None."""
    import numpy as np

    for batch in batches:
        out = np.empty(batch.num_rows, _PACKED)
        for name, _ in _PACKED:
            out[name] = batch.column(name).to_numpy()
        yield out
    yield None


_PACKED = [("h", "<i8"), ("snip", "<i8"), ("more", "<i8"), ("key", "<i8"), ("pos", "<i4"), ("left", "<i4"), ("size", "<i4"), ("flags", "i1")]
_KINDS = "h long, key long, pos int, left int, size int, flags byte"


def _out(rows) -> pa.RecordBatch:
    import numpy as np

    names = ["h", "key", "pos", "left", "size", "flags"]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c])) for c in names], names)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their asked anchors to neighbourhoods."""
    import numpy as np

    for batch in batches:
        data, at = binary_view(batch.column("text"))
        asked = batch.column("asked")
        parts = asked.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.asarray(asked.value_lengths()))
        a = at[row] + parts.field("pos").to_numpy()
        b = a + parts.field("size").to_numpy()
        raw = data.tobytes()
        for k in range(0, len(row), 20_000):
            s = slice(k, k + 20_000)
            text = b"".join([raw[x:y] for x, y in zip(a[s].tolist(), b[s].tolist(), strict=True)])
            part = lambda c: parts.field(c).slice(k, 20_000)  # noqa: B023, E731
            cols = [part("h"), pa.array(batch.column("key").to_numpy()[row[s]]), part("pos"), part("left"), part("flags"), binary_array(text, np.r_[0, np.cumsum(b[s] - a[s])])]
            yield pa.RecordBatch.from_arrays(cols, ["h", "key", "pos", "left", "flags", "text"])


def repeated_spans(size, key, start, flags, text, width: int):
    """(row, first byte, end) of what strings of ``width`` bytes cover that are at two different places of these rows.

    ``text`` packs the rows' bytes, ``size`` has their lengths; ``key`` and ``start`` place a row in the corpus. Rows of
    several small shards may be sorted together: what is equal at different places is repeated, in one shard or two.
    """
    import numpy as np

    n = int(size.sum()) + len(size) + 1
    t = np.ones(n, np.uint8)  # 0 ends the text, 1 ends a row; UTF-8 has no bytes above 0xF4
    begin = np.cumsum(size + 1) - (size + 1)
    row_of = np.repeat(np.arange(len(size)), size + 1)
    offset = np.arange(n - 1) - begin[row_of]
    real = offset < size[row_of]
    t[: n - 1][real] = np.minimum(text, 253) + 2
    t[n - 1] = 0
    order = suffix_array(t)
    inner = np.minimum(order, n - 2)
    p = order[(order < n - 1) & (size[row_of[inner]] - offset[inner] >= width)]
    if not len(p):
        return (np.zeros(0, np.int64),) * 3
    run = np.cumsum(common_prefixes(t, p, width)[p] < width)
    row = row_of[p]
    place = start[row].astype(np.int64) + offset[p]
    _, known = np.unique(key[row], return_inverse=True)
    spot = known.astype(np.int64) * (1 << 33) + place
    several = flags[row] & 2 > 0
    _, first = np.unique(run, return_index=True)
    lo = np.minimum.reduceat(spot, first)
    hi = np.maximum.reduceat(np.where(several, np.iinfo(np.int64).max, spot), first)
    group = np.searchsorted(first, np.arange(len(p)), "right") - 1
    hit = (lo != hi)[group] & (flags[row] & 1 > 0)
    row, a = row[hit], place[hit]
    if not len(row):
        return (np.zeros(0, np.int64),) * 3
    o = np.lexsort((a, row))
    row, a = row[o], a[o]
    new = np.r_[True, (row[1:] != row[:-1]) | (a[1:] > a[:-1] + width)]
    at = np.flatnonzero(new)
    return row[at], a[at], a[np.r_[at[1:], len(a)] - 1] + width


def _likely(h, size, left, flags, data, width: int, gram: int):
    """Which rows can share a window at their anchor with another of their shard.

    A window reaches some way to the left of the anchor and the rest of the way to the right. Cut in four by how far it
    reaches to the left, the windows of a quarter share a string of at least three quarters of the neighbourhood. Rows
    that share none of the four strings with another row are left out, and so are shards where no row's spans are wanted.
    """
    import numpy as np

    n, side = len(data), width - gram
    up = np.cumprod(np.r_[np.uint64(1), np.full(n, _ODD, np.uint64)])
    down = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n])]
    anchor = np.cumsum(size) - size + left
    right = size - left - gram
    keep = np.zeros(len(size), bool)
    for q in range(4):
        la, ra = side * q // 4, side - side * (q + 1) // 4
        can = np.flatnonzero((left >= la) & (right >= ra))
        a, b = anchor[can] - la, anchor[can] + gram + ra
        mark = (total[b] - total[a]) * down[a]
        mark = (mark ^ (mark >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[can].view(np.uint64)
        _, which, count = np.unique(mark, return_inverse=True, return_counts=True)
        keep[can[count[which] > 1]] = True
    _, shard = np.unique(h, return_inverse=True)
    return keep & (np.bincount(shard, keep & (flags & 1 > 0)) > 0)[shard]


_SPLIT = "h long, snip long, more long, a int, b int, key long, pos int, left int, flags byte, text binary"


def _split(width: int, gram: int):
    """Rows of shards that are too large to rows of smaller ones.

    The windows at an anchor reach 0 to ``width - gram`` bytes to its left. A shard stands for a range ``a`` to ``b`` of
    that reach; it is cut in four, and a row goes to the part of each range that it has windows in, cut down to the bytes
    of those windows. All windows of a range hold the ``a`` bytes before the anchor and those behind it up to the range's
    end, so rows that differ there are in different shards. Rows that are equal as cut are combined as in ``_find``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        side = width - gram
        for batch in batches:
            data, at = binary_view(batch.column("text"))
            raw = data.tobytes()
            h, a0, b0, key, pos, left, flags = (batch.column(c).to_numpy() for c in ("h", "a", "b", "key", "pos", "left", "flags"))
            left = left.astype(np.int64)
            anchor = at[:-1] + left
            right = np.diff(at) - left - gram
            for q in range(4):
                n = b0 - a0 + 1
                a, b = a0 + n * q // 4, a0 + n * (q + 1) // 4 - 1
                can = np.flatnonzero((a <= b) & (left >= a) & (right >= side - b) & (left + right >= side))
                if not len(can):
                    continue
                lo, hi = np.minimum(left, b)[can], np.minimum(right, side - a)[can]
                x, y = (anchor[can] - lo).tolist(), (anchor[can] + gram + hi).tolist()
                snip, more = _digests(raw, x, y, lo)
                common = _digests(raw, (anchor[can] - a[can]).tolist(), (anchor[can] + gram + side - b[can]).tolist(), a[can])[0]
                shard = ((h[can].view(np.uint64) ^ common.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64) ^ a[can]
                order = np.lexsort((more, snip, shard))
                new = np.r_[True, (shard[order][1:] != shard[order][:-1]) | (snip[order][1:] != snip[order][:-1]) | (more[order][1:] != more[order][:-1])]
                size = np.bincount(np.cumsum(new) - 1)
                kind = np.empty(len(can), np.int64)
                kind[order] = np.cumsum(new) - 1
                mark = flags[can]
                whole = (size[kind] > 1) & (mark & 1 == 1)
                rep = order[new]
                mark = np.where(size[kind] > 1, 2, mark)
                pick = np.r_[rep, np.flatnonzero(whole)]
                spans = np.arange(len(pick)) >= len(rep)
                text = b"".join([raw[x[i] : y[i]] for i in rep.tolist()])
                ends = np.r_[0, np.cumsum((hi + gram + lo)[rep]), np.full(int(spans.sum()), len(text))]
                long = lambda v: pa.array(v[pick])
                first, length = pos[can] + left[can] - lo, lo + gram + hi
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.where(spans, key[can][pick], shard[pick])), long(snip), long(more), pa.array(np.where(spans, first[pick], a[can][pick]).astype(np.int32)), pa.array(np.where(spans, (first + length)[pick], b[can][pick]).astype(np.int32)),
                    long(key[can]), pa.array(first[pick].astype(np.int32)), pa.array(lo[pick].astype(np.int32)), pa.array(np.where(spans, 4, mark[pick]).astype(np.int8)), binary_array(text, ends)
                ], ["h", "snip", "more", "a", "b", "key", "pos", "left", "flags", "text"])

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_split`` sorted by (h, snip, more) with one row of each kind; of several the wanted ones become spans."""
    import numpy as np

    last, held = None, None  # the kind at hand and its one row, which may go on in the next batch

    def span(row):
        return row | {"a": row["pos"], "b": row["pos"] + len(row["text"]), "flags": 4, "text": b""}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["flags"] == 4:
                out.append(row)
                continue
            kind = (row["h"], row["snip"], row["more"])
            if kind != last:
                if held is not None:
                    out.append(held)
                last, held = kind, row
                continue
            out += [span(r) for r in (held, row) if r["flags"] & 1]
            held = held | {"flags": 2}
        yield pa.RecordBatch.from_pylist(out, batch.schema)
        schema = batch.schema
    if held is not None:
        yield pa.RecordBatch.from_pylist([held], schema)


def _sort_shards(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def work(table: pa.Table):
            h, key, start, left, flags = (table.column(c).to_numpy() for c in ("h", "key", "pos", "left", "flags"))
            text, at = binary_view(table.column("text"))
            size, left = np.diff(at), left.astype(np.int64)
            keep = _likely(np.ascontiguousarray(h), size, left, flags, text, width, gram)
            text, size = text[np.repeat(keep, size)], size[keep]
            key, start, flags = key[keep], start[keep], flags[keep]
            row, a, b = repeated_spans(size, key, start, flags, text, width) if len(key) else (np.zeros(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(a), pa.array(b)], ["key", "start", "end"])

        held, size = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                held.append(part)
                size += part.column("text").nbytes
                if size >= _SHARD:  # a shard has ``_MOST`` rows at most, so its end is near
                    table = pa.Table.from_batches(held)
                    h = table.column("h").to_numpy()
                    tail = h == h[-1]
                    cut = len(h) - int(tail[::-1].argmin()) if not tail.all() else 0
                    if cut:
                        yield work(table.slice(0, cut))
                        held = table.slice(cut).combine_chunks().to_batches()
                        size = sum(x.column("text").nbytes for x in held)
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def _cut(width: int):
    """Texts with their spans to counts and the digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            out = [[], [], []]
            for text, copies, spans in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if copies > 1 and len(text) >= width:
                    merged = [(0, len(text))]
                else:
                    merged = []
                    for s in sorted((x["start"], min(x["end"], len(text))) for x in spans or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1] = (merged[-1][0], max(merged[-1][1], s[1]))
                        else:
                            merged.append(s)
                left, last = [], 0
                for a, b in merged:
                    left.append(text[last:a])
                    last = b
                left.append(text[last:])
                out[0].append(sum(b - a for a, b in merged))
                out[1].append(len(merged))
                out[2].append(hashlib.sha256(b"".join(left)).hexdigest())
            cols = [batch.column("key"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "n_removed", "n_spans", "kept_sha256"])

    return run


def _key(seed: int):
    mask = (1 << _KEY_BITS) - 1
    return F.xxhash64(F.lit(seed), "digest").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def _keyed(rows: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(stored doc_id, digest, key, n_bytes of all rows; key, text of all rows), one key a digest.

    A key is a 64-bit hash of the digest; where two digests share one, all but the smallest are hashed anew.
    """
    small = materialise(rows.select("doc_id", "digest", _key(seed).alias("key"), F.octet_length("text").cast("long").alias("n_bytes")))
    texts = rows.select("digest", _key(seed).alias("key"), "text")
    while True:
        seed += 1
        shared = small.groupBy("key").agg(F.min("digest").alias("_first"), F.max("digest").alias("_last")).filter("_first <> _last").select("key", "_first")
        if shared.isEmpty():
            return small, texts.select("key", "text")
        moved = materialise(small.join(shared, "key").filter("digest <> _first").select("digest").distinct().select("digest", _key(seed).alias("_key")))
        small, texts = (df.join(moved, "digest", "left").withColumn("key", F.coalesce("_key", "key")).drop("_key") for df in (small, texts))
        small = materialise(small)


def _stored(texts: DataFrame) -> tuple[DataFrame, str, str]:
    """(key, text, copies of the distinct texts: a table in the shared folder, bucketed by key; its name and folder)."""
    spark = texts.sparkSession
    name, path = f"pairloom_{uuid.uuid4().hex}", scratch_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    distinct.write.bucketBy(n, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name), name, path


_FOUND = "h long, snip long, more long, key long, pos int, left int, size int, flags byte"


def _common(texts: DataFrame, n: int, width: int, gram: int) -> list[int]:
    """Hashes of the most frequent anchors of about ``_SAMPLE`` of ``n`` texts: those whose keys are smallest, which lie together.

    At most ``_HOT``, with ``_OFTEN`` rows or more. The result decides which tasks look at an anchor, never what they find.
    """
    if n > _SAMPLE:
        texts = texts.filter(F.col("key") < -(1 << 63) + (1 << 64) * _SAMPLE // n)
    rows = texts.mapInArrow(_find(width, gram), _FOUND).filter("flags < 4").groupBy("h").agg(F.count("*").alias("n"))
    return [r["h"] for r in rows.filter(F.col("n") >= _OFTEN).orderBy(F.col("n").desc(), "h").limit(_HOT).collect()]


def _large(kinds: DataFrame, by: Column) -> DataFrame:
    """Stored h of the shards that ``by`` counts more than ``_MOST`` rows of; there are few, by far fewer than rows."""
    return materialise(kinds.filter(by).groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > _MOST).select("h"))


def _smaller(rows: DataFrame, width: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(rows of shards that are small enough; key, start, end of what was covered on the way) of large shards."""
    side, done, spans = width - gram, None, None
    rows = rows.select("h", F.lit(0).alias("a"), F.lit(side).alias("b"), "key", "pos", "left", "flags", "text")
    while True:
        split = rows.mapInArrow(_split(width, gram), _SPLIT)
        made = materialise(split.repartition("h", "snip").sortWithinPartitions("h", "snip", "more").mapInArrow(_alike, _SPLIT))
        covered = made.filter("flags = 4").select("key", F.col("a").cast("long").alias("start"), F.col("b").cast("long").alias("end"))
        large = _large(made, (F.col("flags") < 4) & (F.col("a") < F.col("b")))
        kinds = made.filter("flags < 4")
        small = kinds.join(large, "h", "left_anti").select("h", "key", "pos", "left", "flags", "text")
        done, spans = (small, covered) if done is None else (done.union(small), spans.union(covered))
        if large.isEmpty():
            return done, spans
        rows = kinds.join(large, "h", "left_semi").select("h", "a", "b", "key", "pos", "left", "flags", "text")


def substring_dedup(docs: DataFrame, width: int = 200, gram: int | None = None, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Removed is each UTF-8 byte that a ``width``-byte string covers which also starts anywhere else, in the same or
    another document; strings are judged on the input. A null text is empty: nothing removed, the digest of no bytes.
    Rows that repeat a text of at least ``width`` bytes lose all of it, whatever their ids. Other columns are ignored
    whatever their names; an empty table gives no rows.
    """
    gram = gram or width // 2
    spark = docs.sparkSession
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    small, rows = _keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256))), seed)
    texts, name, path = _stored(rows)
    wide = texts.filter(F.octet_length("text") >= width)
    hot = _common(wide, small.count(), width, gram)
    salt = F.when(F.col("h").isin(hot), F.pmod("snip", F.lit(_SALTS))).otherwise(F.lit(0).cast("long"))
    found = wide.mapInArrow(_find(width, gram), _FOUND)
    kinds = materialise(found.repartition("h", salt).sortWithinPartitions("h", "snip", "more").mapInArrow(_match(hot), _KINDS))
    large = _large(kinds, F.col("flags") < 4)

    def parts(of: DataFrame) -> DataFrame:
        asked = of.filter("flags < 4").groupBy("key").agg(F.collect_list(F.struct("h", "pos", "left", "size", "flags")).alias("asked"))  # bounded by the text's length
        return texts.join(asked, "key").select("key", "text", "asked").mapInArrow(_extract, "h long, key long, pos int, left int, flags byte, text binary")

    whole = kinds.filter("flags = 4").select("key", F.col("pos").cast("long").alias("start"), (F.col("pos") + F.col("size")).cast("long").alias("end"))
    if large.isEmpty():
        shards = parts(kinds)
    else:
        split, covered = _smaller(parts(kinds.join(large, "h", "left_semi")), width, gram)
        shards, whole = parts(kinds.join(large, "h", "left_anti")).union(split), whole.union(covered)
    border = shards.repartition("h").sortWithinPartitions("h").mapInArrow(_sort_shards(width, gram), "key long, start long, end long")
    spans = whole.union(border).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # bounded by the text's length
    cut = texts.join(spans, "key", "left").select("key", "text", "copies", "spans").mapInArrow(_cut(width), "key long, n_removed long, n_spans long, kept_sha256 string")
    done = materialise(cut)
    spark.sql(f"DROP TABLE {name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return small.join(done, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
