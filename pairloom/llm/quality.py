"""Document quality from a linear-chain conditional random field over lines.

Method: every line of a text is labelled good or bad. A line's features are its own surface measures (length, character
classes, repetition within the line and with what the document said before) and those of the lines before and behind
it; transitions tie neighbours. Training lines carry their document's label. Forward-backward gives each line's
marginal probability of being good, the marginals are averaged by line length, and the average is calibrated on a
part of the training sample that the field was not fitted on.

Scale: the model is about a hundred weights. Scoring is one pass without an exchange over whole texts; features are
computed over the bytes of a slice at once and the chains of a slice run side by side. A long text is read in windows
and its chain in pieces, which run side by side as 2 x 2 matrices first and with their borders known then; what is kept
of it is 12 bytes a line and 8 bytes a distinct word pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .linear import held_out, labelled_sample, lbfgs, platt

_WINDOW = 1 << 20
_LINES = 2000
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"()-", b"!?", b"#$%&*+=@^~_\\/<>[]{}`", b"|", b" \t\x0b\x0c\r")


@dataclass
class Model:
    mean: object
    scale: object
    weights: object  # (features + 1) x 2, then transitions 2 x 2
    a: float
    b: float


def _kinds():
    """The class of each byte: a place in ``_CLASSES``, one more for all others, two more for a line break."""
    import numpy as np

    table = np.full(256, len(_CLASSES), np.uint8)
    for k, c in enumerate(_CLASSES):
        table[list(c)] = k
    table[10] = len(_CLASSES) + 1
    return table


def _surface(data):
    """(line starts, lengths, class counts, word hashes, line of each word) of bytes that end with a line break."""
    import numpy as np

    breaks = np.flatnonzero(data == 10)
    starts = np.r_[0, breaks[:-1] + 1]
    kind = _kinds()[data]
    counts = np.stack([np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(len(_CLASSES) + 1)], 1)
    # words: runs of anything but white space
    blank = (kind == len(_CLASSES) - 1) | (kind == len(_CLASSES) + 1)
    inside = ~blank
    begin = np.flatnonzero(inside & np.r_[True, blank[:-1]])
    end = np.flatnonzero(inside & np.r_[blank[1:], True]) + 1
    line = np.searchsorted(starts, begin, "right") - 1
    mul = np.uint64(0x9E3779B97F4A7C15)
    token = (data.astype(np.uint64) + np.uint64(1)) * mul
    token ^= token >> np.uint64(32)
    power = np.cumprod(np.full(int((end - begin).max()) if len(begin) else 1, 0xD1342543DE82EF95, np.uint64))
    first = begin[0] if len(begin) else len(data)
    spot = np.r_[np.zeros(first, np.int64), np.arange(first, len(data)) - np.repeat(begin, np.diff(np.r_[begin, len(data)]))]
    token *= power[np.minimum(spot, len(power) - 1)]
    token[blank] = 0
    word = np.add.reduceat(token, begin) if len(begin) else np.zeros(0, np.uint64)
    return starts, breaks - starts, counts, word, line


def _pairs(word):
    import numpy as np

    return word[:-1] * np.uint64(0x94D049BB133111EB) + word[1:]


def _base(length, counts, words, distinct, repeats, fresh):
    """The features of single lines from their bytes, class counts and words: distinct, equal to the one before, in word pairs new in the text."""
    import numpy as np

    per, size = np.maximum(1, words), np.maximum(1, length)[:, None]
    return np.c_[np.log1p(length), np.log1p(words), counts / size, length / per / 10, np.minimum(1, distinct / per), repeats / per, np.minimum(1, fresh / per), counts[:, 4] / per, counts[:, 5] / per, counts[:, 6] / per, length == 0]


def base_of(raw: list[bytes]):
    """(features of single lines, number of lines of each text, line lengths in bytes); an empty text is one line."""
    import numpy as np

    n_lines = np.fromiter((r.count(b"\n") + 1 for r in raw), np.int64, len(raw))
    starts, length, counts, word, line = _surface(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
    total = len(starts)
    doc = np.repeat(np.arange(len(raw)), n_lines)
    distinct = repeats = fresh = np.zeros(total, np.int64)
    if len(word):
        salt = np.uint64(0xBF58476D1CE4E5B9)
        _, one = np.unique(word ^ (line.astype(np.uint64) * salt), return_index=True)
        distinct = np.bincount(line[one], minlength=total)
        repeats = np.bincount(line[1:][(word[1:] == word[:-1]) & (line[1:] == line[:-1])], minlength=total)
        own = doc[line]
        inside = np.flatnonzero(own[1:] == own[:-1])
        _, one = np.unique(_pairs(word)[inside] ^ (own[1:][inside].astype(np.uint64) * salt), return_index=True)
        fresh = np.bincount(line[1:][inside][one], minlength=total)
    return _base(length, counts, np.bincount(line, minlength=total), distinct, repeats, fresh), n_lines, length


def _cuts(raw: bytes, window: int):
    """Ends of consecutive windows: behind a line break, else behind white space, else after ``window`` bytes."""
    at = 0
    while len(raw) - at > window:
        end = raw.rfind(b"\n", at, at + window) + 1
        if not end:
            end = max(raw.rfind(c, at, at + window) for c in (b" ", b"\t")) + 1 or at + window
        yield at, end
        at = end
    yield at, len(raw)


def long_base(raw: bytes, window: int = 0):
    """``base_of`` of one long text, window by window: pairs (features, lengths) of consecutive lines.

    A line longer than a window is gathered piece by piece; a word longer than a window counts as several.
    """
    import numpy as np

    seen, last = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # word pairs of the text, its last word so far
    held = None  # the line that the last window left open: length, counts, words, distinct words, repeats, fresh pairs
    for a, b in _cuts(raw, window or _WINDOW):
        part = raw[a:b]
        closed = b == len(raw) or part.endswith(b"\n")
        starts, length, counts, word, line = _surface(np.frombuffer(part[:-1] + b"\n" if part.endswith(b"\n") and b < len(raw) else part + b"\n", np.uint8))
        total = len(starts)
        words = np.bincount(line, minlength=total)
        spoken, at = np.r_[last, word], np.r_[np.full(len(last), -1), line]
        repeats = np.bincount(at[1:][(spoken[1:] == spoken[:-1]) & (at[1:] == at[:-1])], minlength=total)
        if held is not None and len(last) and len(word) and line[0] == 0 and held[2] and last[0] == word[0]:
            repeats[0] += 1
        pair, one = np.unique(_pairs(spoken), return_index=True) if len(spoken) > 1 else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        new = ~np.isin(pair, seen, assume_unique=True)
        fresh = np.bincount(at[1:][one[new]], minlength=total)
        seen = np.sort(np.r_[seen, pair[new]])
        _, one = np.unique(word ^ (line.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)), return_index=True)
        distinct = np.bincount(line[one], minlength=total)
        last = spoken[-1:]
        open_words = np.unique(word[line == total - 1]) if not closed else None
        if held is not None:
            known = held[3]
            mine = np.unique(np.r_[known, word[line == 0]])
            length[0], counts[0], words[0], distinct[0], repeats[0], fresh[0] = length[0] + held[0], counts[0] + held[1], words[0] + held[2], len(mine), repeats[0] + held[4], fresh[0] + held[5]
            if total == 1 and not closed:
                open_words = mine
        held = None
        if not closed:
            held = (length[-1], counts[-1], words[-1], open_words, repeats[-1], fresh[-1])
            length, counts, words, distinct, repeats, fresh = (x[:-1] for x in (length, counts, words, distinct, repeats, fresh))
        if len(length):
            yield _base(length, counts, words, distinct, repeats, fresh), length


def lines_of(texts: list[str]):
    """(line features, number of lines of each text, line lengths in bytes) of whole texts; an empty text is one line."""
    import numpy as np

    base, n_lines, length = base_of([t.encode("utf-8", "surrogatepass") for t in texts])
    doc = np.repeat(np.arange(len(texts)), n_lines)
    same = doc[1:] == doc[:-1]
    before, behind = np.zeros_like(base), np.zeros_like(base)
    before[1:][same] = base[:-1][same]
    behind[:-1][same] = base[1:][same]
    first, last = np.r_[True, ~same], np.r_[~same, True]
    return np.c_[base, before, behind, first, last], n_lines, length


def _columns(n_lines):
    """Lines side by side: for each step the line numbers of the texts that have that many lines, longest text first."""
    import numpy as np

    order = np.argsort(-n_lines, kind="stable")
    start = np.cumsum(n_lines) - n_lines
    live = np.searchsorted(-n_lines[order], -np.arange(1, (n_lines.max() if len(n_lines) else 0) + 1), "right")
    return start[order], live


def marginals(unary, trans, n_lines, w_line=None):
    """(log partition of each line's text, line marginals [line, label], expected transitions weighted by line)."""
    import numpy as np

    start, live = _columns(n_lines)
    alpha, beta = np.empty_like(unary), np.zeros_like(unary)
    join = lambda x: np.logaddexp(x[..., 0], x[..., 1])
    for t, n in enumerate(live.tolist()):
        at = start[:n] + t
        if t == 0:
            alpha[at] = unary[at]
        else:
            alpha[at] = unary[at] + join((alpha[at - 1][:, :, None] + trans).swapaxes(1, 2))
    for t in range(len(live) - 2, -1, -1):
        at = start[: live[t + 1]] + t
        beta[at] = join(trans + (unary[at + 1] + beta[at + 1])[:, None, :])
    log_z = join(alpha + beta)
    p = np.exp(alpha + beta - log_z[:, None])
    if w_line is None:
        return log_z, p, None
    follows = np.ones(len(unary), bool)
    follows[start] = False
    i = np.flatnonzero(follows)
    pair = np.exp(alpha[i - 1][:, :, None] + trans + (unary[i] + beta[i])[:, None, :] - log_z[i][:, None, None])
    return log_z, p, (pair * w_line[i][:, None, None]).sum(0)


def _text_scores(p, n_lines, length):
    import numpy as np

    at = np.cumsum(n_lines) - n_lines
    w = np.maximum(1, length)
    return np.add.reduceat(p[:, 1] * w, at) / np.add.reduceat(w, at)


def _logit(s):
    import numpy as np

    s = np.clip(s, 1e-6, 1 - 1e-6)
    return np.log(s / (1 - s))


def train(texts: list[str], y, weight, l2: float = 1.0, rounds: int = 60) -> Model:
    """Fit the field on four fifths of the sample and the calibration on the rest; one class alone gives its share."""
    import numpy as np

    if len(texts) < 10 or y.min() == y.max():
        share = float(np.average(y, weights=weight)) if len(texts) else 0.5
        n = lines_of([""])[0].shape[1]
        return Model(np.zeros(n), np.ones(n), np.zeros(2 * (n + 1) + 4), 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    part = np.arange(len(texts)) % 5 == 0
    fit_on = np.flatnonzero(~part)
    x, n_lines, length = lines_of([texts[i] for i in fit_on])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = np.c_[(x - mean) / scale, np.ones(len(x))]
    truth, w_doc = y[fit_on].astype(int), weight[fit_on]
    label, w_line = np.repeat(truth, n_lines), np.repeat(w_doc, n_lines)
    starts = np.cumsum(n_lines) - n_lines
    # a text's likelihood is divided by its lines, so that very long texts don't outweigh all others
    w_doc = w_doc / n_lines
    w_line = w_line / np.repeat(n_lines, n_lines)
    k = x.shape[1]

    def loss(v):
        u, trans = v[: 2 * k].reshape(k, 2), v[2 * k :].reshape(2, 2)
        unary = x @ u
        log_z, p, grad_t = marginals(unary, trans, n_lines, w_line)
        gold = np.add.reduceat(unary[np.arange(len(x)), label], starts) + trans[truth, truth] * (n_lines - 1)
        value = float((w_doc * (log_z[starts] - gold)).sum()) + l2 / 2 * float(v @ v)
        diff = p * w_line[:, None]
        diff[np.arange(len(x)), label] -= w_line
        for c in (0, 1):
            grad_t[c, c] -= (w_doc * (n_lines - 1))[truth == c].sum()
        return value, np.r_[(x.T @ diff).ravel(), grad_t.ravel()] + l2 * v

    v = lbfgs(loss, np.zeros(2 * k + 4), rounds=rounds)
    model = Model(mean, scale, v, 1.0, 0.0)
    rest = np.flatnonzero(part)
    s = _logit(raw_scores([texts[i] for i in rest], model)[0])
    model.a, model.b = (float(c) for c in platt(s, y[rest], weight[rest]))
    return model


def _parts(model: Model):
    """(constant, weights of a line's own features, of them as the line before and behind, of first and last line, transitions)."""
    k = len(model.mean) + 1
    u, trans = model.weights[: 2 * k].reshape(k, 2), model.weights[2 * k :].reshape(2, 2)
    w = u[:-1] / model.scale[:, None]
    n = (k - 3) // 3
    return u[-1] - model.mean @ w, w[:n], w[n : 2 * n], w[2 * n : 3 * n], w[3 * n], w[3 * n + 1], trans


def raw_scores(texts: list[str], model: Model):
    """(length-weighted mean marginal, lines, bad lines) of each text."""
    import numpy as np

    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    long = np.array([len(r) > _WINDOW or r.count(b"\n") > _LINES for r in raw], bool)
    score, n_lines, bad = np.zeros(len(raw)), np.ones(len(raw), np.int64), np.zeros(len(raw), np.int64)
    for i in np.flatnonzero(long).tolist():
        score[i], n_lines[i], bad[i] = long_score(raw[i], model)
    short = np.flatnonzero(~long)
    if len(short):
        constant, own, before, behind, first, last, trans = _parts(model)
        base, n, length = base_of([raw[i] for i in short.tolist()])
        start = np.cumsum(n) - n
        unary = constant + base @ own
        inner = np.ones(len(base), bool)
        inner[start] = False
        inner = np.flatnonzero(inner)
        unary[inner] += base[inner - 1] @ before
        unary[inner - 1] += base[inner] @ behind
        unary[start] += first
        unary[start + n - 1] += last
        p = marginals(unary, trans, n)[1]
        score[short], n_lines[short], bad[short] = _text_scores(p, n, length), n, np.add.reduceat(p[:, 1] < 0.5, start, dtype=np.int64)
    return score, n_lines, bad


def long_score(raw: bytes, model: Model, window: int = 0, piece: int = 256):
    """``raw_scores`` of one long text."""
    import numpy as np

    constant, own, before, behind, first, last, trans = _parts(model)
    unary, lengths, edge = [], [], None
    for base, length in long_base(raw, window):
        u = constant + base @ own
        u[1:] += base[:-1] @ before
        u[:-1] += base[1:] @ behind
        if edge is not None:
            u[0] += edge @ before
            unary[-1][-1] += (base[0] @ behind).astype(np.float32)
        edge = base[-1].copy()
        unary.append(u.astype(np.float32))
        lengths.append(length.astype(np.int32))
    unary, length = np.concatenate(unary), np.concatenate(lengths)
    unary[0] += first.astype(np.float32)
    unary[-1] += last.astype(np.float32)
    good = total = bad = 0
    for at, p in chain_marginals(unary, trans, piece):
        w = np.maximum(1, length[at : at + len(p)])
        good, total, bad = good + float(p @ w), total + int(w.sum()), bad + int((p < 0.5).sum())
    return good / total, len(unary), bad


def chain_marginals(unary, trans, piece: int = 256, group: int = 4096):
    """(first line, marginals of label 1) of consecutive runs of one long chain's lines.

    Pieces of the chain are multiplied out side by side to 2 x 2 matrices, which give the state at every border; then
    a bounded group of pieces at a time runs forward and backward between its borders.
    """
    import numpy as np

    n = len(unary)
    count = -(-n // piece)
    join = lambda x, axis: np.logaddexp.reduce(x, axis)
    size = np.full(count, piece)
    size[-1] = n - (count - 1) * piece
    lines = lambda p, t: np.minimum(p * piece + t, n - 1)
    whole = np.arange(count)
    f = trans[None] + unary[lines(whole, 0)].astype(float)[:, None, :]
    for t in range(1, piece):
        g = join(f[:, :, :, None] + trans[None, None], 2) + unary[lines(whole, t)].astype(float)[:, None, :]
        f = np.where((t < size)[:, None, None], g, f)
    into, out = np.zeros((count, 2)), np.zeros((count, 2))  # alpha before a piece's first line, beta at its last
    state = None
    for p in range(count - 1):
        if p == 0:  # nothing comes before the first line
            state = unary[0].astype(float)
            for t in range(1, int(size[0])):
                state = join(state[:, None] + trans, 0) + unary[t]
        else:
            state = join(into[p][:, None] + f[p], 0)
        into[p + 1] = state - state.max()
    for p in range(count - 1, 0, -1):
        state = join(f[p] + out[p][None, :], 1)
        out[p - 1] = state - state.max()
    for lo in range(0, count, group):
        p = whole[lo : lo + group]
        live = size[p]
        alpha = np.empty((len(p), piece, 2))
        for t in range(piece):
            u = unary[lines(p, t)].astype(float)
            came = into[p] if t == 0 else alpha[:, t - 1]
            alpha[:, t] = join(came[:, :, None] + trans[None], 1) + u
            if t == 0 and lo == 0:
                alpha[0, 0] = u[0]
            if t:
                alpha[:, t] = np.where((t < live)[:, None], alpha[:, t], alpha[:, t - 1])
        beta, good = out[p], np.empty((len(p), piece))
        for t in range(piece - 1, -1, -1):
            both = alpha[:, t] + beta
            good[:, t] = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
            if t:
                u = unary[lines(p, t)].astype(float)
                back = join(trans[None] + (u + beta)[:, None, :], 2)
                beta = np.where((t < live)[:, None], back, beta)
        yield int(lo * piece), good.ravel()[: n - lo * piece]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_chars: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on at most ``per_class`` labelled rows and ``max_chars`` characters of each class, from the training folds alone."""
    return train(*labelled_sample(docs, labels, "quality", per_class, max_chars, id_col, text_col))


def quality(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, n_bad_lines of every row of ``docs``; whole texts.

    A null or empty text is one empty line. Null ids are not held out; repeated rows are scored one by one; other columns
    are ignored whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "text", max_bytes=1 << 20):
                found, n_lines, bad = raw_scores(part.column("text").to_pylist(), model)
                s = 1 / (1 + np.exp(-(model.a * _logit(found) + model.b)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array(n_lines), pa.array(bad)], ["doc_id", "held_out", "score", "n_lines", "n_bad_lines"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double, n_lines long, n_bad_lines long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_lines", "n_bad_lines")
