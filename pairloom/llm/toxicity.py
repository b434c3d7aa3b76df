"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Method: the features are which character n-grams (lower-cased, hashed) a text holds. Each is scaled by its log-count
ratio r = log of its smoothed share among toxic over that among clean training documents; a logistic regression is
trained on the scaled features. The n-grams with the largest ratios by weight of evidence are kept.

Scale: the model is a fixed number of weights. Scoring is one pass without an exchange: whole texts, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .linear import held_out, labelled_sample, lbfgs, log_loss

_BITS = 22
_GRAMS = (3, 4, 5)
_GAP = max(_GRAMS) - 1
_WINDOW = 1 << 17


@dataclass
class Model:
    slots: object  # hashed n-grams, sorted
    weights: object  # ratio times regression weight
    bias: float


def hashed_grams(texts: list[str]):
    """(first positions of the texts, for each n of ``_GRAMS`` the hashes of all character n-grams, from every position).

    Texts are lower-cased and apart: n-grams see both ends of their text but never two texts, and those that begin up to
    ``_GAP`` places before a text's first position are its own.
    """
    import numpy as np

    low = [t.lower() for t in texts]
    first = np.cumsum(np.r_[_GAP, np.fromiter(map(len, low), np.int64, len(low)) + _GAP])[:-1]
    joined = "\0" * _GAP + ("\0" * _GAP).join(low) + "\0" * _GAP
    h = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4") * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h += np.uint32(1)
    roll, out = h, []
    for n in range(2, max(_GRAMS) + 1):
        roll = roll[:-1] * np.uint32(0x2C1B3C6D) + h[n - 1 :]
        if n in _GRAMS:
            mixed = roll ^ (roll >> np.uint32(16))
            mixed *= np.uint32(0x85EBCA6B)
            mixed >>= np.uint32(32 - _BITS)
            out.append(mixed)
    return first, out


def _held(texts: list[str], wanted):
    """(document, hash) pairs, each once: the n-grams in each text whose hash is ``wanted`` (packed bits by hash).

    A text longer than ``_WINDOW`` is looked at in windows that overlap by an n-gram, so memory does not grow with it.
    """
    import numpy as np

    whole = [i for i, t in enumerate(texts) if len(t) <= _WINDOW]
    kind = np.uint32 if len(texts) <= 1 << 32 - _BITS else np.int64
    pairs = [_found([texts[i] for i in whole], wanted, np.array(whole, kind))] if whole else []
    for i in np.flatnonzero([len(t) > _WINDOW for t in texts]).tolist():
        t, own = texts[i].lower(), np.zeros(0, kind)
        for at in range(0, len(t), _WINDOW):
            part = t[max(0, at - _GAP) : at + _WINDOW]
            own = _distinct(np.r_[own, _found([part], wanted, np.array([i], kind), at > 0, at + _WINDOW < len(t))])
        pairs.append(own)
    both = _distinct(np.concatenate(pairs))
    return (both >> _BITS).astype(np.int64), (both & ((1 << _BITS) - 1)).astype(np.int64)


def _distinct(x):
    """Sorted values, each once; sorting 32 or 64 bits is far quicker than ``np.unique``'s hashing."""
    import numpy as np

    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _found(texts: list[str], wanted, numbers, cut_before: bool = False, cut_behind: bool = False):
    """``numbers`` of the texts and wanted hashes in them, packed; a cut end of a window is no end of a text."""
    import numpy as np

    first, grams = hashed_grams(texts)
    out = []
    for slot in grams:
        if cut_before or cut_behind:
            slot = slot[_GAP if cut_before else 0 : len(slot) - _GAP if cut_behind else len(slot)]
        at = np.flatnonzero(wanted[slot >> np.uint32(3)] >> (slot & np.uint32(7)).astype(np.uint8) & 1)
        doc = np.searchsorted(first - _GAP, at, "right") - 1 if len(texts) > 1 else np.zeros(len(at), np.int64)
        out.append(numbers[doc] << np.uint8(_BITS) | slot[at])
    return np.concatenate(out)


def _flags(slots):
    """A bit for each hash, set for ``slots``."""
    import numpy as np

    on = np.zeros(1 << _BITS, np.uint8)
    on[slots] = 1
    return np.packbits(on, bitorder="little")


def train(texts: list[str], y, weight, features: int = 2000, smooth: float = 1.0, l2: float = 2.0) -> Model:
    """Fit the ratios and the regression; defaults by validation within the training folds."""
    import numpy as np

    if not len(texts) or y.min() == y.max():  # nothing to tell apart: the share of toxic rows
        share = float(np.average(y, weights=weight)) if len(texts) else 0.0
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    counts = np.zeros((2, 1 << _BITS), np.int64)
    every = _flags(slice(None))
    for k in range(0, len(texts), 64):
        doc, slot = _held(texts[k : k + 64], every)
        toxic = y[k + doc] == 1
        for c in (0, 1):
            counts[c] += np.bincount(slot[toxic == c], minlength=1 << _BITS)
    q, p = counts
    ratio = np.log((p + smooth) / (y.sum() + 2 * smooth)) - np.log((q + smooth) / ((1 - y).sum() + 2 * smooth))
    gain = np.where(p + q >= 3, np.abs(ratio) * np.sqrt(p + q), 0)
    chosen = np.sort(np.argpartition(-gain, min(features, len(gain) - 1))[:features])
    chosen = chosen[gain[chosen] > 0]
    wanted = _flags(chosen)
    held = [_held(texts[k : k + 64], wanted) for k in range(0, len(texts), 64)]
    doc = np.concatenate([d + 64 * k for k, (d, _) in enumerate(held)])
    f = np.searchsorted(chosen, np.concatenate([s for _, s in held]))
    r = ratio[chosen]

    def loss(w):
        z = np.bincount(doc, (r * w[:-1])[f], len(y)) + w[-1]
        v, d = log_loss(z, y, weight)
        g = np.append(r * np.bincount(f, d[doc], len(chosen)), d.sum())
        g[:-1] += l2 * w[:-1]
        return v + l2 / 2 * float(w[:-1] @ w[:-1]), g

    w = lbfgs(loss, np.zeros(len(chosen) + 1), rounds=40)
    return Model(chosen, w[:-1] * r, float(w[-1]))


def score(texts: list[str], model: Model):
    """Probabilities that the whole ``texts`` are toxic."""
    import numpy as np

    if not texts:
        return np.zeros(0)
    doc, slot = _held(texts, _flags(model.slots))
    z = np.full(len(texts), model.bias)
    if len(doc):
        z += np.bincount(doc, model.weights[np.searchsorted(model.slots, slot)], len(texts))
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on at most ``per_class`` labelled rows and ``max_chars`` characters of each class, from the training folds alone."""
    return train(*labelled_sample(docs, labels, "toxic", per_class, max_chars, id_col, text_col))


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; whole texts.

    A null or empty text has the score of a text without any known n-gram. Null ids are not held out; repeated rows are
    scored one by one; other columns are ignored whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, 1 << 18):
                found = score(part.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(found)], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; nothing is exchanged.

    Edge cases are those of ``toxicity``: nulls and empty texts score alike, rows that repeat an id are judged one by
    one, column names are free and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            whole = batch.set_column(batch.schema.get_field_index(text_col), text_col, pc.fill_null(batch.column(text_col), ""))
            found = [score(part.column(text_col).to_pylist(), model) for part in slices(whole, text_col, 1024, 1 << 18)]
            clean = [bool(x < threshold) for s in found for x in s]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
