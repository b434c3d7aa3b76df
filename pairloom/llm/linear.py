"""Small numeric tools for the trained operators: L-BFGS, the labelled sample and the split by folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lbfgs(f, x, rounds: int = 60, memory: int = 8, tol: float = 1e-5):
    """Minimise ``f`` (returns value and gradient) from ``x`` by limited-memory BFGS with backtracking."""
    import numpy as np

    value, g = f(x)
    steps = []
    for _ in range(rounds):
        if np.abs(g).max() < tol:
            break
        d, parts = -g, []
        for s, y, rho in reversed(steps):
            a = rho * (s @ d)
            d = d - a * y
            parts.append(a)
        if steps:
            s, y, _ = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(steps, reversed(parts), strict=True):
            d = d + s * (a - rho * (y @ d))
        slope, step = g @ d, 1.0 if steps else min(1.0, 1.0 / max(1e-12, np.abs(g).sum()))
        if slope >= 0:
            steps, d, slope = [], -g, -(g @ g)
        for _ in range(30):
            new = x + step * d
            v, ng = f(new)
            if v <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = new - x, ng - g
        if s @ y > 1e-12:
            steps = [*steps[-memory + 1 :], (s, y, 1.0 / (s @ y))]
        done = abs(value - v) <= 1e-9 * max(1.0, abs(value))
        x, value, g = new, v, ng
        if done:
            break
    return x


def log_loss(z, y, weight):
    """Weighted logistic loss and its derivative by ``z``."""
    import numpy as np

    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return float((weight * (np.logaddexp(0, z) - y * z)).sum()), weight * (p - y)


def platt(z, y, weight):
    """(a, b) so that sigmoid(a * z + b) fits the labels."""
    import numpy as np

    def f(x):
        v, d = log_loss(x[0] * z + x[1], y, weight)
        return v + 1e-3 * x[0] ** 2, np.array([d @ z + 2e-3 * x[0], d.sum()])

    return lbfgs(f, np.array([1.0, 0.0]))


def held_out(id_col: str, fold: int = 2, folds: int = 4) -> Column:
    """Whether the row's id, as text, falls into the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, id_col: str = "doc_id", text_col: str = "text"):
    """(texts, labels, weights) on the driver: of each class the ``per_class`` training rows first by a hash of the id.

    Their texts come in that order until ``max_chars`` characters of a class are reached, which bounds the driver's
    memory. Rows of the held-out fold and rows without label are no training rows. A row's weight is what it stands for
    in its class. An id with several labels counts with the largest, one with several texts with the first in order.
    """
    import numpy as np

    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    first = [known.filter(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    chosen = first[0].union(first[1])  # at most 2 * per_class rows
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    upto = F.sum(F.length("text").cast("long")).over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    got = found.withColumn("upto", upto).filter(F.col("upto") <= max_chars).collect()
    got.sort(key=lambda r: r["id"])
    y = np.array([r["y"] for r in got], np.float64)
    have = np.bincount(y.astype(int), minlength=2)
    weight = np.array([sizes.get(int(c), 0) / max(1, have[int(c)]) for c in y])
    return [r["text"] for r in got], y, weight / max(1e-12, weight.sum()) * len(y)
