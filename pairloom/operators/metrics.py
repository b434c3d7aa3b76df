"""Metrics over scored pairs: one pass of conditional counts each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _counts(y: Column, p: Column) -> list[Column]:
    return [F.count_if((y == a) & (p == b)).alias(n) for n, a, b in (("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0))]


def _scores(df: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return df.withColumns({"precision": F.round(_share(tp, tp + fp), 6), "recall": F.round(_share(tp, tp + fn), 6), "f1": F.round(_share(2 * tp, 2 * tp + fp + fn), 6), "accuracy": F.round(_share(tp + tn, tp + fp + tn + fn), 6)})


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f1, accuracy; empty denominators give 0; a null label counts as 0."""
    y = F.coalesce(F.col(label), F.lit(0))
    return _scores((df.groupBy(*by) if by else df).agg(*_counts(y, F.col(pred))))


def class_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """class, precision, recall, f1, support of the classes 0 and 1."""
    one = confusion(df, label, pred).select(F.explode(F.array(
        F.struct(F.lit(1).alias("class"), F.col("tp").alias("hit"), F.col("fp").alias("wrong"), F.col("fn").alias("missed")),
        F.struct(F.lit(0).alias("class"), F.col("tn").alias("hit"), F.col("fn").alias("wrong"), F.col("fp").alias("missed")),
    )).alias("c")).select("c.*")
    h, w, m = (F.col(c).cast("double") for c in ("hit", "wrong", "missed"))
    return one.select("class", F.round(_share(h, h + w), 6).alias("precision"), F.round(_share(h, h + m), 6).alias("recall"), F.round(_share(2 * h, 2 * h + w + m), 6).alias("f1"), (F.col("hit") + F.col("missed")).alias("support"))


def threshold_table(df: DataFrame, thresholds: list[float], strict: bool, label: str = "label", prob: str = "prob") -> DataFrame:
    """threshold, precision, recall, f1 at each threshold; every row is read once."""
    y, p = F.coalesce(F.col(label), F.lit(0)), F.col(prob)
    cols = []
    for k, t in enumerate(thresholds):
        over = (p > t) if strict else (p >= t)
        cols += [F.count_if((y == 1) & over).alias(f"tp{k}"), F.count_if((y == 0) & over).alias(f"fp{k}"), F.count_if((y == 1) & ~over).alias(f"fn{k}"), F.count_if((y == 0) & ~over).alias(f"tn{k}")]
    row = df.agg(*cols)
    long = row.select(F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), *(F.col(f"{c}{k}").alias(c) for c in ("tp", "fp", "fn", "tn"))) for k, t in enumerate(thresholds)))).alias("r")).select("r.*")
    return _scores(long).select("threshold", "precision", "recall", "f1")


def threshold_search(df: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """The first of the thresholds 0, 0.05, ... 0.95 (strict) with the largest F1; threshold 0.5 and F1 0 if none has any."""
    table = threshold_table(df, [k * 5 / 100 for k in range(20)], True, label, prob)
    best = table.agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    return best.select(F.when(F.col("b.f1") > 0, F.col("b.threshold")).otherwise(0.5).alias("threshold"), F.col("b.f1").alias("f1"))


def probability_summary(df: DataFrame, prob: str = "prob", pred: str = "pred") -> DataFrame:
    """n, n_match, mean, std (sample), quartiles (linear) of the probabilities."""
    p = F.col(prob)
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(pred) == 1).alias("n_match"), F.round(F.avg(p), 6).alias("mean"), F.round(F.stddev_samp(p), 6).alias("std"), *(F.round(F.percentile(p, F.lit(q)), 6).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)))


def histogram(df: DataFrame, value: str, bins: int, by: list[str]) -> DataFrame:
    """``by``, bin (1 to ``bins``, equal width between the smallest and largest value), n."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_ = F.when(F.col("_hi") == F.col("_lo"), 1).otherwise(F.least(F.lit(bins), F.floor((F.col(value) - F.col("_lo")) / width) + 1))
    return df.join(F.broadcast(ends)).withColumn("bin", bin_.cast("int")).groupBy(*by, "bin").agg(F.count("*").alias("n"))


def match_rate(df: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    """n, n_pos, n_neg, pos_rate of each split."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"), F.round(F.avg(F.col(label).cast("double")), 6).alias("pos_rate"))


def participation(df: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    """For each split the mean, median and maximum of positive and negative pairs a record is in, on either side."""
    ends = df.select(by, label, F.explode(F.array("i", "j")).alias("id")).groupBy(by, "id").agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    out = []
    for c in ("pos", "neg"):
        x = F.col(c).cast("double")
        out += [F.round(F.avg(x), 6).alias(f"mean_{c}"), F.percentile(x, F.lit(0.5)).alias(f"median_{c}"), F.max(c).alias(f"max_{c}")]
    return ends.groupBy(by).agg(*out)


def cluster_stats(df: DataFrame, cluster: str, name: str, key: str) -> DataFrame:
    """cluster, n, example (the name of the first row by key)."""
    return df.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("n"), F.min_by(name, key).alias("example"))


def cluster_size_summary(df: DataFrame, cluster: str) -> DataFrame:
    """One row: n_clusters, min_size, max_size, mean_size, median_size; rows without a cluster are left out."""
    sizes = df.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    return sizes.agg(F.count("*").alias("n_clusters"), F.min("n").alias("min_size"), F.max("n").alias("max_size"), F.round(F.avg(n), 6).alias("mean_size"), F.percentile(n, F.lit(0.5)).alias("median_size"))


def label_shuffle(df: DataFrame, seed, label: str = "label", pred: str = "pred") -> DataFrame:
    """real_f1, real_accuracy, shuffled_f1, shuffled_accuracy: the labels permuted by a hash order against the predictions."""
    from .sampling import with_rank

    placed = with_rank(with_rank(df.select("i", "j", label, pred), f"{seed}/a", ["i", "j"], name="_a"), f"{seed}/b", ["i", "j"], name="_b")
    moved = placed.select(F.col("_a").alias("_at"), F.col(label).alias("label")).join(placed.select(F.col("_b").alias("_at"), F.col(pred).alias("pred")), "_at")
    real = confusion(df, label, pred).select(F.col("f1").alias("real_f1"), F.col("accuracy").alias("real_accuracy"))
    other = confusion(moved).select(F.col("f1").alias("shuffled_f1"), F.col("accuracy").alias("shuffled_accuracy"))
    return real.join(F.broadcast(other))  # one row each


def outcome(label: Column, pred: Column) -> Column:
    """TP, FP, FN or TN."""
    return F.when((label == 1) & (pred == 1), "TP").when((label == 0) & (pred == 1), "FP").when((label == 1) & (pred == 0), "FN").otherwise("TN")


def group_quantiles(df: DataFrame, value: str, at=(0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """One row of linear quantiles."""
    return df.agg(*(F.percentile(F.col(value).cast("double"), F.lit(float(q))).alias(f"q{round(q * 100)}") for q in at))
