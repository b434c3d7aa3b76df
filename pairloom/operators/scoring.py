"""Pair scorers: pair features and a Spark ML classifier chosen by validation F1."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import char_ngrams, word_tokens
from .metrics import confusion


def pair_features(pairs: DataFrame, text1: str = "text1", text2: str = "text2") -> DataFrame:
    """``pairs`` with word and 3-gram Jaccard similarity, relative edit distance of the whole texts and length ratio."""
    a, b = F.coalesce(F.col(text1), F.lit("")), F.coalesce(F.col(text2), F.lit(""))
    jac = lambda x, y: F.when(F.size(F.array_union(x, y)) == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    edit = 1 - F.levenshtein(a, b) / longest
    return pairs.withColumns({"f_words": jac(word_tokens(a), word_tokens(b)), "f_grams": jac(char_ngrams(a, 3), char_ngrams(b, 3)), "f_edit": edit, "f_length": F.least(F.length(a), F.length(b)) / longest})


def train(train_set: DataFrame, valid_set: DataFrame, features: list[str], threshold: float = 0.5, grid=(0.0, 0.01, 0.1)) -> tuple[PipelineModel, dict]:
    """The classifier of the regularisation with the best validation F1, and its metrics; ties go to the first."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    train_set, valid_set = train_set.persist(), valid_set.persist()
    best, kept = -1.0, None
    for reg in grid:
        model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), LogisticRegression(regParam=reg, labelCol="label")]).fit(train_set)
        got = confusion(score(model, valid_set, threshold)).first().asDict()
        if got["f1"] > best:
            best, kept = got["f1"], (model, got | {"regularisation": reg, "threshold": threshold})
    train_set.unpersist()
    valid_set.unpersist()
    return kept


def score(model: PipelineModel, pairs: DataFrame, threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """``pairs`` with prob and pred."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(pairs).withColumn("prob", vector_to_array("probability")[1])
    over = F.col("prob") > threshold if strict else F.col("prob") >= threshold
    return out.withColumn("pred", over.cast("int")).select(*pairs.columns, "prob", "pred")


def score_texts(model: PipelineModel, spark, texts: list[tuple[str, str]], threshold: float = 0.5) -> list[tuple[float, int]]:
    """(probability, decision) of each of a few pairs of texts, in their order."""
    rows = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(texts)], "n long, text1 string, text2 string")
    return [(r["prob"], r["pred"]) for r in score(model, pair_features(rows), threshold).orderBy("n").collect()]


def train_epochs(train_set: DataFrame, valid_set: DataFrame, features: list[str], epochs: int = 3, warm_up: float = 0.1, augment: bool = False, threshold: float = 0.5, seed: int = 7) -> tuple[PipelineModel, DataFrame]:
    """(the best epoch's model; epoch, loss, f1, precision, recall, accuracy on ``valid_set`` of every epoch).

    An epoch continues the optimiser for as many rounds as the schedule gives it: they rise linearly over the
    ``warm_up`` share of epochs. ``augment`` trains on the pairs with a span of words deleted as well (text1, text2 must
    be among the columns). The best epoch has the largest F1, the first of equals; F1 0 counts.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    if augment:
        cut = pair_features(span_deleted(train_set.drop(*features), seed)).select(*train_set.columns)
        train_set = train_set.unionByName(cut)
    train_set, valid_set = train_set.persist(), valid_set.persist()
    best, kept, seen, rounds = -1.0, None, [], 0
    for epoch in range(1, epochs + 1):
        rounds += max(1, round(10 * min(1.0, epoch / max(1.0, warm_up * epochs))))
        model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), LogisticRegression(labelCol="label", maxIter=rounds)]).fit(train_set)
        out = score(model, valid_set, threshold)
        p = F.greatest(F.lit(1e-12), F.when(F.col("label") == 1, F.col("prob")).otherwise(1 - F.col("prob")))
        got = confusion(out).first().asDict() | {"epoch": epoch, "loss": out.agg(F.avg(-F.log(p))).first()[0]}
        seen.append(tuple(got[c] for c in ("epoch", "loss", "f1", "precision", "recall", "accuracy")))
        if got["f1"] > best:
            best, kept = got["f1"], model
    train_set.unpersist()
    valid_set.unpersist()
    return kept, train_set.sparkSession.createDataFrame(seen, "epoch int, loss double, f1 double, precision double, recall double, accuracy double")


def span_deleted(pairs: DataFrame, seed: int, text: str = "text1", span: int = 2) -> DataFrame:
    """Augmentation: ``pairs`` with ``span`` consecutive words of ``text`` deleted at a hashed place."""
    words = F.split(F.col(text), " ")
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(text)), F.greatest(F.size(words) - span, F.lit(1)).cast("long"))
    kept = F.filter(words, lambda w, i: (i < at) | (i >= at + span))
    return pairs.withColumn(text, F.when(F.size(words) > span, F.concat_ws(" ", kept)).otherwise(F.col(text)))
