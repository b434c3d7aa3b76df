"""Composite builders: from records to labelled, split pairs, by the way candidates are found.

Records are (id, text, cluster) unless stated; candidates are (i, j). Builders return DataFrames, which
``sources.writers.write_pairs`` stores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import char_ngrams, record_text, word_tokens
from ..operators import blocking, encode, pairs, sampling, scoring, vectors

Encoder = Callable[[DataFrame], DataFrame]


def ngram_candidates(records: DataFrame, n: int = 3, block_cap: int | None = 1000, seed=7) -> DataFrame:
    """i, j (i < j) of records that share a character n-gram."""
    return blocking.key_block_pairs(records, char_ngrams(F.col("text"), n), seed, block_cap)


def token_candidates(records: DataFrame, block_cap: int | None = 1000, seed=7) -> DataFrame:
    """i, j (i < j) of records that share a word."""
    return blocking.key_block_pairs(records, word_tokens(F.col("text")), seed, block_cap)


def dense_candidates(records: DataFrame, k: int = 5, encoder: Encoder = encode.hashed_tfidf, threshold: float | None = None) -> DataFrame:
    """i, j of each record's ``k`` nearest, of those with a cosine of ``threshold`` or more."""
    found = vectors.dense_topk(encoder(records), k)
    return (found if threshold is None else found.filter(F.col("score") >= threshold)).select("i", "j")


def hybrid_pairs(records: DataFrame, mode: str = "union", k: int = 5, ratio: float | None = None, seed=7, block_cap: int | None = 1000, encoder: Encoder = encode.hashed_tfidf) -> DataFrame:
    """i, j, label, split of n-gram and nearest-vector candidates, ``union`` or ``intersection``, or one (``first``: n-grams, ``second``: vectors).

    A pair matches if both clusters are the same and not empty. ``ratio`` keeps all matches and so many other pairs that
    matches are that share; all of them if there are fewer.
    """
    grams, near = ngram_candidates(records, block_cap=block_cap, seed=seed), dense_candidates(records, k, encoder)
    found = grams if mode == "first" else pairs.unordered(near) if mode == "second" else pairs.combine(grams, near, mode)
    labelled = pairs.label_by_cluster(found, records.select("id", "cluster"), "equal_nonempty")
    if ratio:
        labelled = sampling.ratio_resample(labelled, ratio, seed, ["i", "j"])
    return sampling.stratified_split(labelled, seed, ["i", "j"])


def pool_pairs(records: DataFrame, truth: DataFrame, anchors: DataFrame, k: int, seed=7, encoder: Encoder = encode.hashed_tfidf) -> DataFrame:
    """i, j, label, split: each anchor's (id) ``k`` nearest of the pool ``records`` (id, text); label 1 if in ``truth`` (i, j)."""
    v = encoder(records)
    found = vectors.dense_topk(v, k, anchors=v.join(anchors.select("id").distinct(), "id", "left_semi")).select("i", "j")
    return sampling.guarded_split(pairs.label_by_truth(found, truth), seed, ["i", "j"])


def two_table_pairs(a: DataFrame, b: DataFrame, truth: DataFrame, k: int, seed=7, encoder: Encoder = encode.hashed_tfidf) -> tuple[DataFrame, DataFrame]:
    """(pairs i, j, label, split; pool id, table, own_id, text) of two tables (id, text) as one pool.

    Rows in ``truth`` (a, b: ids in their own tables) are the anchors. A pair across the tables matches if it is in
    ``truth``, whichever side asked; a pair within a table never does. Pool ids are 2 * id for ``a``, 2 * id + 1 for ``b``.
    """
    side = lambda df, t: df.select((F.col("id") * 2 + t).cast("long").alias("id"), F.lit("ab"[t]).alias("table"), F.col("id").alias("own_id"), "text")
    pool = side(a, 0).unionByName(side(b, 1))
    known = truth.select((F.col("a") * 2).cast("long").alias("i"), (F.col("b") * 2 + 1).cast("long").alias("j")).distinct()
    return pool_pairs(pool, known, known.select(F.explode(F.array("i", "j")).alias("id")), k, seed, encoder), pool


def imported_pairs(rows: DataFrame, left: str = "ltable.", right: str = "rtable.", label: str = "label", seed=7, key: str = "id") -> DataFrame:
    """text1, text2, label, split (60 / 20 / 20, one of train and valid at least) of a table of labelled pairs.

    The sides are the columns that start with ``left`` and ``right``; rows whose label is no whole number are dropped.
    """
    part = lambda p: record_text([c for c in rows.columns if c.startswith(p) and c.removeprefix(p) != "id"], p)
    made = rows.select(F.col(f"`{key}`").alias("_key"), part(left).alias("text1"), part(right).alias("text2"), F.expr(f"try_cast(trim(`{label}`) as int)").alias("label")).filter(F.col("label").isNotNull())
    return sampling.random_split(made, seed, ["_key"], 0.6, 0.2, least=1).drop("_key")


def quota_queries(records: DataFrame, test: DataFrame, n: int, k: int, seed=7, pool: int | None = None, encoder: Encoder = encode.hashed_tfidf) -> DataFrame:
    """i, j, score, is_match, rank: quota retrieval for ``n`` random records of clusters that have no record in ``test`` (i, j).

    The quotas are filled from the ``pool`` nearest: 10 * k, 5000 at least, if not given.
    """
    allowed = pairs.exclude_clusters(records.select("id", "cluster"), test)
    asked = sampling.take(allowed, n, seed, ["id"])
    v = encoder(records)
    near = vectors.dense_topk(v, pool or max(10 * k, 5000), anchors=v.join(asked.select("id"), "id", "left_semi"))
    return pairs.quota_topk(pairs.label_by_cluster(near, records.select("id", "cluster")).withColumnRenamed("label", "is_match"), k)


def diverse_pairs(records: DataFrame, n: int, bins: int, k: int, seed=7, encoder: Encoder = encode.hashed_tfidf) -> DataFrame:
    """i, j, label, split: neighbours of one record each of ``n`` clusters spread over sizes; cluster 0 never matches."""
    sizes = records.filter("cluster is not null").groupBy("cluster").agg(F.count("*").alias("n"))
    chosen = sampling.diverse_clusters(sizes, n, bins, seed)
    first = sampling.take(records.join(chosen, "cluster", "left_semi").select("id", "cluster"), 1, seed, ["id"], ["cluster"])
    v = encoder(records)
    near = vectors.dense_topk(v, k, anchors=v.join(first.select("id"), "id", "left_semi")).select("i", "j")
    return sampling.stratified_split(pairs.label_by_cluster(near, records.select("id", "cluster"), "equal_nonzero"), seed, ["i", "j"])


def ann_pairs(records: DataFrame, k: int, target: int | None = None, seed=7, encoder: Encoder = encode.hashed_tfidf, centroids: DataFrame | None = None, probes: int | None = None, anchors: DataFrame | None = None) -> DataFrame:
    """i, j (i < j), label, split: approximate neighbours, each pair once, ``target`` of them by hash if given.

    Cells and probes are chosen as in the batch pipeline if not given: the least probes with a measured recall of 0.9.
    """
    v = encoder(records)
    asking = v if anchors is None else v.join(anchors.select("id"), "id", "left_semi")
    if centroids is None:
        cells = max(1, min(4096, int(v.count() ** 0.5)))
        centroids = vectors.kmeans_centroids(v, cells, 64 * cells, seed)
    probes = probes or vectors.probes_for(v, k, centroids, asking, seed=seed)[0]
    found = pairs.unordered(vectors.cell_topk(v, k, centroids, probes, anchors=asking))
    found = found if target is None else sampling.take(found, target, seed, ["i", "j"])
    return sampling.guarded_split(pairs.label_by_cluster(found, records.select("id", "cluster")), seed, ["i", "j"])


def quota_report(records: DataFrame, chosen: DataFrame, model, name: str = "name") -> DataFrame:
    """query and candidate names, texts, score, is_match, prob, pred of quota retrieval's rows, by a trained scorer.

    ``records``: id, text and ``name``; ``chosen`` as ``quota_queries`` gives it.
    """
    a, b = records.select(F.col("id").alias("i"), F.col(name).alias("query_name")), records.select(F.col("id").alias("j"), F.col(name).alias("candidate_name"))
    made = scoring.pair_features(pairs.lookup_texts(chosen, records.select("id", "text")).join(a, "i").join(b, "j"))
    return scoring.score(model, made).select("i", "j", "rank", "query_name", "candidate_name", "text1", "text2", "score", "is_match", "prob", "pred")


def compare(train_sets: dict[str, DataFrame], valid: DataFrame, test: DataFrame, features: list[str]) -> DataFrame:
    """name, tp, ... f1, accuracy on ``test`` of a classifier trained on each train set with the same ``valid``.

    Sets are pair features with ``label``. The loop is over the named sets, a handful.
    """
    from ..operators.metrics import confusion

    out = None
    for name, rows in train_sets.items():
        model, _ = scoring.train(rows, valid, features)
        got = confusion(scoring.score(model, test)).select(F.lit(name).alias("name"), "*")
        out = got if out is None else out.unionByName(got)
    return out
