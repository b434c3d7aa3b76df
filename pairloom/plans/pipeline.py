"""The batch pipeline: gold, splits, predict pairs, train, test, predict. Stages meet in files and run alone or all.

    python -m pairloom.plans.pipeline --config datasets.yaml --dataset NAME [--stage all]
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import char_ngrams, record_text
from ..operators import blocking, encode, metrics, pairs, sampling, scoring, tfidf, vectors
from ..sources.readers import Dataset, load_dataset, read_csv, read_pairs
from ..sources.writers import write_csv, write_json, write_pairs, write_report
from .gold import build_gold

FEATURES = ["f_words", "f_grams", "f_edit", "f_length"]


def _tfidf(records: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    counts = tfidf.term_counts(records, "id", "text")
    w = tfidf.weights(counts, tfidf.vocabulary(counts, records.count()))
    return tfidf.topk(w.join(anchors.select("id"), "id", "left_semi"), w, k, exclude_self=True)


def _ngram(records: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    return blocking.shared_key_topk(records, char_ngrams(F.col("text"), 3), k).join(anchors.select(F.col("id").alias("i")), "i", "left_semi")


def _dense(records: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    v = encode.hashed_tfidf(records)
    return vectors.dense_topk(v, k, anchors=v.join(anchors.select("id"), "id", "left_semi"))


def _ann(records: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    v = encode.hashed_tfidf(records).persist()
    cells = max(1, min(4096, int(v.count() ** 0.5)))
    centroids = vectors.kmeans_centroids(v, cells, 64 * cells)
    asking = v.join(anchors.select("id"), "id", "left_semi")
    probes, _ = vectors.probes_for(v, k, centroids, asking)
    return vectors.cell_topk(v, k, centroids, max(probes, cells // 4), anchors=asking)


STRATEGIES = {"tfidf": _tfidf, "ngram": _ngram, "dense": _dense, "ann": _ann}


def candidates(strategy: str, records: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """i, j candidate pairs of ``records`` (id, text) by the named strategy."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; one of {sorted(STRATEGIES)}")
    return STRATEGIES[strategy](records, anchors, k).select("i", "j")


def _gold(spark: SparkSession, d: Dataset) -> DataFrame:
    gold = spark.read.parquet(d.gold)
    return gold.select("id", F.col(d.canonical_col).alias("cluster"), F.col("record_text").alias("text"))


def gold(spark: SparkSession, d: Dataset) -> None:
    standard = read_csv(spark, d.standard, multi_line=d.multi_line) if d.standard else None
    out = build_gold(read_csv(spark, d.raw, multi_line=d.multi_line), standard, list(d.text_fields), d.canonical_col, d.raw_key, d.standard_key)
    out = sampling.with_rank(out, d.seed, [d.canonical_col, *dict.fromkeys(d.text_fields)], name="id")
    out.write.mode("overwrite").parquet(d.gold)


def splits(spark: SparkSession, d: Dataset) -> None:
    records = _gold(spark, d)
    chosen = sampling.anchors(records, d.target_pairs, d.top_k, d.seed, "id")
    found = pairs.label_by_cluster(candidates(d.strategy, records, chosen, d.top_k), records.select("id", "cluster"))
    done = sampling.random_split(found, d.seed, ["i", "j"], d.train, d.valid)
    write_pairs(pairs.lookup_texts(done, records.select("id", "text")), f"{d.out}/splits")


def predict_pairs(spark: SparkSession, d: Dataset) -> None:
    new = read_csv(spark, d.predict, multi_line=d.multi_line)
    if new.isEmpty():
        raise ValueError("nothing to predict")
    have = [F.coalesce(F.col(f), F.lit("")).alias(f) if f in new.columns else F.lit("").alias(f) for f in d.text_fields]
    asked = sampling.with_rank(new.select(*have), d.seed, list(dict.fromkeys(d.text_fields)), name="id").select("id", record_text(list(d.text_fields)).alias("text"))
    records = _gold(spark, d)
    both = tfidf.term_counts(asked.select((-1 - F.col("id")).alias("id"), "text").union(records.select("id", "text")), "id", "text")
    w = tfidf.weights(both, tfidf.vocabulary(both, asked.count() + records.count()))
    top = tfidf.topk(w.filter("id < 0"), w.filter("id >= 0"), d.top_k)
    texts = top.join(asked.select((-1 - F.col("id")).alias("i"), F.col("text").alias("text1")), "i").join(records.select(F.col("id").alias("j"), F.col("text").alias("text2")), "j")
    write_pairs(texts, f"{d.out}/predict_pairs", label=0, by=None)


def _read_split(spark: SparkSession, d: Dataset, split: str) -> DataFrame:
    return read_pairs(spark, f"{d.out}/splits/split={split}").withColumnsRenamed({"left": "text1", "right": "text2"})


def train(spark: SparkSession, d: Dataset) -> None:
    sets = [scoring.pair_features(_read_split(spark, d, s)) for s in ("train", "valid")]
    model, got = scoring.train(*sets, FEATURES)
    model.write().overwrite().save(f"{d.out}/model")
    write_json(spark.createDataFrame([got]), f"{d.out}/train_metrics")


def _scored(spark: SparkSession, d: Dataset, rows: DataFrame) -> DataFrame:
    return scoring.score(PipelineModel.load(f"{d.out}/model"), scoring.pair_features(rows)).drop(*FEATURES)


def test(spark: SparkSession, d: Dataset) -> None:
    out = _scored(spark, d, _read_split(spark, d, "test"))
    write_csv(out, f"{d.out}/test")
    write_report(metrics.confusion(out), f"{d.out}/test_report")


def predict(spark: SparkSession, d: Dataset) -> None:
    rows = read_pairs(spark, f"{d.out}/predict_pairs", "score").withColumnsRenamed({"left": "text1", "right": "text2"})
    out = _scored(spark, d, rows)
    write_csv(out, f"{d.out}/predict")
    write_report(metrics.probability_summary(out), f"{d.out}/predict_report")


STAGES = {"gold": gold, "splits": splits, "predict_pairs": predict_pairs, "train": train, "test": test, "predict": predict}


def run(spark: SparkSession, d: Dataset, stage: str = "all") -> None:
    if stage != "all" and stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; all or one of {list(STAGES)}")
    for name, f in STAGES.items():
        if stage in ("all", name):
            f(spark, d)


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--config", required=True)
    p.add_argument("--dataset", required=True)
    p.add_argument("--stage", default="all")
    a = p.parse_args()
    run(SparkSession.builder.getOrCreate(), load_dataset(a.config, a.dataset), a.stage)


if __name__ == "__main__":
    main()
