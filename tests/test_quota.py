"""Quota retrieval without the pool of nearest rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import pairs, quota, vectors
from pairloom.plans.queries import QUERIES


def test_the_pool_is_not_passed_on(spark, monkeypatch):
    seen, whole = [], pairs.quota_topk
    monkeypatch.setattr(pairs, "quota_topk", lambda scored, k: seen.append(scored.count()) or whole(scored, k))
    QUERIES["quota_topk"](spark, "/root/testdata/sf0.01")
    assert seen == [500 * 20]  # ten of each kind; 500 * 499 rows of the pool before


@pytest.mark.parametrize("pool", [15, 40, 5000])
def test_candidates_are_those_of_the_pool(spark, monkeypatch, pool):
    rng = np.random.default_rng(8)
    # small whole numbers: many scores are equal; kind 9 is rare, so its rows lie beyond the pool
    made = [(n, [float(x) for x in rng.integers(-2, 3, 6)], None if n % 50 == 3 else 9 if n % 60 == 5 else n % 3) for n in range(300)]
    made += [(n, made[n % 7][1], n % 2) for n in range(300, 340)] + [(400, [0.0] * 6, 1), (401, [1.0, 2.0], 1), (402, [2.0, 1.0], 1), (403, None, 1), (None, [1.0] * 6, 1)]
    df = spark.createDataFrame(made, "id long, vec array<double>, cluster long")
    near = pairs.label_by_cluster(vectors.dense_topk(df.select("id", "vec"), pool), df.select("id", "cluster")).withColumnRenamed("label", "is_match")
    expected = pairs.quota_topk(near, 10).collect()
    monkeypatch.setattr(quota, "_ROWS", 16)
    got = pairs.quota_topk(quota.candidates(df, 10, pool, block=70), 10).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
    again = df.unionByName(df.filter("id < 5"))
    near = pairs.label_by_cluster(vectors.dense_topk(again.select("id", "vec"), pool), again.filter("id is not null and vec is not null").select("id", "cluster")).withColumnRenamed("label", "is_match")
    assert quota.candidates(again, 10, pool).agg(F.count("*"), F.sum("j")).first() == near.agg(F.count("*"), F.sum("j")).first()
