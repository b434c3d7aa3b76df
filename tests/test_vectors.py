"""Scores of vectors as DuckDB's list_cosine_similarity and round give them, to the last bit."""

import duckdb
import numpy as np

from pairloom.operators import copies, encode, vectors


def test_scores_round_as_in_sql(spark):
    rng = np.random.default_rng(5)
    # small whole numbers: many cosines lie on a border of the sixth place or are equal
    made = [(n, [float(x) for x in rng.integers(-2, 3, 8)]) for n in range(300)] + [(n, [float(x) for x in 3e-4 * rng.standard_normal(8)]) for n in range(300, 360)]
    made = [r for r in made if any(r[1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE v (id BIGINT, e DOUBLE[])")
    con.executemany("INSERT INTO v VALUES (?, ?)", made)
    expected = con.execute("""WITH s AS (SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.id <> b.id)
      SELECT i, j, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM s QUALIFY rank <= 5""").fetchall()
    df = spark.createDataFrame(made, "id long, vec array<double>")
    got = vectors.dense_topk(df, 5, block=100).select("i", "j", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert vectors.round6(np.array([2.5e-6, -2.5e-6, 0.4e-6, -0.4e-6])).tolist() == [3e-6, -3e-6, 0.0, 0.0]


def test_equal_vectors_are_compared_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    kinds = [[float(x) for x in rng.standard_normal(4)] for _ in range(12)] + [[0.0] * 4]
    made = [(n, kinds[n * n % 13]) for n in range(200)] + [(200, [1.0, 2.0]), (201, None)]
    df = spark.createDataFrame(made, "id long, vec array<double>")
    plain = vectors.dense_topk(df, 4, anchors=df).select("i", "j", "score", "rank").collect()
    seen = []
    whole = copies.neighbours
    monkeypatch.setattr(copies, "neighbours", lambda found, of, k: seen.append(of.filter("id = rep").count()) or whole(found, of, k))
    got = vectors.dense_topk(df, 4).select("i", "j", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))
    assert seen == [len({n * n % 13 for n in range(200)}) + 1]


def test_encoded_texts_are_stored_once(spark):
    records = spark.createDataFrame([(n, ["red dog", "blue cat", ""][n % 3]) for n in range(30)], "id long, text string")
    v = encode.hashed_tfidf(records)
    assert "Exchange" not in v._jdf.queryExecution().executedPlan().toString()  # a search reads them many times
    got = vectors.dense_topk(v, 2)
    near = {n: [j for j in range(n % 3, 30, 3) if j != n][:2] for n in range(30) if n % 3 < 2}
    found = sorted((r["i"], r["rank"], r["j"]) for r in got.collect() if r["i"] in near)
    assert found == sorted((n, r, j) for n, js in near.items() for r, j in enumerate(js, 1))
