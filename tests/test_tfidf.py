"""TF-IDF neighbours by blocks that meet once."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.operators import tfidf

SQL = """WITH s AS (SELECT a.id AS i, b.id AS j, round(sum(a.weight * b.weight), 6) AS score FROM a JOIN b ON a.term = b.term AND {} GROUP BY 1, 2)
  SELECT i, j, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM s QUALIFY rank <= 4"""


def _made(n: int, seed: int) -> pa.Table:
    rng = np.random.default_rng(seed)
    # frequent and rare terms; weights with few values, so many scores are equal
    rows = [(i, f"t{t}", float(rng.integers(1, 4)) / 8) for i in range(n) for t in sorted(set(np.minimum(rng.zipf(1.3, 12), 400).tolist()))]
    return pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "term": [r[1] for r in rows], "weight": [r[2] for r in rows]})


def test_two_blocks_meet_once(monkeypatch):
    t, calls, whole = _made(90, 3), [], tfidf._Block.scores
    monkeypatch.setattr(tfidf._Block, "scores", lambda self, other: calls.append((self, other)) or whole(self, other))
    blocks = [tfidf._pack(part.append_column("block", pa.array([b] * len(part)))) for b in range(3) if (part := t.filter(pa.array(np.asarray(t["id"]) % 3 == b)))]
    rows = []
    for x, left in enumerate(blocks):
        for y, right in enumerate(blocks):
            one = [left[c] if y == 0 else pa.nulls(1, left[c].type) for c in tfidf._NAMES]
            two = [right[c] if x == 0 else pa.nulls(1, right[c].type) for c in tfidf._NAMES]
            rows += pa.table([left["block"], right["block"], *one, *two], ["block", "_block", *tfidf._NAMES, *(f"_{c}" for c in tfidf._NAMES)]).to_batches()
    found = pa.Table.from_batches(list(tfidf._stream(4, True, True)(rows)))
    assert len(calls) == 6  # of nine pairs of blocks, each a tile before
    best = {}
    for r in found.to_pylist():
        best.setdefault(r["i"], set()).add((-r["score"], r["j"]))
    con = duckdb.connect()
    con.register("a", t), con.register("b", t)
    expected = {}
    for i, j, score, _ in con.execute(SQL.format("a.id <> b.id")).fetchall():
        expected.setdefault(i, []).append((-score, j))
    assert {i: sorted(x)[:4] for i, x in best.items()} == {i: sorted(x) for i, x in expected.items()}


@pytest.mark.parametrize("same", [True, False])
def test_topk_as_sql(spark, monkeypatch, same):
    monkeypatch.setattr(tfidf, "_FEW_DOCS", 100 if same else 8192)
    a, b = _made(200, 4), _made(150, 5)
    b = a if same else b
    usual = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    left = spark.createDataFrame(a.to_pylist(), "id long, term string, weight double")
    right = left if same else spark.createDataFrame(b.to_pylist(), "id long, term string, weight double")
    got = tfidf.topk(left, right, 4, exclude_self=same, block=23).select("i", "j", F.col("score"), "rank").collect()
    con = duckdb.connect()
    con.register("a", a), con.register("b", b)
    assert sorted(map(tuple, got)) == sorted(con.execute(SQL.format("a.id <> b.id" if same else "true")).fetchall())
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == usual
