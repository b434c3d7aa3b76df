"""Searches over rows of equal values: as plain searches by row, at the cost of the distinct values."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as tx
from pairloom.operators import analysis, blocking, overlap, sampling, tfidf


def plain_topk(sets: dict[int, set], k: int) -> list[tuple]:
    out = []
    for i, x in sets.items():
        near = sorted((-len(x & y), j) for j, y in sets.items() if j != i and x & y)[:k]
        out += [(i, j, -s, r) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def test_shared_keys_of_copies(spark, monkeypatch):
    names = ["red dog", "red dig", "blue cat", "", "red dogs", None, "xyz"]
    made = [(n, names[n * 5 % 7 if n % 3 else 0]) for n in range(60)]
    df = spark.createDataFrame(made, "id long, name string")
    asked = []
    topk = tfidf.topk
    monkeypatch.setattr(tfidf, "topk", lambda *a, sizes, **b: asked.append(sizes) or topk(*a, sizes=sizes, **b))
    grams = lambda t: {t[p : p + 3] for p in range(len(t) - 2)} if len(t) > 2 else {t} - {""}
    for k in (1, 5, 70):
        got = blocking.shared_key_topk(df, tx.char_ngrams(F.col("name"), 3), k)
        assert sorted(map(tuple, got.collect())) == plain_topk({i: grams(t or "") for i, t in made}, k)
    assert asked == [(5, 5)] * 3  # texts compared, not rows
    twice = df.unionByName(spark.createDataFrame([(0, "blue cat")], df.schema))  # an id of two texts has the keys of both
    both = {i: grams(t or "") for i, t in made}
    both[0] |= grams("blue cat")
    assert sorted(map(tuple, blocking.shared_key_topk(twice, tx.char_ngrams(F.col("name"), 3), 5).collect())) == plain_topk(both, 5)
    least = blocking.shared_key_topk(df.filter("id in (1, 4, 5, 6, 7)"), tx.word_tokens(F.col("name")), 2, max_block=2)
    kept = {i: set((t or "").split()) for i, t in made if i in (1, 4, 5, 6, 7)}
    often = {w for w in set().union(*kept.values()) if sum(w in x for x in kept.values()) > 2}
    assert sorted(map(tuple, least.collect())) == plain_topk({i: x - often for i, x in kept.items()}, 2)


def test_word_masks_stay_in_their_row(spark):
    made = [(n, " ".join("abcd"[: 1 + n % 4]), "x") for n in range(40)] + [(40, None, "x"), (41, "", None)]
    p = spark.createDataFrame(made, "idx long, text1 string, text2 string")
    got = analysis.mask_importance(p, lambda a, b: a.contains("b").cast("double"), 60)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    weights = {(r["idx"], r["word_pos"]): r["weight"] for r in got.collect()}
    assert set(weights) == {(n, w) for n in range(40) for w in range(1 + n % 4)} | {(41, 0)}
    for (n, w), x in weights.items():
        assert n % 4 == 0 or n >= 40 or (abs(x - (w == 1)) < 0.02), (n, w, x)


def test_large_samples_need_no_single_sort(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("i"), (F.col("id") * 7).alias("j"))
    whole = [tuple(r) for r in df.orderBy(*sampling.hash_order(7, "i", "j")).collect()]
    monkeypatch.setattr(sampling, "FEW", 10)
    for n in (0, 10, 11, 1234, 2999, 3000, 5000):
        got = sampling.take(df, n, 7, ["i", "j"])
        assert sorted(map(tuple, got.collect())) == sorted(whole[:n])
    a, b = sampling.size_matched(df, df.filter("i < 700"), 7, ["i", "j"])
    assert (sorted(map(tuple, a.collect())), b.count()) == (sorted(whole[:700]), 700)


@pytest.mark.parametrize("part", [40, 1000])
def test_many_sets_meet_by_rare_keys(spark, monkeypatch, part):
    draw = random.Random(5)
    made = [(n, f"customer#{draw.randrange(2000):06d} {draw.choice(['red', 'blue', 'green'])}"[: draw.choice([99, 99, 4, 18])]) for n in range(400)]
    made += [(400, "lone words"), (401, "zz"), (402, "other thing"), (403, "zz"), (404, "")]
    grams = lambda t: {t[p : p + 3] for p in range(len(t) - 2)} if len(t) > 2 else {t} - {""}
    df = spark.createDataFrame(made, "id long, name string")
    whole = overlap.topk
    monkeypatch.setattr(blocking, "MANY", 0)
    monkeypatch.setattr(tfidf, "topk", lambda *a, **b: pytest.fail("all sets met"))
    for kinds, cells in ((2048, 1 << 22), (3, 1 << 9)):
        monkeypatch.setattr(overlap, "_KINDS", kinds)
        monkeypatch.setattr(overlap, "_CELLS", cells)
        monkeypatch.setattr(overlap, "topk", lambda rows, k: whole(rows, k, part))
        got = blocking.shared_key_topk(df, tx.char_ngrams(F.col("name"), 3), 5)
        assert sorted(map(tuple, got.collect())) == plain_topk({i: grams(t) for i, t in made}, 5)
    assert whole(spark.createDataFrame([(1, ["a", "b"])], "id long, keys array<string>"), 2, vocabulary=1) is None


def test_blocks_are_read_not_exchanged(spark):
    made = [(n, f"w{t}", 1.0 + n % 3) for n in range(60) for t in range(n % 5, 9, 2)]
    w = spark.createDataFrame(made, "id long, term string, weight double")
    got = tfidf.topk(w, w, 3, exclude_self=True, sizes=(60, 60), block=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "CartesianProduct" in plan  # only a document's best rows are exchanged
    held = {}
    for n, t, x in made:
        held.setdefault(n, {})[t] = x
    score = lambda a, b: sum(x * b.get(t, 0) for t, x in a.items())
    best = {n: sorted((-score(a, b), m) for m, b in held.items() if m != n and score(a, b))[:3] for n, a in held.items()}
    assert sorted((r["i"], r["j"], r["rank"]) for r in got.collect()) == sorted((n, m, r) for n, x in best.items() for r, (_, m) in enumerate(x, 1))
