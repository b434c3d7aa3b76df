"""Pairs of blocks with other pairs, and their samples: as by plain set operations, without exchanging the blocks' pairs."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import blocking, copies, overlap, pairs, sampling
from pairloom.sources import scratch


def words():
    return F.split("name", " ")


def rows(df):
    return sorted(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark):
    draw = random.Random(3)
    names = [(n, " ".join(draw.choices(["red", "blue", "green", f"x{n % 30}", f"own{n}"], k=draw.randrange(1, 5)))) for n in range(90)]
    return spark.createDataFrame([*names, (5, "blue x7"), (5, "blue x7"), (90, None), (None, "red"), (91, "alone")], "id long, name string")


@pytest.mark.parametrize("cap", [None, 1, 7, 1000])
def test_block_pairs_are_made_once(spark, cap):
    df, held = made(spark), {}
    for n, t in map(tuple, df.collect()):
        for w in (t or "").split():
            held.setdefault(w, set()).add(n)
    if cap:
        first = lambda w, s: sorted((r["k"], r["id"] is not None, r["id"] or 0, r["id"]) for r in spark.createDataFrame([(x, w) for x in s], "id long, key string").withColumn("k", sampling.hash_order(7, "key", "id")[0]).collect())
        held = {w: {x[3] for x in first(w, s)[:cap]} for w, s in held.items()}
    want = sorted({(a, b) for s in held.values() for a in s - {None} for b in s - {None} if a < b})
    got = blocking.key_block_pairs(df, words(), 7, cap)
    assert rows(got) == want
    assert "Aggregate" not in plan(got)  # a pair's first common key makes it, no distinct does
    kept = scratch.materialise(blocking.blocks(df, words(), 7, cap))
    draw = random.Random(4)
    found = {tuple(sorted(draw.sample(range(95), 2))) for _ in range(300)}
    other = spark.createDataFrame(sorted(found), "i long, j long")
    assert rows(blocking.combine_blocks(kept, other, "union")) == sorted(found | set(want))
    assert rows(blocking.combine_blocks(kept, other, "intersection")) == sorted(found & set(want))
    with pytest.raises(ValueError):
        blocking.combine_blocks(kept, other, "first")
    kinds = spark.createDataFrame([(n, None if n == 3 else f"c{n % 4}") for n in range(80)] + [(9, "c0")], "id long, cluster string")
    own = kinds.join(kept, "id", "left")
    both = blocking.combine_blocks(own, other, "union", carry=("cluster",)).select("i", "j", pairs.same_cluster(F.col("cluster_i"), F.col("cluster_j"), "equal_nonempty"))
    assert rows(both) == rows(pairs.label_by_cluster(spark.createDataFrame(sorted(found | set(want)), "i long, j long"), kinds, "equal_nonempty"))


def test_hybrid_queries_leave_no_ngram_scratch(spark, tmp_path):
    from pairloom.plans.queries import QUERIES

    names = [(n, f"Customer#{n % 25:09d}", "ABC"[n % 3]) for n in range(40)]
    spark.createDataFrame(names, "c_custkey long, c_name string, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    a, b = ({(r["i"], r["j"]) for r in pairs.unordered(QUERIES[q](spark, str(tmp_path))).collect()} for q in ("token_block_pairs", "ngram_topk"))
    for name, want in (("hybrid_intersect", a & b), ("hybrid_union", a | b)):
        since = scratch.mark()
        assert rows(QUERIES[name](spark, str(tmp_path))) == sorted(want)
        assert scratch.mark() - since == 2  # the blocks and the n-gram pairs


@pytest.mark.parametrize("ratio", [0.2, 0.5, 0.9])
@pytest.mark.parametrize("positives", [0, 1, 40, 3000])
def test_resampled_splits_need_no_stored_pairs(spark, monkeypatch, ratio, positives):
    df = spark.range(3000).select((F.col("id") % 1500).alias("i"), (F.col("id") % 1500 * 7).alias("j"), (F.col("id") % 3 + F.col("id")).alias("n"), (F.col("id") < positives).cast("int").alias("label"))
    df = df.unionByName(spark.createDataFrame([(0, 0, 1, None), (1, 1, 1, 2)], "i long, j long, n long, label int"))
    named = df.select("i", "j", "label")  # every row of one label twice or more, where shares end too
    want = rows(sampling.stratified_split(sampling.ratio_resample(named, ratio, 7, ["i", "j"]), 7, ["i", "j"]))
    monkeypatch.setattr(sampling, "materialise", lambda _: pytest.fail("rows are stored"))
    got = sampling.resampled_split(named, ratio, 7, ["i", "j"])
    assert rows(got) == want
    assert plan(got).count("Exchange") <= 2  # of the buckets in which a share ends


def test_settled_leaves_only_the_result(spark):
    import os
    import time

    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(local.getAllFiles()) if f.getName().startswith("shuffle_")}
    before, since = files(), scratch.mark()

    def make():
        stored = scratch.materialise(spark.range(5000).select("id", (F.col("id") % 7).alias("k")))
        return stored.repartition(6, "k")

    out = scratch.settled(spark, make)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert scratch.mark() - since == 1 and sum(r["id"] for r in out.collect()) == 5000 * 4999 // 2
    assert all(os.path.exists(f.removeprefix("file://")) for f in out.inputFiles())


def test_rare_keys_send_on_only_better_rows(spark, monkeypatch):
    draw = random.Random(6)
    sets = [(n, sorted({f"{p}{draw.randrange(25)}" for p in "abcdef"})) for n in range(200)]
    made, real = [], overlap.settled
    monkeypatch.setattr(overlap, "settled", lambda spark, make: made.append(real(spark, make)) or made[-1])
    got = overlap.topk(spark.createDataFrame(sets, "id long, keys array<string>"), 4)
    want = {i: sorted((-len(set(x) & set(y)), j) for j, y in sets if set(x) & set(y))[:4] for i, x in sets}
    assert sorted((r["i"], r["rank"], -r["score"], r["j"]) for r in got.collect()) == sorted((i, n, *x) for i, best in want.items() for n, x in enumerate(best, 1))
    near, _, far = made
    first, later = ({(r["i"], -r["score"], r["j"]) for r in df.collect()} for df in (near, far))
    assert later and not {(i, j) for i, _, j in first} & {(i, j) for i, _, j in later}
    for i, s, j in later:
        best = sorted((x[1], x[2]) for x in first if x[0] == i)
        assert len(best) < 4 or (s, j) < best[3]


def test_neighbours_of_different_rows_are_not_exchanged_by_candidate(spark):
    found = spark.range(4000).select((F.col("id") % 2000).alias("i"), (F.col("id") * 7 % 2000).alias("j"), F.lit(1.0).alias("score"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        of = copies.classes(spark.range(2000), F.col("id"))
        got = copies.neighbours(found.repartition("i"), of, 1)
        assert "hashpartitioning(j" not in plan(got)
        assert {r["i"] for r in got.collect()} <= set(range(2000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
