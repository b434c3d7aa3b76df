import random

import pytest

from pairloom.operators import blocking, encode, pairs, sampling, vectors
from pairloom.plans import builders, pipeline
from pairloom.functions import text as tx
from pyspark.sql import functions as F

NAMES = ["red ring", "red rings", "blue bolt", "blue bolts", "green gear", "", None]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(i, t, (t or "")[:4]) for i, t in enumerate(NAMES)], "id long, text string, cluster string")


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_hashed_vectors(spark, records):
    got = {r["id"]: r["vec"] for r in encode.hashed_tfidf(records, dims=32).collect()}
    assert sorted(got) == list(range(7)) and all(len(v) == 32 for v in got.values())
    assert got[5] == got[6] == [0.0] * 32
    assert sum(x * x for x in got[4]) == pytest.approx(1) or len({abs(x) for x in got[4]} - {0.0}) == 1  # two words may share a place
    near = {r["i"]: r["j"] for r in vectors.dense_topk(encode.hashed_tfidf(records), 1).collect()}
    assert (near[0], near[1], near[2], near[3]) == (1, 0, 3, 2)
    assert encode.hashed_tfidf(records.limit(0)).count() == 0


def test_cached_vectors(spark, records, tmp_path):
    path, calls = str(tmp_path / "v"), []

    def encoder(r):
        calls.append(1)
        return encode.hashed_tfidf(r, dims=4)

    first = rows(encode.cached(path, records, encoder))
    assert rows(encode.cached(path, records, encoder)) == first and len(calls) == 1


def test_hybrid_pairs(records):
    union = rows(builders.hybrid_pairs(records, "union", k=1), "i", "j", "label")
    assert (0, 1, 1) in union and (2, 3, 1) in union
    assert (5, 6, 0) not in rows(builders.ngram_candidates(records).withColumn("label", F.lit(0)))
    both = rows(builders.hybrid_pairs(records, "intersection", k=1), "i", "j")
    assert {(0, 1), (2, 3)} <= set(both) <= {r[:2] for r in union}
    assert rows(builders.hybrid_pairs(records, "first"), "i", "j") == rows(builders.ngram_candidates(records))
    with pytest.raises(ValueError):
        builders.hybrid_pairs(records, "neither")
    assert builders.hybrid_pairs(records.limit(0)).count() == 0


def test_block_without_cap(records):
    assert rows(blocking.key_block_pairs(records, tx.word_tokens(F.col("text")), 7, None)) == [(0, 1), (2, 3)]
    assert rows(builders.token_candidates(records)) == [(0, 1), (2, 3)]


def test_two_tables(spark):
    a = spark.createDataFrame([(1, "red ring"), (2, "blue bolt")], "id long, text string")
    b = spark.createDataFrame([(1, "blue bolt x"), (2, "red ring x")], "id long, text string")
    truth = spark.createDataFrame([(1, 2)], "a long, b long")
    out, pool = builders.two_table_pairs(a, b, truth, 3)
    got = rows(out, "i", "j", "label")
    assert {i for i, _, _ in got} == {2, 5}  # the anchors: row 1 of a and row 2 of b
    assert [r for r in got if r[2] == 1] == [(2, 5, 1), (5, 2, 1)]
    assert rows(pool, "id", "table", "own_id") == [(2, "a", 1), (3, "b", 1), (4, "a", 2), (5, "b", 2)]


def test_imported_pairs(spark):
    raw = spark.createDataFrame([(i, f" n{i} ", None, f"m{i}", "1" if i % 2 else "x" if i == 4 else "0") for i in range(11)], "`id` long, `ltable.name` string, `ltable.id` string, `rtable.name` string, label string")
    got = builders.imported_pairs(raw)
    assert got.columns == ["text1", "text2", "label", "split"]
    assert ("COL name VAL n1", "COL name VAL m1", 1) in rows(got, "text1", "text2", "label")
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 6, "valid": 2, "test": 2}
    assert {r["split"] for r in builders.imported_pairs(raw.filter("id < 2")).collect()} == {"train", "valid"}


def test_quota_and_diverse(spark):
    rec = spark.createDataFrame([(i, f"w{i % 4} v{i}", i % 4) for i in range(20)], "id long, text string, cluster long")
    test = spark.createDataFrame([(1, 2)], "i long, j long")
    got = builders.quota_queries(rec, test, 3, 4).collect()
    assert len({r["i"] for r in got}) == 3 and {r["i"] % 4 for r in got} <= {0, 3} and len(got) == 12
    div = builders.diverse_pairs(rec, 4, 2, 3)
    assert sorted(r["n"] for r in div.groupBy("i").agg(F.count("*").alias("n")).collect()) == [3, 3, 3, 3]
    assert div.filter("label = 1 and i % 4 = 0").count() == 0


def test_quota_of_distant_matches(spark):
    """Row 0's matches come after its 30 nearest rows."""
    rec = spark.createDataFrame([(i, "", 1 if i == 0 or i > 50 else 2) for i in range(60)], "id long, text string, cluster long")
    v = rec.select("id", F.array(F.lit(1.0), F.col("id") / 100).alias("vec"))
    got = builders.quota_queries(rec, spark.createDataFrame([(40, 41)], "i long, j long"), 20, 10, encoder=lambda _: v)
    matches = {r["i"]: r["n"] for r in got.groupBy("i").agg(F.sum("is_match").alias("n")).collect()}
    assert matches[0] == 3


def test_guarded_split_and_sizes(spark):
    one = spark.createDataFrame([(i, i + 1, 0) for i in range(10)], "i long, j long, label int")
    assert rows(sampling.guarded_split(one, 7, ["i", "j"])) == rows(sampling.random_split(one, 7, ["i", "j"]))
    two = one.withColumn("label", (F.col("i") < 5).cast("int"))
    assert rows(sampling.guarded_split(two, 7, ["i", "j"])) == rows(sampling.stratified_split(two, 7, ["i", "j"]))
    assert sampling.guarded_split(one.limit(0), 7, ["i", "j"]).count() == 0
    a, b = sampling.size_matched(one, one.limit(3), 7, ["i", "j"])
    assert (a.count(), b.count()) == (3, 3)


def test_disjoint(spark):
    a, b = spark.range(3), spark.range(3, 6)
    pairs.assert_disjoint(a, b)
    with pytest.raises(ValueError):
        pairs.assert_disjoint(a, b, spark.range(5, 7))


@pytest.mark.parametrize("strategy", sorted(pipeline.STRATEGIES))
def test_strategies(records, strategy):
    got = rows(pipeline.candidates(strategy, records.select("id", "text").filter("text <> ''"), records.select("id").filter("id in (0, 2)"), 1))
    if strategy == "ann":
        assert {i for i, _ in got} <= {0, 2}
    else:
        assert got == [(0, 1), (2, 3)]


def test_ann_recall(spark, monkeypatch):
    """Vectors with nearly uniform neighbours: a quarter of the cells does not find 0.9 of the exact ones."""
    rng = random.Random(3)
    v = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(400)], "id long, vec array<double>").persist()
    monkeypatch.setattr(encode, "hashed_tfidf", lambda records: v)
    exact, near = (set(rows(pipeline.candidates(s, v, v.select("id"), 5))) for s in ("dense", "ann"))
    assert len(exact & near) >= 0.9 * len(exact)


def test_record_text_except(spark):
    df = spark.createDataFrame([(1, "a", "b")], "Id long, name string, city string")
    assert df.select(tx.record_text_except(df.columns, ["id"]).alias("x")).first()["x"] == "COL name VAL a COL city VAL b"
