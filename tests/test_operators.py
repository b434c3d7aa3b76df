import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as tx
from pairloom.operators import analysis, blocking, metrics, pairs, sampling, scoring, tfidf, vectors
from pairloom.plans import gold, pipeline
from pairloom.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, " a\t\x0b 　 b\n", tx.normalize_text) == "a b"
    assert one(spark, None, tx.normalize_text) == ""
    assert one(spark, None, lambda c: tx.normalize_text(c, "nan")) == "nan"
    assert one(spark, "  Ab-c, 9!", tx.normalize_key) == "ab c 9"
    assert sorted(one(spark, " ABCD ", lambda c: tx.char_ngrams(c, 3))) == ["abc", "bcd"]
    assert one(spark, "ab", lambda c: tx.char_ngrams(c, 3)) == ["ab"]
    assert one(spark, "ab", lambda c: tx.char_ngrams(c, 3, short="drop")) == []
    assert one(spark, "", lambda c: tx.char_ngrams(c, 3)) == []
    assert one(spark, None, lambda c: tx.char_ngrams(c, 3)) == []
    assert one(spark, "It's a dog, a Dog", tx.word_tokens) == ["it", "s", "a", "dog"]
    assert one(spark, "COL a VAL x y COL b VAL z", lambda c: tx.parse_field(c, "a")) == "x y"
    assert one(spark, "COL a VAL x COL b VAL z ", lambda c: tx.parse_field(c, "b")) == "z"
    assert one(spark, "a b c", lambda c: tx.mask_words(c, F.array(F.lit(1), F.lit(0), F.lit(1)))) == "a [MASK] c"


def test_gold(spark):
    raw = spark.createDataFrame([(1, "A b", "x"), (2, "a  B", None), (3, None, "y"), (4, "zz", "z")], "id long, name string, city string")
    std = spark.createDataFrame([("A-B", "7"), ("a b", "9"), (None, "3"), ("q", "bad")], "name string, canonical_int string")
    out = gold.build_gold(raw, std, ["city", "missing"], keep=["id"])
    assert rows(out, "id", "canonical_int", "record_text") == [(1, 7, "COL city VAL x COL missing VAL "), (2, 7, "COL city VAL  COL missing VAL ")]
    own = raw.withColumn("canonical_int", F.when(F.col("id") == 4, 5.9))
    assert rows(gold.build_gold(own, std, ["city"], keep=["id"]), "id", "canonical_int") == [(4, 5)]
    with pytest.raises(KeyError):
        gold.build_gold(raw, None, ["city"])


def test_dense_topk(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0])], "id long, vec array<double>")
    for block in (1, 2, 100):
        assert rows(vectors.dense_topk(v, 2, block=block).filter("i = 1"), "i", "j", "rank") == [(1, 2, 1), (1, 3, 2)]
    assert rows(vectors.dense_topk(v, 99).filter("i = 4"), "j") == [(1,), (2,), (3,), (6,)]
    assert vectors.dense_topk(v.limit(0), 3).count() == 0
    assert rows(vectors.dense_topk(v, 1, exclude_self=False).filter("i = 2"), "j") == [(1,)]


@pytest.mark.parametrize("name", ["ann_topk", "ann_trained_topk"])
def test_cell_queries_recall(spark, name):
    from pairloom.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    exact = set(rows(QUERIES["dense_topk_self"](spark, sf), "i", "j"))
    assert len(exact & set(rows(QUERIES[name](spark, sf), "i", "j"))) / len(exact) >= 0.9


def test_splits(spark):
    df = spark.range(103).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"), (F.col("id") < 9).cast("int").alias("label"))
    split = sampling.random_split(df, 1, ["i", "j"])
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 82, "valid": 10, "test": 11}
    strat = sampling.stratified_split(df, 1, ["i", "j"]).groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in strat} == {(0, "train"): 75, (0, "valid"): 9, (0, "test"): 10, (1, "train"): 7, (1, "test"): 2}
    assert sampling.ratio_resample(df, 0.5, 1, ["i", "j"]).groupBy("label").count().agg(F.max("count")).first()[0] == 9
    assert sampling.capped_resample(df.filter("label = 0"), 0.5, 10, 1, ["i", "j"]).count() == 0
    assert sampling.anchors(df, 20, 10, 1, "i").count() == 2
    assert sampling.anchors(df, None, 10, 1, "i").count() == 103
    clusters = spark.range(104).select("id", (F.col("id") % 10).alias("cluster"))
    out = sampling.cluster_split(df, clusters, 1)
    used = out.join(clusters, out["i"] == clusters["id"]).groupBy("cluster").agg(F.count_distinct("split").alias("n"))
    assert used.filter("n > 1").isEmpty()


def test_pairs(spark):
    p = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (3, 4)], "i long, j long")
    assert rows(pairs.unordered(p)) == [(1, 2), (1, 3), (3, 4)]
    c = spark.createDataFrame([(1, 0), (2, 0), (3, 5), (4, 5)], "id long, cluster long")
    assert [r[2] for r in rows(pairs.label_by_cluster(p, c))] == [1, 0, 1, 1]
    assert [r[2] for r in rows(pairs.label_by_cluster(p, c, "equal_nonzero"))] == [0, 0, 0, 1]
    assert rows(pairs.label_by_truth(p, p.filter("i = 2"))) == [(1, 2, 1), (1, 3, 0), (2, 1, 1), (3, 4, 0)]
    with pytest.raises(ValueError):
        pairs.combine(p, p, "other")
    scored = spark.createDataFrame([(1, j, 1.0 - j / 100, int(j % 5 == 0)) for j in range(1, 31)], "i long, j long, score double, is_match int")
    assert pairs.quota_topk(scored, 10).agg(F.sum("is_match"), F.count("*")).first()[:] == (3, 10)
    assert pairs.quota_topk(scored.filter("is_match = 1"), 10).count() == 6
    assert rows(blocking.cap_per_record(p, 1, 3)) != [] and blocking.cap_per_record(p, 99, 3).count() == 4


def test_metrics(spark):
    def scored(tp, fp, tn, fn):
        data = [(1, 1)] * tp + [(0, 1)] * fp + [(0, 0)] * tn + [(1, 0)] * fn
        return spark.createDataFrame(data, "label int, pred int")

    got = metrics.confusion(scored(138, 34, 1822, 55)).first()
    assert (got["f1"], got["precision"], got["recall"], got["accuracy"]) == (0.756164, 0.802326, 0.715026, 0.956564)
    none = metrics.confusion(scored(0, 0, 3, 0)).first()
    assert (none["f1"], none["precision"], none["accuracy"]) == (0.0, 0.0, 1.0)
    p = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "label int, prob double")
    assert metrics.threshold_search(p).first()["threshold"] == 0.1
    assert metrics.threshold_search(p.filter("label = 0")).first()[:] == (0.5, 0.0)
    assert metrics.threshold_table(p, [0.4], strict=False).first()["recall"] == 1.0
    assert metrics.threshold_table(p, [0.4], strict=True).first()["recall"] == 0.5


def test_edit_distance_of_whole_texts(spark):
    head = "x" * 300
    pairs_ = spark.createDataFrame([(head + "abc", head + "xyz"), ("abcd", "abcx"), ("", None)], "text1 string, text2 string")
    assert [round(r["f_edit"], 6) for r in scoring.pair_features(pairs_).collect()] == [round(1 - 3 / 303, 6), 0.75, 1.0]


def test_tfidf_and_edits(spark):
    docs = spark.createDataFrame([(1, "red dog"), (2, "red dog"), (3, "blue cat"), (4, "")], "id long, text string")
    counts = tfidf.term_counts(docs, "id", "text")
    w = tfidf.weights(counts, tfidf.vocabulary(counts, 4, min_df=1))
    assert rows(tfidf.topk(w, w, 3, exclude_self=True), "i", "j", "score") == [(1, 2, 1.0), (2, 1, 1.0)]
    p = spark.createDataFrame([(1, "a b c d", "x")], "idx long, text1 string, text2 string")
    assert rows(analysis.counterfactuals(p), "variation", "text1") == [("add_country", "a b c d"), ("drop_last_token", "a b c"), ("original", "a b c d"), ("uppercase", "A B C D")]
    weights = analysis.mask_importance(p, lambda a, b: a.contains("c").cast("double"), 60).collect()
    assert max(weights, key=lambda r: r["weight"])["word_pos"] == 2
    assert scoring.span_deleted(p, 1).first()["text1"].count(" ") == 1


def test_pair_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text('a "q", \tb\t1\n\nonly\nc\td\ne\tf\tx\ng\th\t0\textra\n')
    path = str(tmp_path / "p.txt")
    assert rows(readers.read_pairs(spark, path).filter("label is not null")) == [('a "q",', "b", 1)]
    assert rows(readers.read_pairs(spark, path, "lenient"), "left", "label") == [('a "q",', 1), ("g", 0)]
    assert readers.read_pairs(spark, path, "score").count() == 4
    (tmp_path / "t.tsv").write_text('id\tname\n1\tx\nbad\ty\n')
    assert rows(readers.read_ids_tsv(spark, str(tmp_path / "t.tsv"))) == [(1, "x")]
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), readers.text_schema(["a"])).count() == 0


def test_batch_pipeline(spark, tmp_path):
    lines = ["name,city,canonical_int"] + [f"name {k % 12 + 10} inc {'x' * (k % 3)},town {k % 12 + 10},{k % 12}" for k in range(120)]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "new.csv").write_text("name,city\nname 13 inc,town 13\n")
    d = readers.Dataset(raw=str(tmp_path / "raw.csv"), gold=str(tmp_path / "gold"), out=str(tmp_path / "out"), predict=str(tmp_path / "new.csv"), text_fields=("name", "city"), top_k=15)
    pipeline.run(spark, d)
    report = spark.read.text(str(tmp_path / "out/test_report"), wholetext=True).first()["value"]
    assert "\nf1: " in report
    assert spark.read.csv(str(tmp_path / "out/predict"), header=True).count() > 0
    with pytest.raises(ValueError):
        pipeline.run(spark, d, "other")
    with pytest.raises(ValueError):
        pipeline.candidates("other", None, None, 1)
    assert writers.report(spark.createDataFrame([(1, 0.5)], "a int, b double")) == "a: 1\nb: 0.500000\n"


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"a ""q"", b"\n2,x,extra\n3,\n')
    path = str(tmp_path / "a.csv")
    assert rows(readers.read_csv(spark, path, readers.text_schema(["id", "name"]), tolerant=True).fillna("")) == [("1", 'a "q", b'), ("3", "")]
    assert dict(readers.read_csv(spark, path, infer=True).dtypes)["id"] == "int"
    assert readers.read_csv(spark, path, missing="").filter("name = ''").count() == 1
    (tmp_path / "l.csv").write_bytes("# note\nid,name\n1,caf\xe9\n".encode("latin-1"))
    assert rows(readers.read_csv(spark, str(tmp_path / "l.csv"), comment="#", encoding="ISO-8859-1")) == [("1", "café")]
    (tmp_path / "m.csv").write_text('id,name\n1,"two\nlines"\n')
    assert rows(readers.read_csv(spark, str(tmp_path / "m.csv"), multi_line=True), "name") == [("two\nlines",)]
    (tmp_path / "big.txt").write_text("a\tb\t99999999999\nc\td\t-1\ne\tf\t2\n")
    big = str(tmp_path / "big.txt")
    assert rows(readers.read_pairs(spark, big, "lenient"), "left", "label") == [("c", -1), ("e", 2)]
    assert rows(readers.read_pairs(spark, big, "score").filter("label is not null"), "left") == [("e",)]
    (tmp_path / "s.yaml").write_text("one:\n  raw: r.csv\n  text_fields: [a, b]\n  odd: 3\n")
    one = readers.load_dataset(str(tmp_path / "s.yaml"), "one")
    assert (one.raw, one.text_fields, one.extra) == ("r.csv", ("a", "b"), {"odd": 3})
    with pytest.raises(KeyError):
        readers.load_dataset(str(tmp_path / "s.yaml"), "two")
    assert readers.resolve("x", "/r") == "/r/x" and readers.resolve("/x", "/r") == "/x"
    (tmp_path / "n.txt").write_text("\n".join(f"{k:03d}" for k in range(200)))
    got = [r["value"] for r in readers.sample_lines(spark, str(tmp_path / "n.txt"), 30).collect()]
    assert len(got) == 30 and got == sorted(got)


def test_pair_files_with_nulls_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "p")
    for last in ("x", "y"):
        writers.write_pairs(spark.createDataFrame([(None, last, 1, "train")], "text1 string, text2 string, label int, split string"), path)
    assert rows(readers.read_pairs(spark, f"{path}/split=train")) == [("", "y", 1)]
    assert not [p for p in tmp_path.iterdir() if p.name != "p"]


def test_casebook_order_and_error(spark):
    scored = spark.createDataFrame([(k, k + 1, k % 2, k // 2 % 2) for k in range(8)], "i long, j long, label int, pred int")
    assert [r["source"] for r in analysis.full_casebook(scored, 1, 7).collect()] == ["FP", "FN", "TP", "TN"]
    with pytest.raises(ValueError):
        analysis.full_casebook(scored.limit(0), 1, 7)


def test_epochs_and_single_pairs(spark):
    data = [(f"red ring {k}", f"red ring {k}" if k % 2 else f"blue bolt {k + 1}", k % 2) for k in range(40)]
    made = scoring.pair_features(spark.createDataFrame(data, "text1 string, text2 string, label int"))
    model, seen = scoring.train_epochs(made, made, ["f_words", "f_grams", "f_edit", "f_length"], epochs=2, augment=True)
    assert [r["epoch"] for r in seen.orderBy("epoch").collect()] == [1, 2] and seen.agg(F.max("f1")).first()[0] == 1.0
    assert [pred for _, pred in scoring.score_texts(model, spark, [("a b c", "a b c"), ("a b c", "x y z")])] == [1, 0]


@pytest.mark.parametrize(("n", "bins"), [(103, 5), (4, 5), (10, 3)])
def test_bins_of_clusters(spark, n, bins):
    """The same bins as one sort by size and name would give."""
    sizes = spark.range(n).select(F.col("id").alias("cluster"), (F.col("id") * 7 % 4).alias("n"))
    order = sorted(range(n), key=lambda c: (c * 7 % 4, c))
    want, at = {}, 0
    for b in range(bins):
        for c in order[at : at + n // bins + (b < n % bins)]:
            want[c] = b + 1
        at += n // bins + (b < n % bins)
    assert {r["cluster"]: r["bin"] for r in sampling.diverse_clusters(sizes, n * bins, bins, 7).collect()} == want
