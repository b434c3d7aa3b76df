"""The registered queries over the driver tables and, for each, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import analysis, blocking, metrics, pairs, quota, sampling, scoring, tfidf, vectors
from ..sources import readers, writers
from ..sources.scratch import materialise, scratch_dir, settled
from . import builders, gold

SEED = 7
FEATURES = ["f_words", "f_grams", "f_edit", "f_length"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _vectors(spark, sf) -> DataFrame:
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def _clusters(spark, sf) -> DataFrame:
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("cluster"))


def _dense(spark, sf, k: int = 5) -> DataFrame:
    return vectors.dense_topk(_vectors(spark, sf), k)


def _labelled(spark, sf) -> DataFrame:
    return pairs.label_by_cluster(_dense(spark, sf).select("i", "j"), _clusters(spark, sf))


def _scored(spark, sf) -> DataFrame:
    """i, j, label, prob, pred: dense pairs with (1 + cosine) / 2 as probability, decided at 0.75."""
    both = pairs.label_by_cluster(_dense(spark, sf), _clusters(spark, sf))
    prob = F.round((1 + F.col("score")) / 2, 6)
    return both.select("i", "j", "label", prob.alias("prob"), (prob >= 0.75).cast("int").alias("pred"))


def _names(spark, sf) -> DataFrame:
    """Every customer with a text of its own."""
    return _t(spark, sf, "customer").select(F.concat_ws(" ", "c_name", "c_mktsegment").alias("name"), F.col("c_custkey").alias("id"))


V = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, CAST(label AS BIGINT) AS cluster FROM embeddings)"
S = "s AS (SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.id <> b.id)"
D = f"{V}, {S}, d AS (SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rank FROM s QUALIFY rank <= 5)"
L = f"{D}, l AS (SELECT i, j, CAST(a.cluster = b.cluster AS INTEGER) AS label, round((1 + score) / 2, 6) AS prob FROM d JOIN v a ON a.id = i JOIN v b ON b.id = j)"
P = f"{L}, p AS (SELECT *, CAST(prob >= 0.75 AS INTEGER) AS pred FROM l)"
N = "nm AS (SELECT concat_ws(' ', c_name, c_mktsegment) AS name, c_custkey AS id FROM customer)"
H = "md5(concat_ws('|', '7', CAST(i AS VARCHAR), CAST(j AS VARCHAR)))"
NORM = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x0b\x{{00a0}}\x{{3000}}]+', ' ', 'g'))"
SCORES = """round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1"""
ACC = "round(CASE WHEN tp + fp + tn + fn = 0 THEN 0 ELSE (tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE) END, 6) AS accuracy"
COUNTS = "count(*) FILTER (y = 1 AND z = 1) AS tp, count(*) FILTER (y = 0 AND z = 1) AS fp, count(*) FILTER (y = 0 AND z = 0) AS tn, count(*) FILTER (y = 1 AND z = 0) AS fn"


@query(f"WITH {P}, x AS (SELECT label AS y, pred AS z FROM p), c AS (SELECT {COUNTS} FROM x) SELECT *, {SCORES}, {ACC} FROM c")
def confusion_metrics(spark, sf):
    return metrics.confusion(_scored(spark, sf))


@query(f"SELECT doc_id, {NORM.format('text')} AS norm_text FROM documents")
def normalize_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", tx.normalize_text(F.col("text")).alias("norm_text"))


@query("""WITH k AS (SELECT c_custkey, trim(regexp_replace(lower(c_mktsegment || '  ' || CAST(c_nationkey AS VARCHAR)), '[^a-z0-9]+', ' ', 'g')) AS join_key FROM customer),
  s AS (SELECT join_key, min(c_custkey) AS canonical FROM k GROUP BY 1)
  SELECT c_custkey, join_key, canonical FROM k LEFT JOIN s USING (join_key)""")
def normalize_key_join(spark, sf):
    key = tx.normalize_key(F.concat(F.col("c_mktsegment"), F.lit("  "), F.col("c_nationkey").cast("string")))
    raw = _t(spark, sf, "customer").select("c_custkey", key.alias("join_key"))
    known = gold.first_per_key(raw.select("join_key", F.col("c_custkey").alias("canonical")), "join_key", ["canonical"])
    return raw.join(known, "join_key", "left")


REC = " || ' ' || ".join(f"'COL {c} VAL ' || " + NORM.format(c) for c in ("p_name", "p_brand", "p_type"))


@query(f"SELECT p_partkey, {REC} AS record_text FROM part")
def record_text(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", tx.record_text(["p_name", "p_brand", "p_type"]).alias("record_text"))


@query(f"SELECT p_partkey, 'COL table VAL part COL id VAL ' || CAST(p_partkey AS VARCHAR) || ' ' || {REC} AS record_text FROM part")
def tagged_record_text(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", tx.tagged_record_text("part", "p_partkey", ["p_name", "p_brand", "p_type"]).alias("record_text"))


@query(f"SELECT p_partkey, trim(split_part(split_part({REC}, 'COL p_brand VAL ', 2), ' COL ', 1)) AS p_brand FROM part")
def parse_record_field(spark, sf):
    return record_text(spark, sf).select("p_partkey", tx.parse_field(F.col("record_text"), "p_brand").alias("p_brand"))


@query(f"""SELECT d.doc_id, d.lang, d.source, CAST(l.quality AS BIGINT) AS canonical_int,
  'COL lang VAL ' || {NORM.format('d.lang')} || ' COL source VAL ' || {NORM.format('d.source')} AS record_text
  FROM documents d JOIN labels l ON trim(regexp_replace(CAST(d.doc_id AS VARCHAR), '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(CAST(l.doc_id AS VARCHAR), '[^a-z0-9]+', ' ', 'g')) WHERE l.quality IS NOT NULL""")
def gold_build(spark, sf):
    known = _t(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("key"), F.col("quality").alias("canonical_int"))
    raw = _t(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), "lang", "source")
    return gold.build_gold(raw, known, ["lang", "source"], raw_key="key", standard_key="key", keep=["doc_id"])


@query("SELECT p_partkey, p_name FROM part WHERE trim(p_name) IN (SELECT trim(p_name) FROM part WHERE p_size <= 2 AND trim(p_name) NOT IN ('', 'nan'))")
def semi_filter_names(spark, sf):
    part = _t(spark, sf, "part")
    return gold.semi_filter(part, "p_name", part.filter("p_size <= 2").select("p_name")).select("p_partkey", "p_name")


@query(f"""WITH {N}, g AS (SELECT DISTINCT id, substring(lower(trim(name)), CAST(k AS BIGINT), 3) AS gram FROM nm, LATERAL (SELECT unnest(range(1, greatest(length(trim(name)) - 1, 2))) AS k)),
  c AS (SELECT a.id AS i, b.id AS j, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.id <> b.id GROUP BY 1, 2)
  SELECT i, j, shared, CAST(row_number() OVER (PARTITION BY i ORDER BY shared DESC, j) AS INTEGER) AS rank FROM c QUALIFY rank <= 5""")
def ngram_topk(spark, sf):
    return blocking.shared_key_topk(_names(spark, sf), tx.char_ngrams(F.col("name"), 3), 5)


TOKENS = f"{N}, w AS (SELECT DISTINCT id, unnest(regexp_extract_all(lower(name), '[\\p{{L}}\\p{{N}}_]+')) AS key FROM nm), k AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY key ORDER BY md5(concat_ws('|', '7', key, CAST(id AS VARCHAR))), key, id) <= 1000), tp AS (SELECT DISTINCT a.id AS i, b.id AS j FROM k a JOIN k b ON a.key = b.key AND a.id < b.id)"


@query(f"WITH {TOKENS} SELECT i, j FROM tp")
def token_block_pairs(spark, sf):
    return blocking.key_block_pairs(_names(spark, sf), tx.word_tokens(F.col("name")), SEED)


@query(f"""WITH {TOKENS}, e AS (SELECT i, j, unnest([i, j]) AS id FROM tp), n AS (SELECT i, j, row_number() OVER (PARTITION BY id ORDER BY {H}, i, j) AS nth FROM e),
  c AS (SELECT i, j FROM n GROUP BY 1, 2 HAVING max(nth) <= 10) SELECT i, j FROM c ORDER BY {H}, i, j LIMIT 100""")
def pair_cap(spark, sf):
    return blocking.cap_per_record(token_block_pairs(spark, sf), 10, SEED, total=100)


@query(f"WITH {D} SELECT i, j, CAST(rank AS INTEGER) AS rank FROM d")
def dense_topk_self(spark, sf):
    return _dense(spark, sf).select("i", "j", "rank")


ANCHOR = "md5(concat_ws('|', '7', CAST(id AS VARCHAR)))"


@query(f"WITH {D}, a AS (SELECT id FROM v ORDER BY {ANCHOR}, id LIMIT 50) SELECT i, j, CAST(rank AS INTEGER) AS rank FROM d WHERE i IN (SELECT id FROM a)")
def dense_topk_anchors(spark, sf):
    v = _vectors(spark, sf)
    return vectors.dense_topk(v, 5, anchors=sampling.anchors(v, 250, 5, SEED, "id")).select("i", "j", "rank")


@query(f"""WITH {V}, s AS (SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a, v b WHERE a.id % 2 = 1 AND b.id % 2 = 0)
  SELECT i, j, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM s QUALIFY rank <= 5""")
def dense_topk_predict(spark, sf):
    """Odd ids ask the table of the even ones."""
    v = _vectors(spark, sf)
    return vectors.dense_topk(v.filter("id % 2 = 0"), 5, anchors=v.filter("id % 2 = 1"), exclude_self=False).select("i", "j", "rank")


@query(f"""WITH {V}, c AS (SELECT id, e FROM v ORDER BY {ANCHOR}, id LIMIT 16),
  n AS (SELECT v.id, c.id AS cell, row_number() OVER (PARTITION BY v.id ORDER BY round(list_cosine_similarity(v.e, c.e), 6) DESC, c.id) AS r FROM v, c),
  s AS (SELECT q.id AS i, x.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM n q JOIN n x ON q.cell = x.cell AND q.r <= 12 AND x.r = 1 AND q.id <> x.id JOIN v a ON a.id = q.id JOIN v b ON b.id = x.id)
  SELECT i, j, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM s QUALIFY rank <= 5""")
def ann_topk(spark, sf):
    v = _vectors(spark, sf)
    return vectors.cell_topk(v, 5, sampling.take(v, 16, SEED, ["id"]), probes=12).select("i", "j", "rank")


def _tfidf_sql(extra: str = "", min_df: int = 2, most: str = "") -> str:
    return f"""t AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs) GROUP BY 1, 2),
  n AS (SELECT count(*) AS n FROM docs), f AS (SELECT term, count(*) AS df, sum(tf) AS total FROM t GROUP BY 1),
  vo AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM f, n WHERE df >= {min_df} AND df <= CAST(0.95 AS DOUBLE) * n {most}),
  r AS (SELECT id, term, (ln(CAST(tf AS DOUBLE)) + 1.0) * idf AS w FROM t JOIN vo USING (term)),
  z AS (SELECT id, sqrt(sum(w * w)) AS len FROM r GROUP BY 1), ww AS (SELECT id, term, w / len AS weight FROM r JOIN z USING (id)){extra}"""


def _weights(docs: DataFrame) -> DataFrame:
    counts = tfidf.term_counts(docs, "id", "text")
    return tfidf.weights(counts, tfidf.vocabulary(counts, docs.count()))


def _docs(spark, sf) -> DataFrame:
    return _t(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


@query(f"WITH docs AS (SELECT doc_id AS id, text FROM documents), {_tfidf_sql()} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM ww")
def tfidf_weights(spark, sf):
    return _weights(_docs(spark, sf)).select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


PAIRS = ", sc AS (SELECT a.id AS i, b.id AS j, round(sum(a.weight * b.weight), 6) AS score FROM ww a JOIN ww b ON a.term = b.term AND {on} GROUP BY 1, 2)"


@query(f"WITH docs AS (SELECT doc_id AS id, text FROM documents), {_tfidf_sql(PAIRS.format(on='a.id <> b.id'))} SELECT i, j, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM sc QUALIFY rank <= 5")
def tfidf_topk_self(spark, sf):
    docs = _docs(spark, sf)
    w, n = _weights(docs), docs.count()
    return tfidf.topk(w, w, 5, exclude_self=True, sizes=(n, n)).select("i", "j", "rank")


@query(f"WITH docs AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT -1 - item_id, text FROM benchmark), {_tfidf_sql(PAIRS.format(on='a.id < 0 AND b.id >= 0'))} SELECT -1 - i AS item_id, j AS doc_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM sc QUALIFY rank <= 3")
def tfidf_topk_predict(spark, sf):
    asked = _t(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("id"), "text")
    docs = _docs(spark, sf)
    w = _weights(docs.unionByName(asked))
    return tfidf.topk(w.filter("id < 0"), w.filter("id >= 0"), 3, sizes=(asked.count(), docs.count())).select((-1 - F.col("i")).alias("item_id"), F.col("j").alias("doc_id"), "rank")


def _two_sets(spark, sf):
    return token_block_pairs(spark, sf), ngram_topk(spark, sf)


def _blocks_and_grams(spark, sf):
    """The token blocks of the customers and the distinct n-gram pairs."""
    near = settled(spark, lambda: pairs.unordered(settled(spark, lambda: ngram_topk(spark, sf).select("i", "j"))))
    return settled(spark, lambda: blocking.blocks(_names(spark, sf), tx.word_tokens(F.col("name")), SEED)), near


TWO = f"WITH {TOKENS}, ng AS ({ORACLES['ngram_topk']}), a AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM tp), b AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM ng)"


@query(f"{TWO} SELECT * FROM a UNION SELECT * FROM b")
def hybrid_union(spark, sf):
    return blocking.combine_blocks(*_blocks_and_grams(spark, sf), "union")


@query(f"{TWO} SELECT * FROM a INTERSECT SELECT * FROM b")
def hybrid_intersect(spark, sf):
    return blocking.combine_blocks(*_blocks_and_grams(spark, sf), "intersection")


@query(f"WITH {D} SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM d")
def unordered_dedupe(spark, sf):
    return pairs.unordered(_dense(spark, sf))


@query(f"WITH {L} SELECT i, j, label FROM l")
def label_equal(spark, sf):
    return _labelled(spark, sf)


@query(f"WITH {L} SELECT i, j, CAST(label = 1 AND cluster <> 0 AS INTEGER) AS label FROM l JOIN v ON v.id = i")
def label_equal_nonzero(spark, sf):
    return pairs.label_by_cluster(_dense(spark, sf).select("i", "j"), _clusters(spark, sf), "equal_nonzero")


@query(f"""WITH {D}, tr AS (SELECT DISTINCT least(i, j) AS a, greatest(i, j) AS b FROM d WHERE rank <= 2)
  SELECT i, j, CAST(tr.a IS NOT NULL AS INTEGER) AS label FROM d LEFT JOIN tr ON least(i, j) = a AND greatest(i, j) = b""")
def label_truth_pairs(spark, sf):
    d = _dense(spark, sf)
    return pairs.label_by_truth(d.select("i", "j"), d.filter("rank <= 2").select("i", "j"))


@query(f"""WITH {L}, r AS (SELECT i, j, label, row_number() OVER (ORDER BY {H}, i, j) AS k, count(*) OVER () AS n FROM l)
  SELECT i, j, label, CASE WHEN k <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' WHEN k <= CAST(floor(n * 0.8) AS BIGINT) + CAST(floor(n * 0.1) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM r""")
def random_split(spark, sf):
    return sampling.random_split(_labelled(spark, sf), SEED, ["i", "j"])


STRAT = f"""WITH {L}, r AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k, count(*) OVER (PARTITION BY label) AS n FROM l),
  q AS (SELECT *, greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS a, floor(n * CAST(0.1 AS DOUBLE)) AS b FROM r),
  sp AS (SELECT i, j, label, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'valid' ELSE 'test' END AS split FROM q)"""


@query(f"{STRAT} SELECT * FROM sp")
def stratified_split(spark, sf):
    return sampling.stratified_split(_labelled(spark, sf), SEED, ["i", "j"])


@query(f"""WITH {L}, c AS (SELECT DISTINCT cluster FROM v), r AS (SELECT cluster, row_number() OVER (ORDER BY md5(concat_ws('|', '7', CAST(cluster AS VARCHAR))), cluster) AS k, count(*) OVER () AS n FROM c),
  m AS (SELECT cluster, CASE WHEN k <= floor(n * 0.8) THEN 'train' WHEN k <= floor(n * 0.8) + floor(n * 0.1) THEN 'valid' ELSE 'test' END AS split FROM r)
  SELECT i, j, label, x.split FROM l JOIN v a ON a.id = i JOIN v b ON b.id = j JOIN m x ON x.cluster = a.cluster JOIN m y ON y.cluster = b.cluster AND x.split = y.split""")
def cluster_split(spark, sf):
    return sampling.cluster_split(_labelled(spark, sf), _clusters(spark, sf), SEED)


@query(f"{STRAT} SELECT split, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg, round(avg(CAST(label AS DOUBLE)), 6) AS pos_rate FROM sp GROUP BY 1")
def split_match_rate(spark, sf):
    return metrics.match_rate(stratified_split(spark, sf))


@query(f"""WITH {L}, np AS (SELECT count(*) AS n FROM l WHERE label = 1), r AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k FROM l)
  SELECT i, j, label FROM r, np WHERE label = 1 OR k <= round_even(n * 0.4 / 0.6, 0)""")
def ratio_resample(spark, sf):
    return sampling.ratio_resample(_labelled(spark, sf), 0.6, SEED, ["i", "j"])


@query(f"""WITH {V}, n AS (SELECT id, cluster, row_number() OVER (ORDER BY {ANCHOR}, id) AS k FROM v), m AS (SELECT count(*) AS m FROM v),
  dr AS (SELECT CAST('0x' || substring(md5(concat_ws('|', '7', 'a', CAST(x AS VARCHAR))), 1, 8) AS BIGINT) % m + 1 AS a, CAST('0x' || substring(md5(concat_ws('|', '7', 'b', CAST(x AS VARCHAR))), 1, 8) AS BIGINT) % m + 1 AS b FROM range(200000) t(x), m),
  pr AS (SELECT DISTINCT least(p.id, q.id) AS i, greatest(p.id, q.id) AS j FROM dr JOIN n p ON p.k = a JOIN n q ON q.k = b WHERE p.id <> q.id),
  l AS (SELECT i, j, CAST(a.cluster = b.cluster AS INTEGER) AS label FROM pr JOIN v a ON a.id = i JOIN v b ON b.id = j),
  c AS (SELECT least(count(*) FILTER (label = 1), 10000) AS p FROM l), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k FROM l)
  SELECT i, j, label FROM r, c WHERE (label = 1 AND k <= p) OR (label = 0 AND k <= greatest(p, least(p * 20, 20000 - p)))""")
def naive_pairs_balanced(spark, sf):
    drawn = sampling.naive_pairs(_vectors(spark, sf), 200_000, SEED, "id")
    return sampling.balance(pairs.label_by_cluster(drawn, _clusters(spark, sf)), 20_000, 20, SEED, ["i", "j"])


@query("""WITH z AS (SELECT o_custkey AS cluster, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT cluster, ntile(5) OVER (ORDER BY n, cluster) AS bin FROM z),
  r AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5(concat_ws('|', '7', CAST(cluster AS VARCHAR))), cluster) AS k FROM b) SELECT cluster, CAST(bin AS INTEGER) AS bin FROM r WHERE k <= 2 + CASE WHEN bin <= 2 THEN 1 ELSE 0 END""")
def diverse_cluster_queries(spark, sf):
    sizes = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cluster")).agg(F.count("*").alias("n"))
    return sampling.diverse_clusters(sizes, 12, 5, SEED)


CLUSTER_SPLIT = ORACLES["cluster_split"]


@query(f"WITH {V}, u AS (SELECT DISTINCT cluster FROM v JOIN ({CLUSTER_SPLIT}) t ON t.split = 'test' AND (v.id = t.i OR v.id = t.j)) SELECT id AS vec_id FROM v WHERE cluster NOT IN (SELECT cluster FROM u)")
def exclude_test_clusters(spark, sf):
    test = cluster_split(spark, sf).filter("split = 'test'").select("i", "j")
    return pairs.exclude_clusters(_clusters(spark, sf), test).select(F.col("id").alias("vec_id"))


@query(f"""WITH {V}, {S}, d AS (SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rank FROM s QUALIFY rank <= 5000),
  m AS (SELECT i, j, score, CAST(a.cluster = b.cluster AS INTEGER) AS is_match FROM d JOIN v a ON a.id = i JOIN v b ON b.id = j),
  c AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY i, is_match ORDER BY score DESC, j) <= CASE WHEN is_match = 1 THEN 3 ELSE 7 END THEN 1 ELSE 0 END AS chosen FROM m),
  f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY i ORDER BY chosen DESC, score DESC, j) <= 10)
  SELECT i, j, is_match, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM f""")
def quota_topk(spark, sf):
    rows = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").cast("long").alias("cluster"))
    near = quota.candidates(rows, 10, 5000)
    return pairs.quota_topk(near, 10).select("i", "j", "is_match", "rank")


@query(f"""WITH {P}, x AS (SELECT 1 AS class, label AS y, pred AS z FROM p UNION ALL SELECT 0, 1 - label, 1 - pred FROM p), c AS (SELECT class, {COUNTS} FROM x GROUP BY 1)
  SELECT CAST(class AS INTEGER) AS class, {SCORES}, tp + fn AS support FROM c""")
def class_report(spark, sf):
    return metrics.class_report(_scored(spark, sf))


def _sweep(values: str, op: str) -> str:
    return f"WITH {P}, th AS (SELECT CAST(k AS DOUBLE) * 5 / 100 AS threshold FROM range({values}) t(k)), x AS (SELECT threshold, label AS y, CAST(prob {op} threshold AS INTEGER) AS z FROM p, th), c AS (SELECT threshold, {COUNTS} FROM x GROUP BY 1), sw AS (SELECT threshold, {SCORES} FROM c)"


@query(f"{_sweep('0, 20', '>')} SELECT CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold, f1 FROM sw ORDER BY f1 DESC, threshold LIMIT 1")
def threshold_search(spark, sf):
    return metrics.threshold_search(_scored(spark, sf))


@query(f"{_sweep('2, 19', '>=')} SELECT * FROM sw")
def threshold_sweep(spark, sf):
    return metrics.threshold_table(_scored(spark, sf), [k * 5 / 100 for k in range(2, 19)], strict=False)


@query(f"WITH {P} SELECT count(*) AS n, count(*) FILTER (pred = 1) AS n_match, round(avg(prob), 6) AS mean, round(stddev_samp(prob), 6) AS std, round(quantile_cont(prob, 0.25), 6) AS q25, round(quantile_cont(prob, 0.5), 6) AS q50, round(quantile_cont(prob, 0.75), 6) AS q75 FROM p")
def prob_summary(spark, sf):
    return metrics.probability_summary(_scored(spark, sf))


@query(f"WITH {P}, e AS (SELECT min(prob) AS lo, max(prob) AS hi FROM p) SELECT label, CAST(CASE WHEN hi = lo THEN 1 ELSE least(30, floor((prob - lo) / ((hi - lo) / 30)) + 1) END AS INTEGER) AS bin, count(*) AS n FROM p, e GROUP BY 1, 2")
def prob_histogram(spark, sf):
    return metrics.histogram(_scored(spark, sf), "prob", 30, ["label"])


@query(f"""WITH {P}, a AS (SELECT label, pred, row_number() OVER (ORDER BY md5(concat_ws('|', '7/a', CAST(i AS VARCHAR), CAST(j AS VARCHAR))), i, j) AS ka, row_number() OVER (ORDER BY md5(concat_ws('|', '7/b', CAST(i AS VARCHAR), CAST(j AS VARCHAR))), i, j) AS kb FROM p),
  x AS (SELECT label AS y, pred AS z FROM p), c AS (SELECT {COUNTS} FROM x), r AS (SELECT {SCORES}, {ACC} FROM c),
  x2 AS (SELECT m.label AS y, o.pred AS z FROM a m JOIN a o ON m.ka = o.kb), c2 AS (SELECT {COUNTS.replace('FROM x', 'FROM x2')} FROM x2), r2 AS (SELECT {SCORES}, {ACC} FROM c2)
  SELECT r.f1 AS real_f1, r.accuracy AS real_accuracy, r2.f1 AS shuffled_f1, r2.accuracy AS shuffled_accuracy FROM r, r2""")
def label_shuffle_check(spark, sf):
    return metrics.label_shuffle(_scored(spark, sf), SEED)


@query(f"""{STRAT}, e AS (SELECT split, label, unnest([i, j]) AS id FROM sp), g AS (SELECT split, id, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM e GROUP BY 1, 2)
  SELECT split, round(avg(pos), 6) AS mean_pos, quantile_cont(CAST(pos AS DOUBLE), 0.5) AS median_pos, max(pos) AS max_pos, round(avg(neg), 6) AS mean_neg, quantile_cont(CAST(neg AS DOUBLE), 0.5) AS median_neg, max(neg) AS max_neg FROM g GROUP BY 1""")
def record_participation(spark, sf):
    return metrics.participation(stratified_split(spark, sf))


@query("SELECT p_brand AS cluster, count(*) AS n, arg_min(p_name, p_partkey) AS example FROM part GROUP BY 1")
def cluster_stats(spark, sf):
    return metrics.cluster_stats(_t(spark, sf, "part"), "p_brand", "p_name", "p_partkey")


@query("SELECT p_brand AS cluster, count(*) AS n, arg_min(p_name, p_partkey) AS example FROM part GROUP BY 1 ORDER BY n DESC, cluster LIMIT 20")
def cluster_top20(spark, sf):
    return cluster_stats(spark, sf).orderBy(F.col("n").desc(), "cluster").limit(20)


@query("""WITH g AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT quantile_cont(CAST(n AS DOUBLE), 0.1) AS q10, quantile_cont(CAST(n AS DOUBLE), 0.25) AS q25, quantile_cont(CAST(n AS DOUBLE), 0.5) AS q50, quantile_cont(CAST(n AS DOUBLE), 0.75) AS q75, quantile_cont(CAST(n AS DOUBLE), 0.9) AS q90 FROM g""")
def group_size_quantiles(spark, sf):
    return metrics.group_quantiles(_t(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")), "n")


@query(f"WITH {P} SELECT i AS query, max(pred) AS any_match FROM p GROUP BY 1")
def per_query_any_match(spark, sf):
    return _scored(spark, sf).groupBy(F.col("i").alias("query")).agg(F.max("pred").alias("any_match"))


@query(f"WITH {P} SELECT pred, count(*) AS n FROM p GROUP BY 1")
def prediction_counts(spark, sf):
    return _scored(spark, sf).groupBy("pred").agg(F.count("*").alias("n"))


@query(f"""WITH {P}, o AS (SELECT i, j, label, pred, CASE WHEN label = 1 AND pred = 1 THEN 'TP' WHEN pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS source FROM p)
  SELECT source, i, j, label, pred FROM o QUALIFY row_number() OVER (PARTITION BY source ORDER BY {H}, i, j) <= 20""")
def casebook(spark, sf):
    return analysis.casebook(_scored(spark, sf), 20, SEED).select("source", "i", "j", "label", "pred")


def _name_pairs(spark, sf) -> DataFrame:
    """idx, text1, text2: every customer's text with the nearest by 3-grams."""
    near = ngram_topk(spark, sf).filter("rank = 1").select("i", "j")
    return pairs.lookup_texts(near, _names(spark, sf).select("id", F.col("name").alias("text"))).select(F.col("i").alias("idx"), "text1", "text2")


@query(f"""WITH ng AS ({ORACLES['ngram_topk']}), {N}, x AS (SELECT i AS idx, a.name AS text1, b.name AS text2 FROM ng JOIN nm a ON a.id = i JOIN nm b ON b.id = j WHERE rank = 1)
  SELECT idx, 'original' AS variation, text1, text2 FROM x
  UNION ALL SELECT idx, 'drop_last_token', CASE WHEN len(string_split(text1, ' ')) > 3 THEN array_to_string(string_split(text1, ' ')[:-2], ' ') ELSE text1 END, text2 FROM x
  UNION ALL SELECT idx, 'add_country', text1, text2 || ' country: Randomland' FROM x UNION ALL SELECT idx, 'uppercase', upper(text1), text2 FROM x""")
def counterfactual_variants(spark, sf):
    return analysis.counterfactuals(_name_pairs(spark, sf))


@query()
def lr_scores(spark, sf):
    """A classifier of part records' text pairs, trained on a stratified split: i, j, prob, pred of the test rows."""
    records = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), tx.record_text(["p_name", "p_brand", "p_type"]).alias("text"), F.col("p_name").alias("cluster"))
    drawn = pairs.label_by_cluster(sampling.naive_pairs(records, 200_000, SEED, "id"), records.select("id", "cluster"), "equal_nonempty")
    chosen = sampling.balance(drawn, 20_000, 20, SEED, ["i", "j"])
    parts = materialise(sampling.stratified_split(scoring.pair_features(pairs.lookup_texts(chosen, records.select("id", "text"))), SEED, ["i", "j"]))
    model, _ = scoring.train(parts.filter("split = 'train'"), parts.filter("split = 'valid'"), FEATURES)
    return scoring.score(model, parts.filter("split = 'test'")).select("i", "j", "label", "prob", "pred")


@query()
def mask_importance(spark, sf):
    """Weights of the words of customers' texts for their 3-gram overlap with the nearest text."""

    def overlap(a, b):
        x, y = tx.char_ngrams(a, 3), tx.char_ngrams(b, 3)
        return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))

    return analysis.mask_importance(_name_pairs(spark, sf), overlap)


@query()
def ann_trained_topk(spark, sf):
    v = _vectors(spark, sf)
    return vectors.cell_topk(v, 5, vectors.kmeans_centroids(v, 16, 20_000), probes=12).select("i", "j", "rank")


CUST = " || ' ' || ".join(f"'COL {c} VAL ' || " + NORM.format(c) for c in ("c_name", "c_mktsegment"))


@query(f"SELECT c_custkey, {CUST} AS record_text FROM customer")
def record_text_except(spark, sf):
    t = _t(spark, sf, "customer")
    return t.select("c_custkey", tx.record_text_except(t.columns, ["C_CUSTKEY", "c_nationkey", "c_acctbal"]).alias("record_text"))


@query(f"""WITH {L}, m AS (SELECT least(count(*) FILTER (label = 1), 50) AS p FROM l), r AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k FROM l)
  SELECT i, j, label FROM r, m WHERE (label = 1 AND k <= p) OR (label = 0 AND k <= trunc(p * 0.8 / 0.2))""")
def capped_resample(spark, sf):
    return sampling.capped_resample(_labelled(spark, sf), 0.2, 100, SEED, ["i", "j"])


@query(f"""WITH {L}, r AS (SELECT i, j, label, row_number() OVER (ORDER BY {H}, i, j) AS k, count(*) OVER () AS n FROM l), q AS (SELECT *, greatest(1, floor(n * CAST(0.6 AS DOUBLE))) AS a, greatest(1, floor(n * CAST(0.2 AS DOUBLE))) AS b FROM r)
  SELECT i, j, label, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'valid' ELSE 'test' END AS split FROM q""")
def random_split_least(spark, sf):
    return sampling.random_split(_labelled(spark, sf), SEED, ["i", "j"], 0.6, 0.2, least=1)


@query(f"{STRAT} SELECT i, j, split, CAST(row_number() OVER (PARTITION BY split ORDER BY {H}, i, j) AS INTEGER) AS place FROM sp")
def shuffled_within_split(spark, sf):
    return sampling.with_rank(stratified_split(spark, sf), SEED, ["i", "j"], ["split"], "place", few=True).select("i", "j", "split", F.col("place").cast("int").alias("place"))


@query("""WITH z AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT min(n) AS lo, max(n) AS hi FROM z)
  SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(50, floor((n - lo) / ((hi - lo) / 50)) + 1) END AS INTEGER) AS bin, count(*) AS n FROM z, e GROUP BY 1""")
def cluster_size_histogram(spark, sf):
    return metrics.histogram(_t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("size")), "size", 50, [])


@query("SELECT count(DISTINCT p_partkey) AS n_ids, count(DISTINCT p_name) AS n_names, count(DISTINCT p_brand) AS n_clusters FROM part")
def pool_sizes(spark, sf):
    return _t(spark, sf, "part").agg(F.countDistinct("p_partkey").alias("n_ids"), F.countDistinct("p_name").alias("n_names"), F.countDistinct("p_brand").alias("n_clusters"))


@query("SELECT p_name AS text FROM part UNION SELECT p_type FROM part ORDER BY 1")
def unique_texts(spark, sf):
    t = _t(spark, sf, "part")
    return t.select(F.col("p_name").alias("text")).union(t.select("p_type")).distinct().orderBy("text")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def id_difference(spark, sf):
    return _t(spark, sf, "documents").select("doc_id").exceptAll(_t(spark, sf, "labels").select("doc_id")).distinct()


@query(f"""{TWO}, n AS (SELECT least((SELECT count(*) FROM a), (SELECT count(*) FROM b)) AS n), x AS (SELECT 'tokens' AS source, i, j FROM a UNION ALL SELECT 'ngrams', i, j FROM b),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {H}, i, j) AS k FROM x) SELECT source, i, j FROM r, n WHERE k <= n""")
def size_matched_sample(spark, sf):
    a, b = sampling.size_matched(*(pairs.unordered(x) for x in _two_sets(spark, sf)), SEED, ["i", "j"])
    return a.select(F.lit("tokens").alias("source"), "i", "j").unionByName(b.select(F.lit("ngrams").alias("source"), "i", "j"))


@query(f"""WITH {P}, o AS (SELECT i, j, CASE WHEN label = 1 AND pred = 1 THEN 'TP' WHEN pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS source FROM p)
  SELECT source, i, j FROM o WHERE source <> 'TN' QUALIFY row_number() OVER (PARTITION BY source ORDER BY {H}, i, j) = 1""")
def one_per_outcome(spark, sf):
    return analysis.casebook(_scored(spark, sf), 1, SEED).filter("source <> 'TN'").select("source", "i", "j")


def _strat(source: str) -> str:
    """CTEs that split the table ``source`` (i, j, label) as ``stratified_split`` does, into ``sp``."""
    return f"""r AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k, count(*) OVER (PARTITION BY label) AS n FROM {source}),
  q AS (SELECT *, greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS a, floor(n * CAST(0.1 AS DOUBLE)) AS b FROM r),
  sp AS (SELECT i, j, label, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'valid' ELSE 'test' END AS split FROM q)"""


@query(f"""WITH {V}, g AS (SELECT * FROM v WHERE id % 2 = 0), {S.replace('FROM v a JOIN v b', 'FROM g a JOIN v b')}, d AS (SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rank FROM s QUALIFY rank <= 5),
  tr AS (SELECT id AS a, id + 2 AS b FROM v WHERE id % 2 = 0), l AS (SELECT i, j, CAST(tr.a IS NOT NULL AS INTEGER) AS label FROM d LEFT JOIN tr ON least(i, j) = a AND greatest(i, j) = b), {_strat('l')} SELECT * FROM sp""")
def pool_truth_pairs(spark, sf):
    """Even rows ask the whole pool; the truth links each even id with the next."""
    v = _vectors(spark, sf)
    even = v.filter("id % 2 = 0").select("id")
    return builders.pool_pairs(v.select("id"), even.select(F.col("id").alias("i"), (F.col("id") + 2).alias("j")), even, 5, SEED, lambda _: v)


@query(f"""WITH {V}, {S}, d AS (SELECT i, j, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rank FROM s QUALIFY rank <= 5),
  l AS (SELECT i, j, CAST(i // 2 = j // 2 AND i <> j AS INTEGER) AS label FROM d), {_strat('l')} SELECT * FROM sp""")
def two_table_pairs(spark, sf):
    """Rows of even and odd ids as two tables whose rows match by half their id."""
    v = _vectors(spark, sf).filter("id is not null")
    half = v.select(F.floor(F.col("id") / 2).cast("long").alias("id"), F.lit("").alias("text"), (F.col("id") % 2).alias("side"))
    a, b = half.filter("side = 0").drop("side"), half.filter("side = 1").drop("side")
    truth = a.join(b.select("id"), "id").select(F.col("id").alias("a"), F.col("id").alias("b"))
    return builders.two_table_pairs(a, b, truth, 5, SEED, lambda _: v)[0]


@query(f"""WITH {V}, ok AS ({ORACLES['exclude_test_clusters']}), ask AS (SELECT vec_id AS id FROM ok ORDER BY md5(concat_ws('|', '7', CAST(vec_id AS VARCHAR))), vec_id LIMIT 5),
  s AS (SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score, CAST(a.cluster = b.cluster AS INTEGER) AS is_match FROM v a JOIN ask ON a.id = ask.id JOIN v b ON a.id <> b.id),
  m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, j) <= 5000),
  c AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY i, is_match ORDER BY score DESC, j) <= CASE WHEN is_match = 1 THEN 3 ELSE 7 END THEN 1 ELSE 0 END AS chosen FROM m),
  f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY i ORDER BY chosen DESC, score DESC, j) <= 10)
  SELECT i, j, is_match, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM f""")
def quota_queries(spark, sf):
    v = _vectors(spark, sf)
    test = cluster_split(spark, sf).filter("split = 'test'").select("i", "j")
    return builders.quota_queries(_clusters(spark, sf), test, 5, 10, SEED, encoder=lambda _: v).select("i", "j", "is_match", "rank")


@query(f"""WITH {V}, z AS (SELECT cluster, count(*) AS n FROM v GROUP BY 1), bb AS (SELECT cluster, ntile(5) OVER (ORDER BY n, cluster) AS bin FROM z),
  ch AS (SELECT cluster FROM (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5(concat_ws('|', '7', CAST(cluster AS VARCHAR))), cluster) AS k FROM bb) WHERE k <= 2),
  fi AS (SELECT v.* FROM v JOIN ch USING (cluster) QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY {ANCHOR.replace('id', 'v.id')}, v.id) = 1),
  {S.replace('FROM v a JOIN v b', 'FROM fi a JOIN v b')}, d AS (SELECT i, j FROM s QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, j) <= 10),
  l AS (SELECT i, j, CAST(x.cluster = y.cluster AND x.cluster <> 0 AS INTEGER) AS label FROM d JOIN v x ON x.id = i JOIN v y ON y.id = j), {_strat('l')} SELECT * FROM sp""")
def diverse_pairs(spark, sf):
    v = _vectors(spark, sf)
    return builders.diverse_pairs(_clusters(spark, sf), 10, 5, 10, SEED, lambda _: v)


NATION = "br AS (SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS cluster FROM customer)"


@query(f"""{TWO}, {NATION}, u AS (SELECT * FROM a UNION SELECT * FROM b), h AS (SELECT i, j, CAST(x.cluster = y.cluster AND x.cluster <> '' AS INTEGER) AS label FROM u JOIN br x ON x.id = i JOIN br y ON y.id = j),
  np AS (SELECT count(*) AS p FROM h WHERE label = 1), rk AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k FROM h), l AS (SELECT i, j, label FROM rk, np WHERE label = 1 OR k <= round_even(p * 0.8 / 0.2, 0)), {_strat('l')} SELECT * FROM sp""")
def hybrid_dataset(spark, sf):
    nations = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("cluster"))
    held, near = _blocks_and_grams(spark, sf)
    own, label = settled(spark, lambda: nations.join(held, "id", "left")), pairs.same_cluster(F.col("cluster_i"), F.col("cluster_j"), "equal_nonempty")
    labelled = blocking.combine_blocks(own, near, "union", carry=("cluster",)).select("i", "j", label.alias("label"))
    return sampling.resampled_split(labelled, 0.2, SEED, ["i", "j"])


@query()
def encoded_topk(spark, sf):
    """Nearest customers by hashed TF-IDF vectors of their texts."""
    records = _names(spark, sf).select(F.col("id").cast("long").alias("id"), F.col("name").alias("text"))
    return vectors.dense_topk(builders.encode.hashed_tfidf(records), 5).select("i", "j", "rank")


@query()
def top_words(spark, sf):
    """The three words of each text with the largest weights in size."""
    rank = F.row_number().over(Window.partitionBy("idx").orderBy(F.abs("weight").desc(), "word_pos")).cast("int")
    return mask_importance(spark, sf).withColumn("rank", rank).filter("rank <= 3")


@query()
def blocking_comparison(spark, sf):
    """Test metrics of classifiers trained on n-gram, token, embedding and random pairs of customers; 20,000 pairs of each at most."""
    records = _names(spark, sf).select(F.col("id").cast("long").alias("id"), F.col("name").alias("text"), F.element_at(F.split("name", " "), -1).alias("cluster"))

    def made(found):
        chosen = sampling.capped_resample(pairs.label_by_cluster(pairs.unordered(found), records.select("id", "cluster"), "equal_nonempty"), 0.5, 20_000, SEED, ["i", "j"])
        return scoring.pair_features(pairs.lookup_texts(chosen, records.select("id", "text")))

    parts = materialise(sampling.guarded_split(made(ngram_topk(spark, sf)), SEED, ["i", "j"]))
    sets = {"ngrams": parts.filter("split = 'train'").drop("split"), "tokens": made(token_block_pairs(spark, sf)), "embeddings": made(builders.dense_candidates(records)), "random": made(sampling.naive_pairs(records, 200_000, SEED, "id"))}
    return builders.compare({k: materialise(v) for k, v in sets.items()}, parts.filter("split = 'valid'"), parts.filter("split = 'test'"), FEATURES)


@query("WITH z AS (SELECT count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand) SELECT count(*) AS n_clusters, min(n) AS min_size, max(n) AS max_size, round(avg(n), 6) AS mean_size, quantile_cont(CAST(n AS DOUBLE), 0.5) AS median_size FROM z")
def cluster_size_summary(spark, sf):
    return metrics.cluster_size_summary(_t(spark, sf, "part"), "p_brand")


@query(f"SELECT source, count(*) AS n FROM ({ORACLES['casebook']}) GROUP BY 1")
def casebook_counts(spark, sf):
    return analysis.source_counts(analysis.casebook(_scored(spark, sf), 20, SEED))


@query(f"SELECT source, i, j, CAST(row_number() OVER (ORDER BY array_position(['FP', 'FN', 'TP', 'TN'], source), i, j) AS INTEGER) AS place FROM ({ORACLES['casebook']})")
def ordered_casebook(spark, sf):
    book = analysis.full_casebook(_scored(spark, sf), 20, SEED)  # 80 rows at most
    place = F.row_number().over(Window.orderBy(analysis.casebook_order(F.col("source")), "i", "j"))
    return book.select("source", "i", "j", place.cast("int").alias("place"))


@query("SELECT doc_id FROM documents UNION SELECT doc_id FROM labels")
def id_union(spark, sf):
    return pairs.combine_ids(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def id_intersection(spark, sf):
    return pairs.combine_ids(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels").select("doc_id"), "intersection")


@query(f"WITH {D} SELECT least(i, j) AS i, greatest(i, j) AS j FROM d WHERE rank <= 2 UNION SELECT id, id + 2 FROM v WHERE id % 2 = 0")
def truth_union(spark, sf):
    """The union of two sets of truth pairs."""
    even = _vectors(spark, sf).filter("id % 2 = 0").select(F.col("id").alias("i"), (F.col("id") + 2).alias("j"))
    return pairs.combine_ids(pairs.unordered(_dense(spark, sf).filter("rank <= 2")), pairs.unordered(even))


@query("SELECT c_custkey AS id, c_name AS name, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def bag_concat(spark, sf):
    a = _t(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(_t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("source")))


@query(f"""WITH {V}, nn AS ({ORACLES['ann_topk']}), u AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM nn), t AS (SELECT i, j FROM u ORDER BY {H}, i, j LIMIT 500),
  l AS (SELECT i, j, CAST(a.cluster = b.cluster AS INTEGER) AS label FROM t JOIN v a ON a.id = i JOIN v b ON b.id = j), {_strat('l')} SELECT * FROM sp""")
def ann_dataset(spark, sf):
    """Approximate neighbours as unordered pairs, 500 of them, labelled and split."""
    v = _vectors(spark, sf)
    return builders.ann_pairs(_clusters(spark, sf), 5, 500, SEED, lambda _: v, sampling.take(v, 16, SEED, ["id"]), 12)


@query(f"WITH {D} SELECT i, j FROM d WHERE score >= 0.3")
def dense_threshold_pairs(spark, sf):
    v = _vectors(spark, sf)
    return builders.dense_candidates(v, 5, lambda _: v, 0.3)


@query(f"SELECT j AS i, i AS j FROM ({ORACLES['dense_topk_anchors']})")
def neighbour_first_pairs(spark, sf):
    """Pairs of sampled anchors, the neighbour first."""
    return dense_topk_anchors(spark, sf).select(F.col("j").alias("i"), F.col("i").alias("j"))


@query(f"WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id < 20), s AS (SELECT a.id AS i, b.id AS j, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.id <> b.id) SELECT i, j, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank FROM s")
def dense_topk_clamped(spark, sf):
    """More neighbours asked than there are: all of them (the table is the first 20 ids, by design smaller than k)."""
    return vectors.dense_topk(_vectors(spark, sf).filter("id < 20"), 10_000).select("i", "j", "rank")


@query(f"WITH docs AS (SELECT doc_id AS id, text FROM documents), {_tfidf_sql(min_df=3, most='ORDER BY total DESC, term LIMIT 500')} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM ww")
def tfidf_max_features(spark, sf):
    """Weights over the 500 most frequent of the terms in three documents or more."""
    docs = _docs(spark, sf)
    counts = tfidf.term_counts(docs, "id", "text")
    held = tfidf.weights(counts, tfidf.vocabulary(counts, docs.count(), min_df=3, max_features=500))
    return held.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@query("SELECT doc_id, min(lang) AS lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1 ORDER BY 1")
def pool_records(spark, sf):
    """Records of a pool of ids, one each, by id."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang").join(_t(spark, sf, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return gold.first_per_key(docs.withColumn("_key", F.col("doc_id").cast("string")), "_key", ["lang"]).select("doc_id", "lang").orderBy("doc_id")


@query(f"SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS canonical_int, c_name, '' AS city, 'COL c_name VAL ' || {NORM.format('c_name')} || ' COL city VAL ' AS record_text FROM customer WHERE c_nationkey % 5 <> 0")
def gold_own_clusters(spark, sf):
    """Raw rows that have clusters use their own; a missing text field is empty."""
    raw = _t(spark, sf, "customer").withColumn("canonical_int", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")))
    return gold.build_gold(raw, raw.select(F.lit("x").alias("name"), F.lit("1").alias("canonical_int")), ["c_name", "city"], keep=["c_custkey"])


@query("SELECT c_custkey, len(list_distinct(list_transform(range(1, greatest(length(c_name) - 1, 1)), lambda k: substring(lower(c_name), k, 3)))) AS n_grams FROM customer")
def plain_ngrams(spark, sf):
    """Distinct 3-grams of texts as they are; shorter texts have none."""
    return _t(spark, sf, "customer").select("c_custkey", F.size(tx.char_ngrams(F.col("c_name"), 3, strip=False, short="drop")).cast("long").alias("n_grams"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w, i: CASE WHEN (i + p_partkey) % 2 = 0 THEN w ELSE '[MASK]' END), ' ') AS masked FROM part")
def masked_words(spark, sf):
    mask = F.transform(F.split("p_name", " "), lambda w, i: F.when((i + 1 + F.col("p_partkey")) % 2 == 0, 1).otherwise(0))
    return _t(spark, sf, "part").select("p_partkey", tx.mask_words(F.col("p_name"), mask).alias("masked"))


@query("SELECT doc_id, 'COL text VAL ' || trim(coalesce(text, '')) || ' COL lang VAL ' || trim(coalesce(lang, '')) AS record_text FROM documents")
def record_text_plain(spark, sf):
    """Record text whose values keep their inner white space."""
    docs = _t(spark, sf, "documents").select("doc_id", "text", "lang")
    return docs.select("doc_id", tx.record_text_except(docs.columns, ["doc_id"], strip_only=True).alias("record_text"))


@query(f"""WITH r AS (SELECT 'COL name VAL ' || {NORM.format('p_name')} AS text1, 'COL name VAL ' || {NORM.format('p_type')} AS text2, p_size % 2 AS label, p_partkey AS id FROM part WHERE p_size % 7 <> 0),
  k AS (SELECT *, row_number() OVER (ORDER BY {ANCHOR}, id) AS k, count(*) OVER () AS n FROM r)
  SELECT text1, text2, CAST(label AS INTEGER) AS label, CASE WHEN k <= greatest(1, floor(n * CAST(0.6 AS DOUBLE))) THEN 'train' WHEN k <= greatest(1, floor(n * CAST(0.6 AS DOUBLE))) + greatest(1, floor(n * CAST(0.2 AS DOUBLE))) THEN 'valid' ELSE 'test' END AS split FROM k""")
def imported_pairs(spark, sf):
    """A table of labelled pairs with prefixed columns; a seventh of the labels is no number."""
    label = F.when(F.col("p_size") % 7 == 0, F.lit("x")).otherwise((F.col("p_size") % 2).cast("string"))
    rows = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("ltable.name"), F.col("p_type").alias("rtable.name"), label.alias("label"))
    return builders.imported_pairs(rows, seed=SEED)


@query(f"""WITH rec AS (SELECT vec_id AS id, c_name AS text, c_mktsegment AS cluster FROM embeddings JOIN customer ON vec_id = c_custkey), {V}, {S}, d AS (SELECT i, j FROM s WHERE i IN (SELECT id FROM rec) AND j IN (SELECT id FROM rec) QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, j) <= 5),
  g AS (SELECT DISTINCT id, substring(lower(trim(text)), CAST(k AS BIGINT), 3) AS key FROM rec, LATERAL (SELECT unnest(range(1, greatest(length(trim(text)) - 1, 2))) AS k)),
  k AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY key ORDER BY md5(concat_ws('|', '7', key, CAST(id AS VARCHAR))), key, id) <= 100),
  u AS (SELECT a.id AS i, b.id AS j FROM k a JOIN k b ON a.key = b.key AND a.id < b.id UNION SELECT least(i, j), greatest(i, j) FROM d),
  h AS (SELECT i, j, CAST(x.cluster = y.cluster AND x.cluster <> '' AS INTEGER) AS label FROM u JOIN rec x ON x.id = i JOIN rec y ON y.id = j),
  np AS (SELECT count(*) AS p FROM h WHERE label = 1), rk AS (SELECT i, j, label, row_number() OVER (PARTITION BY label ORDER BY {H}, i, j) AS k FROM h), l AS (SELECT i, j, label FROM rk, np WHERE label = 1 OR k <= round_even(p * 0.7 / 0.3, 0)), {_strat('l')} SELECT * FROM sp""")
def hybrid_builder(spark, sf):
    """n-gram blocks of 100 rows at most and nearest vectors, united, resampled and split."""
    v = _vectors(spark, sf)
    records = v.select("id").join(_t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("text"), F.col("c_mktsegment").alias("cluster")), "id")
    return builders.hybrid_pairs(records, "union", 5, 0.3, SEED, 100, lambda r: v.join(r.select("id"), "id", "left_semi"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf):
    """The table as CSV files, by id, read back with inferred types."""
    path = scratch_dir(spark)
    writers.write_csv(_t(spark, sf, "customer"), path, order=["c_custkey"])
    back = readers.read_csv(spark, path, infer=True)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("SELECT p_partkey, coalesce(p_name, '') AS p_name, coalesce(p_brand, '') AS p_brand FROM part WHERE p_partkey % 10 <> 3")
def ids_tsv(spark, sf):
    """A tab-separated table, a tenth of whose ids is no number; missing text is empty."""
    path = scratch_dir(spark)
    part = _t(spark, sf, "part").select(F.when(F.col("p_partkey") % 10 == 3, F.lit("bad")).otherwise(F.col("p_partkey").cast("string")).alias("id"), "p_name", "p_brand")
    writers.write_csv(part, path, sep="\t")
    return readers.read_ids_tsv(spark, path).select(F.col("id").alias("p_partkey"), F.coalesce("p_name", F.lit("")).alias("p_name"), F.coalesce("p_brand", F.lit("")).alias("p_brand"))


@query(f"WITH {D} SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM d")
def truth_file(spark, sf):
    """Truth pairs as a tab-separated file of quoted ids, read back with the smaller id first."""
    path = scratch_dir(spark)
    quoted = _dense(spark, sf).select(*(F.concat(F.lit(" "), F.col(c).cast("string")).alias(n) for c, n in (("i", "id1"), ("j", "id2"))))
    quoted.write.option("header", True).option("sep", "\t").option("quoteAll", True).csv(path)
    return readers.read_truth(spark, path)


def _pair_lines(spark, sf, label) -> tuple[str, DataFrame]:
    path = scratch_dir(spark)
    part = _t(spark, sf, "part").select(F.col("p_name").alias("text1"), F.col("p_type").alias("text2"), label.alias("label"), F.when(F.col("p_partkey") % 10 == 0, "test").otherwise("train").alias("split"))
    writers.write_pairs(part, path)
    return path, part


@query("SELECT trim(p_name) AS \"left\", trim(p_type) AS \"right\", CAST(p_size AS INTEGER) AS label FROM part")
def pair_files(spark, sf):
    """Pair files of two splits, read back strictly."""
    path, _ = _pair_lines(spark, sf, F.col("p_size"))
    return readers.read_pairs(spark, [f"{path}/split=train", f"{path}/split=test"])


@query("SELECT trim(p_name) AS \"left\", trim(p_type) AS \"right\", CAST(p_size AS INTEGER) AS label FROM part WHERE p_size % 3 <> 0")
def pair_files_lenient(spark, sf):
    """Lines whose label is no number are skipped."""
    path, _ = _pair_lines(spark, sf, F.when(F.col("p_size") % 3 == 0, F.lit("?")).otherwise(F.col("p_size").cast("string")))
    return readers.read_pairs(spark, [f"{path}/split=train", f"{path}/split=test"], "lenient")


@query("SELECT trim(p_name) AS \"left\", trim(p_type) AS \"right\", CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS INTEGER) END AS label FROM part")
def pair_files_to_score(spark, sf):
    """Lines whose label is missing or no number have none."""
    path, _ = _pair_lines(spark, sf, F.when(F.col("p_size") % 3 == 0, F.lit("-1")).otherwise(F.col("p_size").cast("string")))
    return readers.read_pairs(spark, [f"{path}/split=train", f"{path}/split=test"], "score")


@query(f"""WITH {P} SELECT i, j, label, pred, CASE WHEN label = 1 AND pred = 1 THEN 'TP' WHEN pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS source FROM p""")
def outcome_files(spark, sf):
    """Scored pairs as one folder of CSV files for each outcome, read back."""
    path = scratch_dir(spark)
    writers.write_outcomes(_scored(spark, sf).select("i", "j", "label", "pred"), path)
    return readers.read_csv(spark, path, "i long, j long, label int, pred int, source string")


@query(f"SELECT * FROM ({ORACLES['confusion_metrics']})")
def metrics_json(spark, sf):
    path = scratch_dir(spark)
    writers.write_json(confusion_metrics(spark, sf), path)
    return spark.read.schema("tp long, fp long, tn long, fn long, precision double, recall double, f1 double, accuracy double").json(path)


@query(f"""SELECT unnest(['n: ' || CAST(n AS VARCHAR), 'n_match: ' || CAST(n_match AS VARCHAR), 'mean: ' || printf('%.6f', mean)]) AS line FROM ({ORACLES['prob_summary']})""")
def report_lines(spark, sf):
    path = scratch_dir(spark)
    writers.write_report(prob_summary(spark, sf).select("n", "n_match", "mean"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT vec_id AS id, len(embedding) AS n FROM embeddings")
def cached_vectors(spark, sf):
    """Vectors encoded and stored on the first call, read on the second."""
    path, v = scratch_dir(spark), _vectors(spark, sf)
    builders.encode.cached(path, v, lambda _: v)
    return builders.encode.cached(path, v, lambda _: v.limit(0)).select("id", F.size("vec").cast("long").alias("n"))
