"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import components, exact_dedup, mixing, packing, quality, shingle_links, simhash, substring_dedup, suffix_array, token_counts, topk, toxicity, warc
from pairloom.llm.common import load_tokenizer, tokenizer_file

SPACES = re.compile(r"[\x20\x09-\x0D]")


def texts():
    rng = random.Random(5)
    raw = {}
    for i in range(150):
        raw[i] = "".join(rng.choice(["ab ", "é", "c", "xyz", "\n", " the", "  ", "Q, "]) for _ in range(rng.randint(0, 60)))
        if i % 7 == 0 and i:
            raw[i] = raw[rng.randrange(i)][: rng.randint(0, 80)] + raw[i]
    raw |= {200: None, 201: "a" * 500, 202: "ab" * 100 + "q", 203: raw[5], 204: raw[5] + " ", 205: "", 206: "a <|endoftext|>  b\n\n  c \x1c d'll  　 \n x  ", 207: " \na a", 208: "a a " * 2000}
    return raw


RAW = texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that operators use themselves."""
    rows = [(k, v, f"s{k % 4}" if k % 9 else None, "x", 1, "y") for k, v in RAW.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, word string, block int, key string").repartition(5)


def utf8(x):
    return (x or "").encode()


def test_token_counts(docs):
    tok = load_tokenizer(tokenizer_file())
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs).collect()}
    assert set(got) == set(RAW)
    for k, x in RAW.items():
        n = len(tok.encode(x or "", add_special_tokens=False).ids)
        assert (got[k]["n_bytes"], got[k]["n_tokens"], got[k]["over_limit"]) == (len(utf8(x)), n, n > 1024)


def test_packing(spark, docs):
    tok = load_tokenizer(tokenizer_file())
    by, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs).collect():
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(by) == set(RAW)
    for k, x in RAW.items():
        ids, at = [*tok.encode(x or "", add_special_tokens=False).ids, 2], 0
        for i, r in enumerate(sorted(by[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at) and 0 < r["length"] <= 1024
            assert i == 0 or r["length"] == 1024
            assert zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for p in by.values() for r in p)
    assert len(sequences) <= -(-total // 1024) + 1


def test_bin_plan():
    rng = random.Random(1)
    for _ in range(50):
        counts = Counter(rng.randint(1, 100) for _ in range(rng.randint(1, 400)))
        plan = packing.plan_bins(counts, 100)
        used = Counter()
        for use, times in plan:
            assert sum(k * n for k, n in use.items()) <= 100
            used += Counter({k: n * times for k, n in use.items()})
        assert used == counts
    assert packing.fullest({7: 2, 5: 1, 3: 1}, 13) == {7: 1, 5: 1} or sum(k * n for k, n in packing.fullest({7: 2, 5: 1, 3: 1}, 13).items()) == 12


def test_exact_dedup(spark, docs):
    groups, want = defaultdict(list), {}
    for k, x in RAW.items():
        groups[hashlib.sha256(SPACES.sub("", x or "").encode()).hexdigest()].append(k)
    for h, ks in groups.items():
        best = min(ks, key=lambda k: (-len(RAW[k] or ""), k))
        want |= {k: (k, best, len(ks), k == best, h) for k in ks}
    assert {r["doc_id"]: tuple(r) for r in exact_dedup.exact_dedup(docs).collect()} == want
    past = spark.createDataFrame([(900, RAW[5]), (901, "not in docs")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs, past).collect()}
    assert got[5]["keep_id"] == got[203]["keep_id"] == 900 and not got[5]["kept"] and got[1]["kept"]
    again = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x")], "doc_id long, text string")
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(again).collect()) == [(1, 3, False), (1, 3, False), (1, 3, True)]


def test_perfect_hash(spark):
    rng = np.random.default_rng(3)
    low = rng.integers(-(2**63), 2**63 - 1, 5000)
    buckets = rng.integers(0, 1250, 5000)
    slots = exact_dedup.hash_longs(low, exact_dedup.perfect_hash(low, buckets)[buckets]) % 5000
    assert sorted(slots.tolist()) == list(range(5000))
    df = spark.createDataFrame([(int(x), 7) for x in low[:50]], "a long, b long")
    assert [r[0] for r in df.select(F.xxhash64("a", "b")).collect()] == exact_dedup.hash_longs(low[:50], np.full(50, 7)).tolist()


def test_simhash(spark, docs):
    import xxhash

    def fingerprint(x):
        words = re.findall(rb"[^\x20\x09-\x0D]+", utf8(x).lower())
        if not words:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))

    fps = {k: fingerprint(v) for k, v in RAW.items()}
    root = classes(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r["doc_id"]: r for r in simhash.near_dedup(docs).collect()}
    assert all(int(got[k]["fingerprint"], 16) == fps[k] and got[k]["component_id"] == root[k] for k in RAW)


def classes(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize(("tile", "blocks"), [(16, (4, 1)), (16, (6, 3)), (8192, (5, 2))])
def test_simhash_links_with_large_buckets(spark, tile, blocks):
    rng = random.Random(1)
    base, found = rng.getrandbits(64), set()
    for _ in range(150):
        x = base
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        found |= {x, rng.getrandbits(64)}
    fps = sorted(found)
    root = classes(list(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    rows = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps)], "v long, fp long")
    label = {r["v"]: r["label"] for r in components.connected_components(simhash.links(rows, 3, tile, blocks)).collect()}
    assert all(label.get(i, i) == root[i] for i in range(len(fps)))


def near_texts():
    """Copies edited around a similarity of 0.8, many of one text, and texts that share half of their words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    bases, out = [[word() for _ in range(rng.randint(3, 160))] for _ in range(12)], {}
    for i in range(160):
        t = list(bases[0] if i % 2 else rng.choice(bases))
        for _ in range(rng.randint(0, max(1, len(t) // 40))):
            t[rng.randrange(len(t))] = word()
        out[i] = " ".join(t)
    half = [word() for _ in range(90)]
    out |= {300 + i: " ".join(half + [word() for _ in range(40)]) for i in range(30)}
    return out | {400: None, 401: "", 402: " \n", 403: out[1].upper(), 404: "one", 405: "one two"}


@pytest.mark.parametrize("tile", [4, 512])
def test_similar_classes(spark, tile):
    raw = near_texts()
    sets = {}
    for k, x in raw.items():
        w = utf8(x).lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = classes(sorted(raw), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    assert 20 < len(set(root.values())) < len(raw) - 20
    rows = spark.createDataFrame([*raw.items(), (None, raw[1])], "doc_id long, text string")
    none = spark.createDataFrame([], "a long, b long")
    label = {r["v"]: r["label"] for r in shingle_links.similar_classes(rows, none, tile=tile, share=tile).collect()}
    assert {k: label.get(k, k) for k in raw} == root
    chained = shingle_links.similar_classes(rows, spark.createDataFrame([(404, 405)], "a long, b long"), tile=tile, share=tile)
    assert (405, 404) in set(map(tuple, chained.collect()))


def test_search_across_classes_of_a_bucket():
    import pyarrow as pa

    grams = [list(range(10)), list(range(9)), list(range(100, 110)), list(range(1, 10)), list(range(101, 111))]
    table = pa.table({"t": [0] * 5, "key": [0] * 5, "g": [0] * 5, "h": [0] * 5, "v": range(5), "root": range(5), "tile": [0] * 5, "grams": pa.array(grams, pa.list_(pa.int32()))})
    found = shingle_links._across(0.8)(table).to_pydict()
    assert list(zip(found["a"], found["b"], strict=True)) == [(1, 0), (3, 0), (4, 2)]


def test_drop_near_keeps_one_of_each_class(spark):
    raw = near_texts()
    rows = spark.createDataFrame([(k, v, 1, 2, 3) for k, v in raw.items()] + [(None, raw[1], 1, 2, 3)], "doc_id long, text string, v int, grams int, label int")
    kept = simhash.drop_near(rows)
    ids = [r["doc_id"] for r in kept.collect()]
    linked = simhash.near_dedup(rows).filter("doc_id is not null").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).filter("a <> b")
    label = {r["v"]: r["label"] for r in shingle_links.similar_classes(rows, linked).collect()}
    assert kept.columns == rows.columns and sorted(ids) == [k for k in sorted(raw) if label.get(k, k) == k]


def test_components_of_a_long_chain(spark):
    label = components.connected_components(spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    assert {r["label"] for r in label.collect()} == {0} and label.count() == 201


def test_suffix_array():
    for trial in range(150):
        rng = random.Random(trial)
        s = bytes(rng.randint(1, rng.choice([1, 2, 26])) for _ in range(rng.randint(1, 100)))
        s = s[:9] * rng.randint(1, 9) if trial % 3 == 0 else s
        t = np.frombuffer(s + b"\0", np.uint8)
        order, b = suffix_array.suffix_array(t), t.tobytes()
        expected = sorted(range(len(b)), key=lambda i: b[i:])
        assert order.tolist() == expected == suffix_array.suffix_array(t.astype(np.int64)).tolist()
        common = suffix_array.common_prefixes(t, order, 50)
        for x, y in zip(expected, expected[1:], strict=False):
            n = 0
            while n < 50 and max(x, y) + n < len(b) and b[x + n] == b[y + n]:
                n += 1
            assert common[y] == n


def substring_want(raw, width):
    seen, want = Counter(), {}
    for x in raw.values():
        b = utf8(x)
        seen.update(b[i : i + width] for i in range(len(b) - width + 1))
    for k, x in raw.items():
        b = utf8(x)
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        want[k] = (k, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return want


@pytest.mark.parametrize(("width", "most", "bits"), [(20, 1024, 64), (31, 2, 64), (20, 2, 11)])
def test_substring_dedup(docs, monkeypatch, width, most, bits):
    """Also with shards that are split and with texts that share keys."""
    monkeypatch.setattr(substring_dedup, "_MOST", most)
    monkeypatch.setattr(substring_dedup, "_KEY_BITS", bits)
    assert {r["doc_id"]: tuple(r) for r in substring_dedup.substring_dedup(docs, width).collect()} == substring_want(RAW, width)
    assert not [t for t in docs.sparkSession.catalog.listTables() if t.name.startswith("pairloom")]


def test_substring_dedup_of_a_common_passage(spark, monkeypatch):
    """200-byte strings; a passage in many surroundings, cut at many places, and one text of over a MiB."""
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage, long = some(420), some(1_300_000)
    raw = {i: some(rng.randint(0, 300)) + passage[rng.randint(0, 60) :][: rng.randint(150, 420)] + some(rng.randint(0, 300)) for i in range(300)}
    raw |= {900: long, 901: "x" + long[700_000:700_260] + "y", 902: long[:199], 903: long[1_299_790:], 904: passage}
    rows = spark.createDataFrame(list(raw.items()), "doc_id long, text string").repartition(6)
    want = substring_want(raw, 200)
    monkeypatch.setattr(substring_dedup, "_MOST", 20)
    assert {r["doc_id"]: tuple(r) for r in substring_dedup.substring_dedup(rows).collect()} == want


def test_top_k(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(120)] + [(200, None), (250, [1.0, None]), (300, [float("nan")] * 8), (350, [0.5, -0.25]), (351, [0.5, -0.25]), (352, [0.5, 0.25]), (400, []), (401, []), (450, [0.0] * 8)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    want, by = [], defaultdict(list)
    for r in vectors.collect():
        if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]):
            by[len(r[1])].append((r[0], [int(np.floor(256.0 * x)) for x in r[1]]))
    for rows in by.values():
        for i, q in rows:
            if i % 50 == 0:
                best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i)[:5]
                want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    got = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_of_wide_vectors(spark):
    """Components of 2**30 and more after scaling, exact to the last digit; what does not fit a long is an error."""
    rng = random.Random(4)
    data = [(i, [float(rng.randint(-(2**e), 2**e)) for e in (18, 18, 17, 3)]) for i in range(90)] + [(90, [2.0**23 + 1, 0.0, 0.0, 1.0]), (91, [1.0, -(2.0**28), 0.5, 0.25]), (100, [-1.0, 1.0, 1.0, 2.0]), (150, [2.0**23, -3.0, 1.0, 1.0])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    q = {i: [int(np.floor(256.0 * x)) for x in v] for i, v in data}
    want = []
    for i in (0, 50, 100, 150):
        best = sorted((-sum(a * b for a, b in zip(q[i], v, strict=True)), j) for j, v in q.items() if j != i)[:5]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(vectors, vectors.filter("vec_id % 50 = 0")).collect())) == sorted(want)
    for far in ([2.0**40] * 4, [2.0**60] * 4):
        wide = spark.createDataFrame([(1, far), (2, far)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(wide, wide).collect()


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200
    pages = spark.createDataFrame([(3, "http://a/ b", big), (1, None, big), (2, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", big), (7, "u", "é" * 60)], "page_id long, url string, html string")
    records = {r["page_id"]: r for r in warc.read_archive(spark, warc.write_archive(pages)).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in records.items()} == {1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1)} | {k: ("response", None) for k in (2, 4, 5, 6, 7)}
    assert bytes(records[1]["record"]).endswith(b"\r\n\r\n" + big.encode() + b"\r\n\r\n") and b"WARC-Target-URI: http://a/%20b\r\n" in bytes(records[3]["header"])
    assert (records[7]["payload_bytes"], records[7]["payload_digest"]) == (120, hashlib.sha256(("é" * 60).encode()).hexdigest())


def test_mixing(spark, docs):
    out = mixing.mix_report(docs).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        source = f"s{r['doc_id'] % 4}" if r["doc_id"] % 9 else None
        words = len(re.findall(r"[^\x20\x09-\x0D]+", RAW[r["doc_id"]] or ""))
        assert r["size"] == words and 0 <= r["taken"] <= 2 * words
        size[source] += words
        taken[source] += r["taken"]
        target[source] = r["target"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in order] == pytest.approx(mixing.targets([size[s] for s in order], [3, 1, 2, 3, 1]))
    largest = {s: max(r["size"] for r in out if (f"s{r['doc_id'] % 4}" if r["doc_id"] % 9 else None) == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= max(40, 0.05 * target[s], largest[s]) for s in order)
    assert [target[s] for s in order] == pytest.approx(plain_targets([size[s] for s in order], [3, 1, 2, 3, 1]))
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.mix_report(docs).collect()), key=repr)
    mixed = mixing.mix(docs, shards=4)
    copies = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed.columns == docs.columns and all(copies.get(r["doc_id"], 0) == len(r["shards"]) for r in mixing.mix_report(docs, shards=4).collect())


def plain_targets(sizes, weights):
    """Raise a common level in small steps; a source stops at twice its size."""
    low, high = 0.0, 3.0 * sum(sizes)
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(2 * s, level * w) for s, w in zip(sizes, weights, strict=True)) < 1.5 * sum(sizes):
            low = level
        else:
            high = level
    return [min(2 * s, high * w) for s, w in zip(sizes, weights, strict=True)]


CLASHES = ["bits", "cut", "target", "left", "sid", "label", "score", "held_out", "row", "_h", "_shard", "digest", "fp", "v", "grams", "a", "b", "keep_id"]


def clashing(spark, rows):
    """doc_id, text, source and columns that operators have names for themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


def test_stages_with_clashing_columns(spark):
    rows = [(i, f"word{i} other{i % 7} third{i % 5} more{i}", f"s{i % 3}") for i in range(60)] + [(None, "n one", None), (None, "n two", None), (None, "n two", None), (5, "", ""), (6, None, "s1"), (6, None, "s1")]
    docs = clashing(spark, rows)
    slots = np.array(sorted(plain_grams("bad idiot") - plain_grams("")))
    model = toxicity.Model(slots, np.ones(len(slots)), -9.0)
    clean = toxicity.drop_toxic(docs, model)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert toxicity.drop_toxic(clashing(spark, [(1, "a BAD idiot", "x"), (1, "fine day", "x"), (2, None, "x")]), model).count() == 2
    assert toxicity.drop_toxic(docs.limit(0), model).count() == 0
    for run in (exact_dedup.drop_exact, simhash.drop_near):
        assert run(docs).columns == docs.columns and run(docs).count() == len({(t or "") for _, t, _ in rows})
    mixed = mixing.mix(docs, shards=3)
    copies = Counter(tuple(r)[:3] for r in mixed.collect())
    told = Counter()
    for r in mixing.mix_report(docs, shards=3).collect():
        told[r["doc_id"]] += len(r["shards"])
    assert mixed.columns == docs.columns and copies.total() == told.total() and all(n <= 2 * sum(1 for x in rows if x == k) for k, n in copies.items())
    assert packing.pack(docs).select("doc_id", "piece").count() == len(rows)
    q = quality.train(["a good line"] * 6 + ["!!!"] * 6, np.array([1.0] * 6 + [0.0] * 6), np.ones(12))
    assert quality.quality(docs, q).count() == toxicity.toxicity(docs, model).count() == len(rows)


def test_mixing_of_rows_without_ids(spark):
    """A source of rows that share a null id is mixed to its target, text by text."""
    docs = spark.createDataFrame([(None, f"w{i} x y", "a") for i in range(500)] + [(i, "p q r", "b") for i in range(500)], "doc_id long, text string, source string")
    got = {r["target"]: r["n"] for r in mixing.mix_report(docs).groupBy("target").agg(F.sum("taken").alias("n")).collect()}
    assert len(got) == 2 and all(abs(n - t) <= 3 for t, n in got.items())
    assert mixing._most_bits([1 << 40] * 20) == 13 and mixing._most_bits([100]) == 16


def test_quota_tree():
    quotas = [40, 0, 7, 13]
    shards = mixing.split_quotas(quotas, 7, 3)
    assert [sum(c) for c in zip(*shards, strict=True)] == quotas
    assert max(map(sum, shards)) - min(map(sum, shards)) <= 2
    rng = random.Random(0)
    draws = [mixing.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.4
    assert mixing.targets([10, 100], [3, 1]) == [20, 145]


@pytest.mark.parametrize(("module", "query", "label"), [(toxicity, "toxicity", "toxic"), (quality, "quality", "quality")])
def test_classifiers_on_held_out_rows(spark, module, query, label):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = getattr(module, query)(docs, module.fit(docs, labels, per_class=400)).join(labels, "doc_id")
    rows = got.filter("held_out").select("score", "predicted", label).collect()
    assert np.mean([r["predicted"] == r[label] for r in rows]) > 0.95
    crc = {r["doc_id"]: r["held_out"] for r in got.select("doc_id", "held_out").limit(50).collect()}
    assert all(v == (zlib.crc32(str(k).encode()) % 4 == 2) for k, v in crc.items())


def test_classifiers_edge_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (1, 0, 1)], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, "idiot"), (1, "idiot"), (None, None), (3, "")], "doc_id long, text string")
    for module, query in ((toxicity, "toxicity"), (quality, "quality")):
        for known in (labels, labels.limit(0)):
            model = module.fit(docs, known)
            assert getattr(module, query)(odd, model).filter("score between 0 and 1").count() == 4
            assert getattr(module, query)(odd.limit(0), model).count() == 0


def plain_grams(text):
    """The hashed n-grams of one text, one at a time."""
    def mix(c):
        h = c * 0x9E3779B1 & 0xFFFFFFFF
        return (h ^ h >> 15) + 1 & 0xFFFFFFFF

    seq, out = [mix(c) for c in [0] * 4 + [ord(c) for c in text.lower()] + [0] * 4], set()
    for n in (3, 4, 5):
        for i in range(len(seq) - n + 1):
            h = seq[i]
            for x in seq[i + 1 : i + n]:
                h = (h * 0x2C1B3C6D + x) & 0xFFFFFFFF
            h ^= h >> 16
            out.add((h * 0x85EBCA6B & 0xFFFFFFFF) >> 10)
    return out


def test_toxicity_against_plain_scoring(monkeypatch):
    rng = random.Random(4)
    data = ["".join(rng.choice("abcdeéΣ xyİ") for _ in range(rng.randint(0, 120))) for _ in range(80)] + ["", "a", "Σ"]
    y = np.array([float("ab" in t) for t in data])
    model = toxicity.train(data, y, np.ones(len(data)), features=300)
    weight = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
    want = [1 / (1 + np.exp(-(model.bias + sum(weight.get(g, 0.0) for g in plain_grams(t))))) for t in data]
    assert np.allclose(toxicity.score(data, model), want)
    assert np.allclose([toxicity.score([t], model)[0] for t in data], want)
    monkeypatch.setattr(toxicity, "_WINDOW", 7)
    assert np.allclose(toxicity.score(data, model), want)


def plain_lines(text):
    """The features of a text's lines but those of neighbours, one line at a time."""
    out, seen, before = [], set(), None
    for line in text.encode().split(b"\n"):
        words = re.findall(rb"[^ \t\x0b\x0c\r]+", line)
        n, per = max(1, len(line)), max(1, len(words))
        kinds = [sum(c in k for c in line) for k in quality._CLASSES]
        counts = [*kinds, len(line) - sum(kinds)]
        fresh = 0
        for w in words:
            if before is not None and (before, w) not in seen:
                seen.add((before, w))
                fresh += 1
            before = w
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        out.append([np.log1p(len(line)), np.log1p(len(words)), *(c / n for c in counts), len(line) / per / 10, len(set(words)) / per, same / per, min(1, fresh / per), counts[4] / per, counts[5] / per, counts[6] / per, len(line) == 0])
    return np.array(out, float)


def test_quality_against_plain_scoring():
    rng = random.Random(6)
    some = lambda n, gap: "".join("\n" if rng.random() < gap else rng.choice(["ab ", "é", "c", "xyz", "the ", " ", "\t", "Q, ", "ab ab ", "!!", "7|"]) for _ in range(n))
    data = [some(rng.randint(0, 300), gap) for gap in (0, 0.02, 0.1, 0.5) for _ in range(25)] + ["", "\n"]
    rows = [plain_lines(t) for t in data]
    base, n_lines, length = quality.base_of([t.encode() for t in data])
    assert np.allclose(base, np.concatenate(rows)) and n_lines.tolist() == [len(r) for r in rows]
    for t, r in zip(data, rows, strict=True):
        for window in (64, 1000):
            got = list(quality.long_base(t.encode(), window))
            assert np.allclose(np.concatenate([b for b, _ in got]), r) or max(map(len, t.encode().split()), default=0) >= window
    k = 3 * base.shape[1] + 2
    draw = np.random.default_rng(1)
    model = quality.Model(draw.normal(size=k), 1 + draw.random(k), 0.3 * draw.normal(size=2 * (k + 1) + 4), 1.0, 0.0)
    score, lines, bad = quality.raw_scores(data, model)
    u, trans = model.weights[: 2 * k + 2].reshape(-1, 2), model.weights[2 * k + 2 :].reshape(2, 2)
    for i, r in enumerate(rows):
        none = np.zeros((1, r.shape[1]))
        ends = np.zeros((len(r), 2))
        ends[0, 0] = ends[-1, 1] = 1
        x = np.c_[r, np.r_[none, r[:-1]], np.r_[r[1:], none], ends]
        unary = ((x - model.mean) / model.scale) @ u[:-1] + u[-1]
        alpha, beta = [unary[0]], [np.zeros(2)]
        for v in unary[1:]:
            alpha.append(v + np.array([np.logaddexp(*(alpha[-1] + trans[:, j])) for j in (0, 1)]))
        for v in unary[:0:-1]:
            beta.insert(0, np.array([np.logaddexp(*(trans[j] + v + beta[0])) for j in (0, 1)]))
        both = np.array(alpha) + np.array(beta)
        p = 1 / (1 + np.exp(both[:, 0] - both[:, 1]))
        w = [max(1, len(x)) for x in data[i].encode().split(b"\n")]
        assert np.isclose(score[i], np.average(p, weights=w)) and lines[i] == len(r) and bad[i] == (p < 0.5).sum()
        for piece in (1, 3, 256):
            assert np.allclose(quality.long_score(data[i].encode(), model, 0, piece), (score[i], len(r), bad[i]), atol=1e-4)


def test_both_encoders_agree_on_every_code_point():
    """The rank-merging encoder gives the tokenizer file's ids whatever class a character has."""
    from pairloom.llm.common import load_ranks

    tok, ranks = load_tokenizer(tokenizer_file()), load_ranks(tokenizer_file())
    points = [*range(0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200), *range(0x32400, 0x110000, 97)]
    for k in range(0, len(points), 20_000):
        text = [f"x{c}y 1{c}2 {c}-{c} {c}{c}\n{c}  {c}" for c in map(chr, points[k : k + 20_000])]
        assert [e.ids for e in tok.encode_batch_fast(text, add_special_tokens=False)] == [ranks.encode_ordinary(t) for t in text]


def test_fullest_bins_against_every_choice():
    from itertools import product

    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 60)
        best = max(s for s in (sum(k * n for k, n in zip(counts, pick, strict=True)) for pick in product(*(range(n + 1) for n in counts.values()))) if s <= room)
        use = packing.fullest(counts, room)
        assert sum(k * n for k, n in use.items()) == best and all(n <= counts[k] for k, n in use.items())


def test_a_pre_token_of_very_many_blocks():
    import pyarrow as pa

    n = 3000
    posting = np.array([(3, 2), (9, 1)], token_counts._POSTING).tobytes()
    batch = pa.record_batch([pa.array(list(range(n)) * 2), pa.array([" the"] * n + [" zzq"] * n), pa.array([posting] * (2 * n))], ["block", "word", "data"])
    tok, got = load_tokenizer(tokenizer_file()), defaultdict(lambda: np.zeros(16, int))
    for out in token_counts._join_counts(tokenizer_file())(iter([batch])):
        assert out.num_rows <= 3 * token_counts._FLUSH
        for r in out.to_pylist():
            s = np.frombuffer(r["data"], "<i8")
            got[r["block"]][: len(s)] += s
    worth = sum(len(tok.encode(w, add_special_tokens=False).ids) for w in (" the", " zzq"))
    assert len(got) == n and all(v[3] == 2 * worth and v[9] == worth and v.sum() == 3 * worth for v in got.values())


def test_links_through_rows_without_id(spark):
    words = "".join(f"w{i} " for i in range(400)).split()
    texts = [" ".join(words[:k] + ["q"] + words[k + 1 :]) for k in range(0, 400, 8)]
    fps = [simhash.fingerprint(t) for t in texts]
    a, m, b = next((a, m, b) for a in range(50) for m in range(50) for b in range(a) if (fps[a] ^ fps[m]).bit_count() <= 3 >= (fps[m] ^ fps[b]).bit_count() and (fps[a] ^ fps[b]).bit_count() > 3)
    rows = spark.createDataFrame([(1, texts[a]), (None, texts[m]), (2, texts[b]), (None, "alone in the table")], "doc_id long, text string")
    assert sorted((r["component_id"] for r in simhash.near_dedup(rows).collect()), key=repr) == [1, 1, 1, None]


def test_ids_at_the_ends_of_long(spark):
    ends = [-(2**63), 2**63 - 1, 0]
    rows = spark.createDataFrame([(i, "x y") for i in ends], "doc_id long, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_dedup(rows).collect()} == {-(2**63)}


def test_line_field_prefers_the_right_lines():
    rng = random.Random(1)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(12))
    bad = lambda: "!!! $$$ ###" * rng.randint(2, 5)
    data = [("\n".join(good() for _ in range(rng.randint(1, 6))), 1) for _ in range(60)] + [("\n".join(bad() for _ in range(rng.randint(1, 6))), 0) for _ in range(60)]
    rng.shuffle(data)
    model = quality.train([t for t, _ in data], np.array([y for _, y in data], float), np.ones(len(data)))
    score, lines, wrong = quality.raw_scores([good(), bad(), "", "\n\n"], model)
    assert score[0] > 0.9 and score[1] < 0.1 and lines.tolist() == [1, 1, 1, 3] and wrong[0] == 0 and wrong[1] == 1


def test_forward_backward_against_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    n_lines = np.array([3, 1, 4])
    unary, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    log_z, p, pair = quality.marginals(unary, trans, n_lines, np.ones(8))
    start = np.cumsum(n_lines) - n_lines
    seen = np.zeros((2, 2))
    for s, n in zip(start, n_lines, strict=True):
        paths = list(product((0, 1), repeat=int(n)))
        w = np.exp([sum(unary[s + t, y] for t, y in enumerate(q)) + sum(trans[a, b] for a, b in zip(q, q[1:], strict=False)) for q in paths])
        assert np.isclose(log_z[s], np.log(w.sum()))
        for t in range(n):
            assert np.isclose(p[s + t, 1], sum(x for x, q in zip(w, paths, strict=True) if q[t]) / w.sum())
        for x, q in zip(w / w.sum(), paths, strict=True):
            for a, b in zip(q, q[1:], strict=False):
                seen[a, b] += x
    assert np.allclose(pair, seen)


@pytest.mark.parametrize("run", [token_counts.token_counts, packing.pack, exact_dedup.exact_dedup, simhash.near_dedup, substring_dedup.substring_dedup, mixing.mix_report, exact_dedup.drop_exact, simhash.drop_near, mixing.mix])
def test_empty_table(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_empty_vectors_and_pages(spark):
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(v, v).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(pages)).count() == 0


def test_null_ids_and_repeated_rows(spark):
    odd = spark.createDataFrame([(None, "x y z", None), (None, "x y z", None), (1, "x y z", "s"), (1, "x y z", "s"), (2, None, None)], "doc_id long, text string, source string")
    for run in (token_counts.token_counts, exact_dedup.exact_dedup, simhash.near_dedup, substring_dedup.substring_dedup, mixing.mix_report, packing.pack):
        assert run(odd).count() == 5


def test_drop_stages_tell_rows_apart(spark):
    """Repeated rows, one id with two texts, null ids; ``_row`` is a name the stages use themselves."""
    schema = "doc_id long, text string, _row int"
    exact = [(5, "x", 0), (5, "x", 1), (6, "a b", 2), (6, "c", 3), (7, "ab", 4), (None, "n", 5), (None, "n ", 6), (None, "m", 7), (None, "m", 8), (None, "x", 9), (None, None, 10), (8, "", 11)]
    got = exact_dedup.drop_exact(spark.createDataFrame(exact, schema).repartition(3))
    assert got.columns == ["doc_id", "text", "_row"]
    kept = [tuple(r) for r in got.collect()]
    assert sorted(map(repr, (r[:2] for r in kept))) == sorted(map(repr, [(5, "x"), (6, "a b"), (6, "c"), (None, "n "), (None, "m"), (8, "")]))
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    near = [(3, words[0], 0), (5, words[0].upper(), 1), (5, words[1], 2), (9, words[1], 3), (9, words[2], 4), (9, words[2], 5), (2, words[2] + " z", 6), (None, words[0], 7), (None, words[0], 8)]
    got = simhash.drop_near(spark.createDataFrame(near, schema).repartition(3))
    assert got.columns == ["doc_id", "text", "_row"]
    assert sorted(r["_row"] for r in got.collect()) == [0, 2, 6]
    twice = simhash.drop_near(spark.createDataFrame([(1, "p q", 0), (1, "p q", 1)], schema))
    assert twice.count() == 1


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, sf))
        assert docs.columns == columns and docs.count() > 0
        kept = sorted(r["doc_id"] for r in docs.collect())
        if name == "exact dedup":
            groups = defaultdict(list)
            for k, x in before.items():
                groups[SPACES.sub("", x)].append(k)
            assert kept == sorted(min(ks, key=lambda k: (-len(before[k]), k)) for ks in groups.values())
        if name == "simhash near-dedup":
            fps, sets = {k: simhash.fingerprint(x) for k, x in before.items()}, {}
            for k, x in before.items():
                w = utf8(x).lower().split()
                sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
            alike = lambda a, b: 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
            root = classes(sorted(before), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3 or alike(a, b))
            assert kept == [k for k in sorted(before) if root[k] == k] and len(kept) < len(before)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
