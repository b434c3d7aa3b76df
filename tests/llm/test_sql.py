"""Training-data queries with SQL give the same rows as DuckDB, on the smallest tables and on cases of their own."""

import os

import duckdb
import pytest

from pairloom.llm import substring_dedup
from pairloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def same(got, result):
    columns, names = sorted(got.columns), [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    same(QUERIES[name](spark, SF), con.execute(ORACLES[name]))


@pytest.mark.parametrize("sample", [3, 5000])
def test_frequent_anchors_dealt_by_kind(spark, monkeypatch, sample):
    """The same rows if every anchor that two texts share, or none but those of a few texts, is dealt by its kinds."""
    monkeypatch.setattr(substring_dedup, "_OFTEN", 2)
    monkeypatch.setattr(substring_dedup, "_SAMPLE", sample)
    found, common = [], substring_dedup._common
    monkeypatch.setattr(substring_dedup, "_common", lambda *a: found.append(common(*a)) or found[-1])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    passage = " ".join(str(i * i) for i in range(70))
    rows = [(i, f"{i * 7919} " * (i % 40) + passage + f" {i * 104729}" * (i % 30)) for i in range(300)]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    same(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)), con.execute(ORACLES["op3_suffix_array_dedup"]))
    assert found[0] or sample < 5000


def test_removed_bytes_as_sql(spark):
    """Runs that touch, overlap, lie at either end, split a character, or leave nothing; null, empty and repeated rows."""
    x, y = "".join(chr(97 + i * i % 23) + str(i) for i in range(80)), "".join(chr(65 + i * 7 % 26) + str(i * 3) for i in range(80))
    rows = [(1, x + y), (2, y + x), (3, x[:199]), (4, "é" * 150), (5, None), (6, ""), (7, "Q" + x + "R"), (7, "Q" + x + "R"), (8, "a" * 400), (9, x[:200] + x[:200])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    same(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")), con.execute(ORACLES["op3_suffix_array_dedup"]))
