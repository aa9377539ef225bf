"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from cellsmith.plans.queries import QUERIES
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall())


@pytest.mark.parametrize("name", ["clean_history", "download_time_cells", "normalize_timestamp",
                                  "upsert_merge"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert rows_of(cols, rows) == rows_of(ocols, res.fetchall())


def test_blank_tests_see_every_own_text(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = entry.queries()["blank_tests_whole"](spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        t = texts[r.doc_id]
        assert r.text_blank == (t in (None, "", "null")) and r.text_empty == (not t)
        assert r.text_has_cjk == any("一" <= c <= "龥" for c in t or "")
