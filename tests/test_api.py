"""Public helpers: spec/vocabulary/sub-field loaders, sort, column wrappers."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.functions.jsontext import mark_numbers_col, unmark_col
from cellsmith.functions.text import day_of_col
from cellsmith.operators.cells import clean
from cellsmith.operators.keys import regex_key_col
from cellsmith.operators.records import sort_by, sort_columns, with_global_rank
from cellsmith.spec import SpecError, load_spec, load_subfields, load_vocab, parse_model
from conftest import detail_model, pages_df


def test_loaders_from_files():
    d = Path(tempfile.mkdtemp(prefix="cellsmith-spec-"))
    (d / "spec.json").write_text(json.dumps([{
        "tableName": "t", "outputTable": "o", "nameSpace": "x",
        "models": {"m": {"dataPath": "foods", "rowKeyRegex": r"\sid:(\d+)", "hasRecordTime": True,
                         "columns": {"a": {"name": "A", "type": "int", "isMulti": False}}}}}]),
        encoding="utf-8")
    (d / "vocab.json").write_text(json.dumps({"trueWords": ["y"], "falseWords": ["n", 0],
                                               "specialBoolKeys": [], "arrayKeys": ["k"]}))
    (d / "subfields.json").write_text(json.dumps({"stock": {"name": "stock", "type": "int"}}))
    with pytest.warns(UserWarning):
        spec = load_spec(d / "spec.json")
    m = spec[0].models[0]
    assert m.is_list and m.uses_regex_key and not m.record_time
    assert m.columns[0].is_multi  # key presence, value ignored
    assert load_vocab(d / "vocab.json").false_words == ("n",)
    assert load_subfields(d / "subfields.json")["stock"].type == "int"
    with pytest.raises(SpecError):
        parse_model("bad", {"columns": {"a": {"name": "A", "type": "decimal"}}, "rowkeyColumns": ["a"]})
    with pytest.raises(SpecError):
        parse_model("nokey", {"columns": {}})


def test_fail_mode_raises(spark):
    m = detail_model({"v": {"name": "v", "type": "boolean"}})
    res = clean(pages_df(spark, [("1", "m", json.dumps({"id": 1, "v": "maybe"}))]), [m],
                on_error="fail")
    with pytest.raises(Exception):
        res.cells.collect()


def test_sort_and_column_wrappers(spark):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 1.0), (4, 3.0)], "k int, v double")
    assert [r.k for r in sort_by(df, "v", "DESC", ["k"]).collect()] == [1, 4, 3, 2]
    assert [r.k for r in sort_by(df, "v", None, ["k"]).collect()] == [3, 1, 4, 2]
    t = spark.createDataFrame([('{"a": 1.50, "b": "x 2"}', " id:7 id:8", 1528156800000)],
                              "j string, s string, ms bigint")
    row = t.select(unmark_col("j").alias("same"), mark_numbers_col("j").alias("m"),
                   regex_key_col("s", r"\sid:(\d+)").alias("k"),
                   day_of_col("ms", "Asia/Shanghai").alias("d")).first()
    assert row.same == '{"a": 1.50, "b": "x 2"}'
    assert row.m == '{"a": "\u00021.50\u0004", "b": "x 2"}'
    assert row.k == "8" and row.d == "2018-06-05"
    assert fixed.MENU_ROWKEY_REGEX == r"\sfood_id:(\d+)"
    assert t.select(F.lit(1)).count() == 1


def test_global_rank_over_many_partitions(spark):
    df = spark.range(1000).selectExpr("id AS k", "CASE WHEN id % 50 = 0 THEN NULL ELSE (id * 37) % 101 END AS v")
    rows = with_global_rank(df, sort_columns("v", "desc", ["k"])).collect()
    order = sorted(rows, key=lambda r: (r.v is None, -(r.v or 0), r.k))
    assert [r["rank"] for r in order] == list(range(1, 1001))
    assert with_global_rank(df.limit(0), sort_columns("v", None, ["k"])).count() == 0


def test_distinct_sorted_array(spark):
    from cellsmith.functions.arrays import distinct_sorted
    r = spark.sql("SELECT array('b', 'a', NULL, 'b') AS x").selectExpr(f"{distinct_sorted('x')} AS y").first()
    assert r.y == ["a", "b", None]
