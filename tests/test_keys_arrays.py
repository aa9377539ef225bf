"""Row keys, arrays, sub-fields, properties and list/detail page shapes."""

from __future__ import annotations

import json

from cellsmith import fixed
from cellsmith.functions.sqltext import q
from cellsmith.operators.backfill import backfill
from cellsmith.operators.cells import clean
from cellsmith.spec import parse_subfields
from conftest import detail_model, list_model, pages_df

# A token text with a virtual id, a negative id without a blank before it, empty
# values and doubled blanks: exactly one match of the key regex.
TOKENS = ("original_price:  name:茶  virtual_food_id:55  pinyin:cha  food_id:4711  price:3.5  sold_out:False"
          "  specs:    name:大  value:杯      activity:  stock:9\",\n\"name:茶  virtual_food_id:55"
          "  food_id:-20  price:3.5  stock:0")


def test_regex_matches_of_token_text(spark):
    from cellsmith.operators.keys import regex_matches
    df = spark.createDataFrame([(TOKENS,)], "t string")
    got = [r.match for r in regex_matches(df, "t", fixed.MENU_ROWKEY_REGEX).collect()]
    assert got == ["4711"]


def test_cjk_key_and_missing_key(spark):
    rows = [("1", "m", json.dumps({"name": "土豆", "v": "x"})), ("2", "m", json.dumps({"v": "y"}))]
    model = detail_model({"v": {"name": "v", "type": "String"}}, rowkey=("name",))
    keys = {r.source_key: r.row_key for r in clean(pages_df(spark, rows), [model]).items.collect()}
    assert keys == {"1": "079dc9cf9c245ca1", "2": "null"}


def test_detail_arrays(spark):
    data = {"id": 1, "opening_hours": ["a", "b"], "flavors": [{"name": "x"}, {}],
            "supports": [], "price": "not an array"}
    model = detail_model({k: {"name": k, "type": "Array"} for k in
                          ("opening_hours", "flavors", "supports")})
    res = clean(pages_df(spark, [("1", "m", json.dumps(data))]), [model])
    latest = {r.qualifier: r.v_string for r in res.cells.where("family = 'content'").collect()}
    assert latest == {"opening_hours": "a b ", "flavors": "x/null"}
    bad = detail_model({"price": {"name": "p", "type": "Array"}})
    rej = clean(pages_df(spark, [("1", "m", json.dumps(data))]), [bad]).rejects.collect()
    assert [r.reason for r in rej] == ["bad_array"]


def _menu_model(record_time=False):
    subs = {k: {"name": n, "type": t} for k, (n, t) in fixed.MENU_SUBFIELDS.items()}
    extra = {"recordTime": True} if record_time else {}
    return list_model({"name": {"name": "productName", "type": "String", "isMulti": True},
                       "specfoods": {"name": "specfoods", "type": "Array", "subColumns": subs}},
                      regex=fixed.MENU_ROWKEY_REGEX, **extra)


def test_list_page_subfields_and_properties(spark):
    item = {"name": "饭", "specfoods": [
        "  food_id:7  sold_out:False  a:b:c  price:14:  stock:  sku_id:1  sku_id:2"]}
    item2 = json.dumps({"name": "other", "specfoods": ["  food_id:8  price:3"]})
    data = json.dumps({"foods": [item, item2, {"name": "nokey"}]})
    props = json.dumps({"shop": 5, "note": "", "remark": "null"})
    res = clean(pages_df(spark, [("p1", "m", data, props)]), [_menu_model()])
    cells = {(r.row_key, r.family, r.qualifier): r for r in res.cells.collect()}
    assert cells[("7", "content", "isAvailable")].v_bool is True
    assert cells[("7", "content", "currentPrice")].v_double == 14.0
    assert ("7", "content", "stock") not in cells
    assert cells[("7", "content", "shop")].v_string == "5"
    assert cells[("7", "content", "remark")].v_string == "null"
    assert ("7", "content", "note") not in cells
    assert ("7", "productName", "2018-06-05") in cells
    assert ("7", "downloadTime", "2018-06-05") not in cells      # no recordTime
    assert cells[("8", "content", "currentPrice")].v_double == 3.0   # string item (E2)
    # the repeated sku_id: the later token is written later
    skus = sorted((r.put_seq, r.v_string) for r in res.cells.collect()
                  if r.row_key == "7" and r.family == "content" and r.qualifier == "sku")
    assert [v for _, v in skus] == ["1", "2"]
    assert [(r.item_pos, r.reason) for r in res.rejects.collect()] == [(2, "empty_row_key")]
    timed = clean(pages_df(spark, [("p1", "m", data, props)]), [_menu_model(True)]).cells
    assert timed.where("family = 'downloadTime'").count() == 2


def test_subfield_rejects_in_list_and_skip_in_backfill(spark):
    bad = json.dumps({"foods": [{"specfoods": ["  food_id:7  stock:1.0"]},
                                {"specfoods": ["  food_id:8  price:1,2"]}]})
    res = clean(pages_df(spark, [("p", "m", bad)]), [_menu_model()])
    assert sorted(r.reason for r in res.rejects.collect()) == ["bad_subfield", "bad_subfield"]
    hist = spark.createDataFrame([("r1", "2024-01-01", "price:1,2  price:3  stock:x"),
                                  ("r2", "2024-01-01", "price:1,2  stock:4  sold_out:False")],
                                 "row_key string, day string, text string")
    out = backfill(hist, parse_subfields(fixed.BACKFILL_SUBFIELDS))
    assert [(r.source_key, r.reason) for r in out.rejects.collect()] == [("r1", "bad_subfield")]
    got = {(r.family, r.qualifier): r for r in out.cells.collect()}
    assert set(got) == {("stock", "2024-01-01"), ("isAvailable", "2024-01-01")}
    assert got[("isAvailable", "2024-01-01")].v_bool is True


def test_bad_json_and_null_download_time(spark):
    rows = [("1", "m", '{"id": 1,'), ("2", "m", json.dumps({"id": 2}), None, None),
            ("3", "other", json.dumps({"id": 3}))]
    model = detail_model({"id": {"name": "id", "type": "String"}})
    rej = {r.source_key: r.reason for r in clean(pages_df(spark, rows), [model]).rejects.collect()}
    assert rej == {"1": "bad_data_json", "2": "null_download_time"}


def test_text_helpers(spark):
    from cellsmith.functions import text as tx
    df = spark.createDataFrame([("2018年06月05日 12:00:00",), ("x",), ("2018年13月05日 12:00:00",),
                                ("a　b",), ("a b",), (None,)], "t string")
    rows = df.select(tx.normalize_timestamp_col("t").alias("ts"),
                     tx.contains_blanks_col("t").alias("b")).collect()
    assert [r.ts for r in rows[:3]] == ["2018-06-05 12:00:00", None, None]
    assert [r.b for r in rows[3:]] == [True, False, False]
    assert spark.sql(f"SELECT {q('土豆')} RLIKE {q(tx.CJK_CLASS)} AS c").first().c is True


def test_repeated_property_key_later_wins(spark):
    from cellsmith.operators import merge
    m = list_model({"v": {"name": "v", "type": "String"}})
    data = json.dumps({"foods": [{"id": 1, "v": "x"}]})
    res = clean(pages_df(spark, [("p", "m", data, '{"a": "1", "a": "2"}')]), [m])
    got = {r.qualifier: r.v_string for r in merge.latest(res.cells).collect()}
    assert got == {"a": "2", "v": "x"}


def test_item_array_shapes(spark):
    m = list_model({"v": {"name": "v", "type": "String"}})
    rows = [("obj", "m", '{"foods": {"id": 1, "v": "x"}}'), ("str", "m", '{"foods": "abc"}'),
            ("nul", "m", '{"foods": null}'), ("num", "m", '{"foods": [5]}'),
            ("ok", "m", '{"foods": [{"id": 2, "v": "y"}]}')]
    res = clean(pages_df(spark, rows), [m])
    assert sorted((r.source_key, r.row_key) for r in
                  res.cells.select("source_key", "row_key").distinct().collect()) == [("ok", "2")]
    assert sorted((r.source_key, r.reason) for r in res.rejects.collect()) == [
        ("num", "bad_item_json"), ("obj", "bad_data_json"), ("str", "bad_data_json")]


def test_tokens_are_split_once_and_need_exactly_two_parts(spark):
    from cellsmith.functions.arrays import map_tokens
    sql = map_tokens("t", lambda k, v: f"named_struct('k', {k}, 'v', {v})")
    assert sql.count("split(") == 2 and "locate(" not in sql
    df = spark.createDataFrame([("a:1  b:  :c  d:e:f  g:h::  i  a:2,3    x:y ",), (None,), ("",)], "t string")
    got = [r.x for r in df.selectExpr(f"{sql} AS x").collect()]
    assert [tuple(x) if x else None for x in got[0]] == [
        ("a", "1"), None, ("", "c"), None, ("g", "h"), None, ("a", "2,3"), None, ("x", "y ")]
    assert got[1] is None and got[2] == [None]
    bare = map_tokens("t", lambda k, v: k, skip_commas=True)
    assert df.selectExpr(f"{bare} AS x").first().x == ["a", None, "", None, "g", None, None, None, "x"]


def test_one_match_tells_that_no_token_fails(spark):
    from cellsmith.functions import arrays, coerce as co
    from cellsmith.functions.sqltext import q
    types = {"n": "int", "f": "float", "d": "double", "b": "boolean", "s": "String", "": "int"}
    values = ["", "1", "-12", "+7", "1.5", "x", "9999999999", "1e5", "TRUE", "fAlse", "null", " 1", "1 ", "1,2", "NaN", "1:2", "5:", ":", "."]
    texts = [f"{a}{k}:{v}{b}" for k in [*types, "z"] for v in values for a in ("", " ", "  ", "   ", "z:1  ", "z:1    ", "n:1  s:x   ")
             for b in ("", "  ", " ", "  n:2", "   d:1.5", "\n")]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")

    def typed(sure):
        def token(k, v):
            named = " ".join(f"WHEN {k} = {q(n)} THEN named_struct('name', {q(n)}, 'val', {co.strict_parse(v, t, sure)})"
                             for n, t in types.items())
            return f"CASE WHEN {v} NOT IN ('', 'null') THEN CASE {named} END END"
        return arrays.map_tokens("t", token)

    rows = df.selectExpr("t", f"{arrays.sure_tokens('t', types)} AS sure", f"{typed(False)} AS a", f"{typed(True)} AS b").collect()
    for r in rows:
        if r.sure:
            assert r.a == r.b and not any(x is not None and x.val is None for x in r.a), r
    assert sum(bool(r.sure) for r in rows) > 500
    assert rows[-1].sure is None


def test_list_cells_need_no_token_typed(spark, monkeypatch):
    from cellsmith.operators.cells import Wanted, clean
    from cellsmith.plans import specs
    from cellsmith.sources import views
    pages = views.line_pages(spark, "/root/testdata/sf0.001")
    only = clean(pages, list(specs.LINES[0].models), wanted=Wanted(latest=frozenset(["title"]), history=frozenset()))
    plan = only.cells._jdf.queryExecution().optimizedPlan().toString()
    assert "original_price|" in plan  # the one match


def test_token_maps_hold_the_tokens(spark):
    from cellsmith.functions import arrays
    whole = ["stock:5  price:1.5  sold_out:True", "stock:5  specs:    name:x  name:y", "stock:  price:null", ":v  stock:1", "stock:5  stock:6"]
    other = ["stock:5  price", "a:1:2  stock:5", "stock:5::", 'name:"  stock:5', "name:\\  stock:5", "  stock:5", "stock:5  ", "stock:5      price:1", ""]
    df = spark.createDataFrame([(t,) for t in whole + other + ["a:1   stock:5"]], "t string")
    tokens = arrays.map_tokens("t", lambda k, v: f"named_struct('k', {k}, 'v', {v})")
    rows = df.selectExpr("t", f"{arrays.token_map('t')} AS m", f"map_entries({arrays.token_map('t')}) AS e", f"{tokens} AS a").collect()
    for r in rows:
        if r.m is not None:  # a key alone has an empty value there, which is blank
            assert [(x.key, x.value) for x in r.e if x.value] == [(x.k, x.v) for x in r.a if x is not None], r.t
    assert [r.t for r in rows if r.m is None] == other
    assert [x.key for x in rows[-1].e] == ["a", " stock"]  # the third space belongs to the key


def test_repeated_sub_fields_keep_every_token(spark):
    from cellsmith.operators.cells import clean
    subs = {"stock": {"name": "stock", "type": "int"}, "price": {"name": "currentPrice", "type": "double"}, "sku_id": {"name": "sku", "type": "String"}}
    m = list_model({"specfoods": {"name": "specfoods", "type": "Array", "subColumns": subs}})
    texts = {"once": "name:a  name:b  sku_id:7  stock:5  price:1.5", "twice": "sku_id:7  stock:5  sku_id:8  price:",
             "blank": "stock:5  stock:", "bad": "stock:5  price:x"}
    pages = pages_df(spark, [(k, "m", '{"foods":[{"id":"%s","specfoods":["%s"]}]}' % (k, t)) for k, t in texts.items()])
    res = clean(pages, [m])
    got = {k: sorted((r.put_seq, r.qualifier, r.v_string, r.v_int, r.v_double) for r in res.cells.where("family = 'content'").collect()
                     if r.row_key == k) for k in texts}
    value = {k: sorted(x[1:] for x in v) if k == "once" else [x[1:] for x in v] for k, v in got.items()}
    assert value == {"once": [("currentPrice", None, None, 1.5), ("sku", "7", None, None), ("stock", None, 5, None)],
                     "twice": [("sku", "7", None, None), ("stock", None, 5, None), ("sku", "8", None, None)],
                     "blank": [("stock", None, 5, None)], "bad": []}
    assert [(r.source_key, r.reason) for r in res.rejects.collect()] == [("bad", "bad_subfield")]
