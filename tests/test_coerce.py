"""Typed coercion vectors (field text -> stored value), through the cleaner."""

from __future__ import annotations

import json
import math

import pytest

from cellsmith.operators.cells import clean
from conftest import detail_model, list_model, pages_df


def _typed(spark, ctype, texts, key="v"):
    rows = [(str(i), "m", json.dumps({"id": i, key: t}) if t is not None else json.dumps({"id": i}))
            for i, t in enumerate(texts)]
    model = detail_model({key: {"name": "x", "type": ctype}})
    res = clean(pages_df(spark, rows), [model])
    got = {}
    for r in res.cells.where("family = 'content' AND qualifier = 'x'").collect():
        got[int(r.row_key)] = r
    rej = {int(r.source_key): r.reason for r in res.rejects.collect()}
    return [(got.get(i), rej.get(i)) for i in range(len(texts))]


def _val(cell):
    if cell is None:
        return None
    return (cell.vtype, {"string": cell.v_string, "int": cell.v_int, "long": cell.v_long,
                         "float": cell.v_float, "double": cell.v_double,
                         "boolean": cell.v_bool}[cell.vtype])


def test_blank_rule(spark):
    out = _typed(spark, "String", [None, "", "null", " "])
    assert [_val(c) for c, _ in out] == [None, None, None, ("string", " ")]


def test_int_vectors(spark):
    texts = ["3.7", "-0.5", "+12", "12.5元", "1.5e3", ".5", "1e3", " 12", "2147483648", "."]
    out = _typed(spark, "int", texts)
    assert [_val(c) for c, _ in out[:9]] == [
        ("int", 3), ("int", 0), ("int", 12), ("int", 12), ("int", 1), ("string", ""),
        ("string", "1e3"), ("string", " 12"), ("string", "2147483648")]
    assert out[9] == (None, "int_only_dots")


def test_long_vectors(spark):
    out = _typed(spark, "long", ["1.0", "9223372036854775807", "9223372036854775808"])
    assert [_val(c) for c, _ in out] == [("string", "1.0"), ("long", 9223372036854775807),
                                         ("string", "9223372036854775808")]


@pytest.mark.parametrize("ctype", ["float", "double"])
def test_floating_vectors(spark, ctype):
    texts = ["1.50", " 1.5 ", "NaN", "Infinity", "nan", "inf", "1d", "1e400", "abc", "0x1p3"]
    vals = [_val(c) for c, _ in _typed(spark, ctype, texts)]
    assert vals[0] == (ctype, 1.5) and vals[1] == (ctype, 1.5)
    assert vals[2][0] == ctype and math.isnan(vals[2][1])
    assert vals[3] == (ctype, math.inf)
    assert vals[4] == ("string", "nan") and vals[5] == ("string", "inf")
    assert vals[6] == (ctype, 1.0) and vals[7] == (ctype, math.inf)
    assert vals[8] == ("string", "abc") and vals[9] == (ctype, 8.0)


def test_boolean_vectors(spark):
    out = _typed(spark, "boolean", ["True", "有货", "0", "1", "休息中", "营业中"])
    assert [_val(c) for c, _ in out[:5]] == [("boolean", True), ("boolean", True),
                                            ("boolean", True), ("boolean", False),
                                            ("boolean", False)]
    assert out[5] == (None, "bad_boolean")
    special = _typed(spark, "boolean", ["营业中"], key="营业状态")
    assert _val(special[0][0]) == ("boolean", True)


def test_number_text_is_kept(spark):
    rows = [("1", "m", '{"id": 1, "a": 10000000.0, "b": 1.10, "c": 1.0, "d": {"x": 1.50}}')]
    model = detail_model({"a": {"name": "a", "type": "int"}, "b": {"name": "b", "type": "String"},
                          "c": {"name": "c", "type": "long"}, "d": {"name": "d", "type": "String"}})
    cells = {r.qualifier: _val(r) for r in
             clean(pages_df(spark, rows), [model]).cells.where("family = 'content'").collect()}
    assert cells == {"a": ("int", 10000000), "b": ("string", "1.10"), "c": ("string", "1.0"),
                     "d": ("string", '{"x":1.50}')}


def test_line_break_after_a_number_stays_text(spark):
    for ctype in ("int", "long"):
        assert _val(_typed(spark, ctype, ["12\n"])[0][0]) == ("string", "12\n")


def test_quotes_marks_and_exact_texts(spark):
    rows = [("1", "m", "{'id':'k','v':'x 5', 'n': 1.50}"), ("2", "m", '{"id":"q","v":"\\u0002abc","n":{"w":"\\u00023x"}}'),
            ("3", "m", '{"id":"it\'s","v":"it\'s 5 o\'clock","n":[1.0,2]}')]
    model = detail_model({"v": {"name": "v", "type": "String"}, "n": {"name": "n", "type": "String"}})
    got = {}
    for r in clean(pages_df(spark, rows), [model]).cells.where("family = 'content'").collect():
        got.setdefault(r.row_key, {})[r.qualifier] = r.v_string
    assert got["k"] == {"v": "x 5", "n": "1.50"} and got["it's"] == {"v": "it's 5 o'clock", "n": "[1.0,2]"}
    assert got["q"]["v"] == "\u0002abc" and json.loads(got["q"]["n"]) == {"w": "\u00023x"}


def test_documents_that_are_not_one_object_are_rejected_as_they_were(spark):
    texts = ['{"id": 1, "v": 2.50,', "", "  ", '{"id":"a","v":1.0} xyz', '{"id":1}{"id":2}', "null", "5", "[1.0]",
             '{"id":1},{"id":2}']
    model = detail_model({"v": {"name": "v", "type": "String"}})
    res = clean(pages_df(spark, [(str(i), "m", t) for i, t in enumerate(texts)]), [model])
    assert {int(r.source_key): (r.raw, r.reason) for r in res.rejects.collect()} == {
        i: (t, "bad_data_json") for i, t in enumerate(texts)}
    assert res.cells.count() == 0
    lists = list_model({"v": {"name": "v", "type": "String"}})
    res = clean(pages_df(spark, [(str(i), "m", t) for i, t in enumerate(["", '{"foods":[]} x', '{"foods":[]}'])]), [lists])
    assert sorted((r.source_key, r.raw, r.reason) for r in res.rejects.collect()) == [
        ("0", "", "bad_data_json"), ("1", '{"foods":[]} x', "bad_data_json")]


def test_arrays_that_are_not_rendered_and_empty_properties(spark):
    m = list_model({"tags": {"name": "tags", "type": "Array"}, "v": {"name": "v", "type": "String"}})
    data = '{"foods":[{"id":1,"v":"x","tags":["a",null]},{"id":2,"v":"y","tags":"no"}]}'
    res = clean(pages_df(spark, [("p", "m", data, "")]), [m])
    assert [(r.row_key, r.v_string) for r in res.cells.collect()] == [("1", "x")]
    assert [(r.item_pos, r.reason) for r in res.rejects.collect()] == [(1, "bad_array")]


def test_string_item_key_reads_a_bare_number(spark):
    m = list_model({"v": {"name": "v", "type": "int"}}, regex=r'"food_id":(\d+)')
    item = {"food_id": 8, "v": 3}
    data = json.dumps({"foods": [{"food_id": 7, "v": 2}, json.dumps(item, separators=(",", ":"))]})
    got = clean(pages_df(spark, [("p", "m", data)]), [m]).cells.collect()
    assert [(r.row_key, r.v_int) for r in got] == [("7", 2), ("8", 3)]
