"""Documents that the wrapped parse alone would take, and texts with the marks' own characters."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cellsmith.functions.jsontext import closed, mark_numbers
from cellsmith.operators.cells import clean
from conftest import detail_model, list_model, pages_df


def _one(spark, data):
    res = clean(pages_df(spark, [("p", "m", data)]), [detail_model({"v": {"name": "v", "type": "String"}})])
    return ([r.v_string for r in res.cells.where("family = 'content'").collect()],
            [(r.reason, r.raw) for r in res.rejects.collect()])


@pytest.mark.parametrize("data", [
    '{"id":"a","v":"x"}],"e":[{"id":"b"}', '{"id":"a","v":"x"}],"d":[{"id":"b","v":"y"}', '{"id":"a","v":"x"}]}',
    '{"id":"a","v":"x"}]} [{"d":[{}', '{"id":"a","v":1-2}', '{"id":"a","v":1.2.3}', '{"id":"a","v":1e+}', '{"id":"a","v":+1}',
    '{"id":"a","v":.5}', '{"id":"a","v":"p\x01q\x02r\x03s\x04"', "{'id':'a','v':'x'}],'e':[{'id':'b'}"])
def test_malformed_documents_are_rejects_with_their_own_text(spark, data):
    assert _one(spark, data) == ([], [("bad_data_json", data)])


@pytest.mark.parametrize("data,want", [
    ('{"id":"a","v":"]} , ["}', "]} , ["), ('{"id":"a","v":[[[[{"k":[1.50,"]"]}]]]]}', '[[[[{"k":[1.50,"]"]}]]]]'),
    ("{'id':'a','v':'it\"s]'}", "it\"s]"), ('{"id":"a","v":-1.50e+3}', "-1.50e+3"), ('{"id":"a","w":[[]],"v":{"b":[{}]}}', '{"b":[{}]}'),
    ('{"id":"a","v":"say \\"\x021\x04\\" now"}', 'say "\x021\x04" now'), ('{"id":"a","v":"p\x01q\x03r"}', "p\x01q\x03r"),
    ('{"id":"a","v":"1-2"}', "1-2")])
def test_well_formed_documents_keep_their_text(spark, data, want):
    assert _one(spark, data) == ([want], [])


def test_list_pages_and_string_items(spark):
    m = list_model({"v": {"name": "v", "type": "String"}})
    item = '{"id": "b", "v": 2.50}],"d":[{"id":"c","v":"z"}'
    pages = [("1", "m", '{"foods": [{"id": "a", "v": [1.0, "x"]}]}'), ("2", "m", '{"foods": []}],"d":[{"foods": [{"id": "n"}]}'),
             ("3", "m", json.dumps({"foods": [item, '{"id": "d", "v": [2.50]}']})), ("4", "m", '{"foods": [5, 1.50]}'),
             ("5", "m", '{"foods": [{"id": "e", "v": "x"}]}]}')]
    res = clean(pages_df(spark, pages), [m])
    assert sorted((r.row_key, r.v_string) for r in res.cells.where("qualifier = 'v'").collect()) \
        == [("a", '[1.0,"x"]'), ("d", "[2.50]")]
    assert sorted((r.source_key, r.reason, r.raw) for r in res.rejects.collect()) == [
        ("2", "bad_data_json", pages[1][2]), ("3", "bad_item_json", item), ("4", "bad_item_json", "1.50"),
        ("4", "bad_item_json", "5"), ("5", "bad_data_json", pages[4][2])]


def test_closed_counts_deep_texts(spark):
    deep = "[" * 50 + "]" * 50
    texts = [(deep, True), (deep + "]", False), ("]" + deep, False), (deep + "]" + deep + "[", False), ("{}", True), ("", True)]
    df = spark.createDataFrame([(t,) for t, _ in texts], "t string").coalesce(1)
    got = [r.c for r in df.select(F.expr(closed(mark_numbers("t"))).alias("c")).collect()]
    # an opening bracket that nothing closes is left to the parser
    assert [bool(c) for c in got] == [w for _, w in texts]


def test_numbers_are_marked_in_one_pass(spark):
    from cellsmith.functions.jsontext import NUM_END, NUM_MARK, mark_numbers
    sql = mark_numbers("x")
    assert sql.count("regexp_replace(") == 1 and sql.count("replace(") == 5  # four of them where control characters are
    one = lambda n: f'"{NUM_MARK}{n}{NUM_END}"'
    want = {'{"a1":1,"b":[-2.50,"3"]}': f'{{"a1":{one(1)},"b":[{one("-2.50")},"3"]}}',
            "1-2 1.2.3 1e+ 7": f"1-2 1.2.3 1e+ {one(7)}", '"5': f'"{one(5)}', "'6' -": "'6' -", "": "",
            '"p\u0002q" 8': f'"p\\u0002q" {one(8)}', "no number " * 50000: "no number " * 50000}
    df = spark.createDataFrame([(k,) for k in want], "x string")
    assert {r.x: r.y for r in df.selectExpr("x", f"{sql} AS y").collect()} == want


def test_closed_tells_common_texts_by_one_match(spark):
    from cellsmith.functions.jsontext import _PAIRED, closed
    from cellsmith.functions.sqltext import q
    texts = {'{"lines":[{"a":"]","s":["x"]}]}': (True, True), "[[[[]]]]": (True, True), "[[[[[]]]]]": (True, False),
             "[1]]": (False, False), "[}": (True, False), '["]': (True, False), "{": (True, False)}
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = {r.x: (r.c, r.p) for r in df.selectExpr("x", f"{closed('x')} AS c", f"x RLIKE {q(_PAIRED)} AS p").collect()}
    assert got == texts


def test_flat_texts_are_judged_by_their_parse(spark):
    from cellsmith.functions.jsontext import closed, flat, parse_record, sole
    texts = ['{"id":"1"}', '{"id":"}"}', '{"id":"1"', '{"id":"1","a":["x"]}', '{"id":"1","a":"x"]}', '{"id":"x}',
             '{"id":{"b":"1"}', '{"id":"1"}],"d":[{"id":"7"}', '],"d":[{"id":"7"}', '{"id":"1"}]}', '{}', '', ' {"id":"1"}',
             '{"id":"1"} ', '{"id":"1"],"d":[{"id":"7"}', '{"id":]}', "{'id':'}'}", '{"id":"\\"}', '{"id":"1"]}]}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.selectExpr("t", f"{parse_record('t', ['id'])} AS doc").selectExpr(
        "t", f"CASE WHEN {closed('t')} THEN {sole('doc')} END AS a",
        f"CASE WHEN {flat('t')} OR {closed('t')} THEN {sole('doc')} END AS b", f"{flat('t')} AS f")
    rows = df.collect()
    assert all(r.a == r.b for r in rows), rows
    assert [r.f for r in rows[:5]] == [True, False, False, True, True]


PLAIN_PAGES = [
    # page, whether it is rendered as it stands, and whether its items are
    ('{"foods":[{"id":"a","v":1.5,"specfoods":["stock:5"]}]}', True, [True]),
    ('{"foods":[{"id":"a","v":1.5},{"id":"b","v":[2.0,{"w":3}]}]}', True, [True, True]),
    ('{"n":1,"foods":[{"id":"a","v":12.0}],"m":"x"}', True, [True]),
    ('{"foods":[{"id":"a","v":1.50}]}', False, [False]), ('{"foods":[{"id":"a","v":1E3}]}', False, [False]),
    ('{"foods":[{"id":"a","v":10000000.0}]}', False, [False]), ('{"foods":[{"id":"a","v":-0}]}', False, [False]),
    ('{"foods":[{"id":"a","v":007}]}', False, [False]), ('{"foods": [{"id":"a","v":1}]}', False, [False]),
    ("{'foods':[{'id':'a','v':1}]}", False, [False]), ('{"foods":[{"id":"a","v":"\\u0041"}]}', False, [False]),
    ('{"foods":[{"id":"a","v":1}]} x', False, None), ('{"foods":[{"id":"a","v":1}]}{"foods":[]}', False, None),
    ('{"foods":[{"id":"a","v":1}]}],"d":[{"foods":[]}', False, None), ('{"foods":[{"id":"a","v":1}]}]}', False, None),
    ('{"foods":[{"id":"a","v":1}]', False, None), ('{"foods":[{"id":"a","v":"\\u00021\\u0004"}]}', False, [False]),
    ('{"foods":["{\\"id\\":\\"a\\",\\"v\\":1.5}",{"id":"b","v":2}]}', True, [True, True]),
    ('{"foods":["{\\"id\\":\\"a\\",\\"v\\":1.50}",{"id":"b","v":2}]}', True, [False, True]),
    ('{"foods":["{\\"id\\":\\"a\\"}],\\"d\\":[{\\"id\\":\\"b\\"}"]}', True, [False]), ('{"foods":["{}]}"]}', True, [False]),
    ('{"foods":["{\'id\':\'a\',\'v\':1.50}"]}', True, [False]), ('{"foods":[5,"x",null]}', True, [False, False, False]),
    ('{"foods":[{"id":"a","specfoods":[1,"stock:5"]}]}', True, [False]),
    ('{"foods":[{"id":"a","specfoods":["stock:5"],"specfoods":[1]}]}', True, [False]),
]


def _food_model():
    subs = {"stock": {"name": "stock", "type": "int"}, "sku_id": {"name": "sku", "type": "String"}}
    return list_model({"v": {"name": "v", "type": "String"}, "specfoods": {"name": "specfoods", "type": "Array", "subColumns": subs}})


def test_texts_that_are_rendered_as_they_stand_need_no_marks(spark):
    from cellsmith.operators.cells import item_frame
    pages = pages_df(spark, [(str(k), "m", t) for k, (t, _, _) in enumerate(PLAIN_PAGES)])
    rows = item_frame(pages, [_food_model()]).orderBy("source_key", "item_pos").collect()
    for k, (text, plain, clear) in enumerate(PLAIN_PAGES):
        mine = [r for r in rows if r.source_key == str(k)]
        assert {r.plain for r in mine} == {plain}, text
        if clear is None:
            assert [r.page_reason.reason for r in mine] == ["bad_data_json"], text
        else:
            assert [r.clear for r in mine] == clear, text
            # where nothing was marked the item is what was found, and marks stand in no other
            assert all(r.item == r.found for r in mine if r.clear), text


def test_pages_cleaned_with_and_without_marks_give_the_same_rows(spark, monkeypatch):
    from cellsmith.operators import cells as ops
    pages = pages_df(spark, [(str(k), "m", t, p) for k, (t, _, _) in enumerate(PLAIN_PAGES)
                             for p in ('{"a":1.10,"b":7}', '{"a":007}', '{"a":null}', '{"a":-0,"b":[1,2.50]}')])

    def rows():
        res = clean(pages, [_food_model()])
        return [sorted(map(str, df.collect())) for df in (res.cells, res.rejects, res.items.select("source_key", "item_pos", "row_key"))]

    fast = rows()
    monkeypatch.setattr(ops, "NUM_MARK_ESCAPE", "")  # every text contains it, so that all are marked
    monkeypatch.setattr(ops, "mark_inexact", mark_numbers)
    assert not ops.item_frame(pages, [_food_model()]).where("plain OR clear").count()
    assert rows() == fast and all(fast)


def test_arrays_of_one_string_are_told_without_a_parse(spark):
    from cellsmith.functions.jsontext import _OPTS, parse_text_array
    texts = ['["a:1  b:2"]', '[""]', '["规"]', '["a","b"]', '["a\\"b"]', '["a\\\\"]', '["a"', '["a]', '["a"]]', '["a"] ', ' ["a"]', '[]', '["',
             '["]', '"]', 'x', '', '[1]', '["a"b"]', '["\u00021\u0004"]', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = f"CASE WHEN startswith(ltrim(t), '[') THEN from_json(t, 'array<string>', {_OPTS}) END"
    rows = df.selectExpr("t", f"{parse_text_array('t')} AS a", f"{old} AS b").collect()
    assert all(r.a == r.b for r in rows), rows
    assert [r.a for r in rows[:3]] == [["a:1  b:2"], [""], ["规"]]
