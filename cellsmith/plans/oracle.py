"""DuckDB SQL that computes each driver query's answer straight from the
driver tables, written independently of the Spark code path."""

from __future__ import annotations

# Cell value columns of every cell-shaped answer.
_NULLS = {
    "v_string": "NULL::VARCHAR", "v_int": "NULL::INTEGER", "v_long": "NULL::BIGINT",
    "v_float": "NULL::DOUBLE", "v_double": "NULL::DOUBLE", "v_bool": "NULL::BOOLEAN",
}


def _vals(vtype: str, slot: str | None, expr: str | None) -> str:
    cols = []
    for k, null in _NULLS.items():
        cols.append(f"{expr if k == slot else null} AS {k}")
    return f"'{vtype}' AS vtype, " + ", ".join(cols)


def _last(cells_cte: str, order: str = "dt DESC, sk DESC, pos DESC, seq DESC") -> str:
    return f"""
SELECT row_key, family, qualifier, vtype, v_string, v_int, v_long, v_float, v_double, v_bool
FROM {cells_cte}
QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY {order}) = 1"""


_EVENTS = """
e AS (
  SELECT CAST(event_id AS VARCHAR) AS sk, 0 AS pos,
         CAST(user_id AS VARCHAR) || event_type AS row_key,
         (epoch_us(ts) // 1000) AS dt, strftime(ts, '%Y-%m-%d') AS day,
         user_id, event_type, value, props
  FROM events)"""


def _event_cells(latest: bool) -> str:
    fam = (lambda name: "'content'") if latest else (lambda name: f"'{name}'")
    qual = (lambda name: f"'{name}'") if latest else (lambda name: "day")
    parts = [
        ("userId", 1, _vals("long", "v_long", "CAST(user_id AS BIGINT)")),
        ("eventType", 2, _vals("string", "v_string", "event_type")),
        ("amount", 3, _vals("int", "v_int", "CAST(trunc(value) AS INTEGER)")),
        ("props", 4, _vals("string", "v_string", "replace(props, ' ', '')")),
    ]
    sel = [f"SELECT row_key, {fam(n)} AS family, {qual(n)} AS qualifier, {v}, dt, sk, pos, {s} AS seq FROM e"
           for n, s, v in parts]
    if not latest:
        sel.append("SELECT row_key, 'downloadTime' AS family, day AS qualifier, "
                   + _vals("long", "v_long", "dt") + ", dt, sk, pos, 0 AS seq FROM e")
    return "WITH " + _EVENTS + ",\nc AS (\n" + "\nUNION ALL\n".join(sel) + ")\n" + _last("c")


def _event_rows() -> str:
    """Latest and history cells of all events, with the amount's own text."""
    parts = []
    for latest in (True, False):
        body = _event_cells(latest).split("c AS (\n", 1)[1].split(")\n\nSELECT", 1)[0]
        parts.append(body.replace(" FROM e", ", CAST(value AS VARCHAR) AS text FROM e"))
    return "\nUNION ALL\n".join(parts)


def _two_sites() -> str:
    second = """
e2 AS (SELECT CASE WHEN CAST(sk AS BIGINT) % 2 = 0 THEN sk ELSE '' END AS sk, pos, row_key, dt, day, user_id, event_type,
              value + 1 AS value, props FROM e)"""
    parts = []
    for latest in (True, False):
        body = _event_cells(latest).split("c AS (\n", 1)[1].split(")\n\nSELECT", 1)[0]
        parts += [body.replace(" FROM e", ", 0 AS sno FROM e"), body.replace(" FROM e", ", 1 AS sno FROM e2")]
    return ("WITH " + _EVENTS + "," + second + ",\nc AS (\n" + "\nUNION ALL\n".join(parts) + ")\n"
            + _last("c", "dt DESC, sk DESC, pos DESC, seq DESC, sno DESC"))


_DIRTY = r"""
d AS (
  SELECT CAST(event_id AS VARCHAR) AS row_key, event_id, strftime(ts, '%Y-%m-%d') AS day,
    CASE event_id % 19
      WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN 'abc'
      WHEN 2 THEN CAST(value AS VARCHAR) || '元' WHEN 3 THEN 'null' WHEN 4 THEN ''
      WHEN 5 THEN NULL WHEN 6 THEN ' ' || CAST(user_id AS VARCHAR) WHEN 7 THEN '1e3'
      WHEN 8 THEN '-0.5' WHEN 9 THEN 'NaN' WHEN 10 THEN 'inf'
      WHEN 11 THEN CAST(user_id + 2147483648 AS VARCHAR) WHEN 12 THEN '1.0'
      WHEN 13 THEN '+' || CAST(user_id AS VARCHAR) WHEN 14 THEN '.5'
      WHEN 15 THEN CAST(value AS VARCHAR) WHEN 16 THEN '9223372036854775808'
      WHEN 17 THEN ' ' || CAST(value AS VARCHAR) || ' ' WHEN 18 THEN '.'
    END AS r,
    (['true', 'True', 'FALSE', '有货', '无货', '0', '1', '休息中', '自营', 'maybe', 'null'])
      [event_id % 11 + 1] AS flag
  FROM events),
dr AS (
  SELECT *, CASE WHEN event_id % 97 < 11 THEN 'bad_data_json'
                 WHEN r = '.' THEN 'int_only_dots'
                 WHEN flag = 'maybe' THEN 'bad_boolean' END AS reason
  FROM d),
ok AS (SELECT * FROM dr WHERE reason IS NULL AND r IS NOT NULL AND r NOT IN ('', 'null'))"""

_FP_GUARD = ("CASE WHEN regexp_matches(r, '(?i)^\\s*[+-]?(inf|infinity|nan)\\s*$') "
             "AND NOT regexp_matches(r, '^\\s*[+-]?(NaN|Infinity)\\s*$') THEN NULL "
             "ELSE TRY_CAST(r AS {t}) END")


def _dirty(qualifier: str, parsed: str, vtype: str, slot: str, text: str = "r") -> str:
    return f"""WITH {_DIRTY},
p AS (
  SELECT row_key, 'content' AS family, '{qualifier}' AS qualifier, r, {parsed} AS x FROM ok
  UNION ALL SELECT row_key, '{qualifier}', day, r, {parsed} FROM ok)
SELECT row_key, family, qualifier,
  CASE WHEN x IS NULL THEN 'string' ELSE '{vtype}' END AS vtype,
  CASE WHEN x IS NULL THEN {text} END AS v_string,
  {'x' if slot == 'v_int' else 'NULL::INTEGER'} AS v_int,
  {'x' if slot == 'v_long' else 'NULL::BIGINT'} AS v_long,
  {'CAST(x AS DOUBLE)' if slot == 'v_float' else 'NULL::DOUBLE'} AS v_float,
  {'x' if slot == 'v_double' else 'NULL::DOUBLE'} AS v_double,
  NULL::BOOLEAN AS v_bool
FROM p"""


_TRUNC = "CASE WHEN strpos(r, '.') > 0 THEN split_part(r, '.', 1) ELSE r END"
_INT_OF = ("CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+$') THEN TRY_CAST({t} AS {typ}) END")

def _union(src: str, rows: list[tuple]) -> str:
    """Cell rows (family, qualifier, vtype, slot, value, where) of one source CTE."""
    sel = []
    for seq, (fam, qual, vtype, slot, val, where) in enumerate(rows):
        w = f" WHERE {where}" if where else ""
        sel.append(f"SELECT row_key, {fam} AS family, {qual} AS qualifier, "
                   f"{_vals(vtype, slot, val)}, dt, sk, pos, {seq} AS seq FROM {src}{w}")
    return "\nUNION ALL\n".join(sel)


def _fl(c: str) -> str:
    return f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"


_LINES = """
li AS (
  SELECT l.*, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS sk,
         (epoch_us(l_shipdate) // 1000) AS dt, strftime(l_shipdate, '%Y-%m-%d') AS day,
         CAST(l_partkey AS VARCHAR) AS row_key, i.pos, i.pos * 100 AS extra
  FROM lineitem l JOIN (VALUES (0), (1)) i(pos) ON i.pos = 0 OR l_linenumber % 3 = 0)"""

# (clean name, vtype, slot, value, where, history)
_LINE_COLS = [
    ("lineNo", "int", "v_int", "CAST(l_linenumber + extra AS INTEGER)", None, True),
    ("discountRate", "float", "v_float", _fl("l_discount"), None, True),
    ("pictureFile", "string", "v_string", "'img/' || l_partkey || '.jpg'", None, True),
    ("quantity", "int", "v_int", "CAST(trunc(l_quantity) + extra AS INTEGER)", None, True),
    ("flagPair", "string", "v_string", "l_returnflag || l_linestatus", None, True),
    ("taxedQuantity", "int", "v_int", "CAST(trunc(l_quantity) AS INTEGER)", "l_tax > 0", True),
    ("taxRate", "float", "v_float", _fl("l_tax"), None, True),
    ("returnFlag", "string", "v_string", "l_returnflag", None, False),
    ("supplierText", "string", "v_string", "CAST(l_suppkey AS VARCHAR)", None, False),
    ("title", "string", "v_string", "CASE pos WHEN 0 THEN 'part ' ELSE 'other ' END || l_partkey", None, True),
]
_LINE_SUBS = [
    ("originalPrice", "double", "v_double", "l_extendedprice", "l_discount <> 0"),
    ("packingFee", "double", "v_double", "l_tax", None),
    ("recentRating", "float", "v_float", _fl("l_discount"), None),
    ("promotionStock", "int", "v_int", "-1", None),
    ("currentPrice", "double", "v_double", "l_extendedprice", None),
    ("recentPopularity", "int", "v_int", "CAST(l_quantity AS INTEGER)", None),
    ("stock", "int", "v_int", "l_linenumber * 10", "l_linenumber <> 7"),
    ("sku", "string", "v_string",
     "CASE WHEN l_linenumber = 2 THEN CAST(l_partkey AS VARCHAR) "
     "ELSE CAST(l_suppkey AS VARCHAR) END", None),
]


def _lines(rows: list[tuple]) -> str:
    return "WITH " + _LINES + ",\nc AS (\n" + _union("li", rows) + ")\n" + _last("c")


def _two(rows: list[tuple]) -> list[tuple]:
    """Latest and history rows of (clean name, vtype, slot, value, where)."""
    return [(f, q, t, sl, v, w) for n, t, sl, v, w in rows for f, q in ((_L, f"'{n}'"), (f"'{n}'", "day"))]


_CUSTOMERS = """
cu AS (
  SELECT c.*, n.n_name, CAST(c_custkey AS VARCHAR) AS row_key, CAST(c_custkey AS VARCHAR) AS sk,
         0 AS pos, 1704067200000 + c_custkey * 3600000 AS dt,
         strftime(epoch_ms(1704067200000 + c_custkey * 3600000), '%Y-%m-%d') AS day
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
sl AS (
  SELECT c.*, n.n_name, CAST(c_custkey AS VARCHAR) AS row_key, 'list-' || c_custkey AS sk,
         0 AS pos, 1704067200000 + c_nationkey * 86400000 AS dt,
         strftime(epoch_ms(CAST(1704067200000 + c_nationkey * 86400000 AS BIGINT)), '%Y-%m-%d') AS day
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_L = "'content'"
_CUSTOMER_COLS = [
    ("displayName", "string", "v_string",
     "CASE WHEN c_custkey % 3 = 0 THEN '店铺' || c_name ELSE c_name END", None),
    ("customerId", "string", "v_string", "CAST(c_custkey AS VARCHAR)", None),
    ("street", "string", "v_string", "n_name || ' road ' || c_custkey", None),
    ("balance", "double", "v_double", "c_acctbal", None),
    ("zone", "float", "v_float", _fl("c_nationkey"), None),
    ("isVip", "boolean", "v_bool", "c_custkey % 5 IN (0, 2, 3)", None),
    ("isBuilder", "boolean", "v_bool", "c_mktsegment = 'BUILDING'", None),
    ("contact", "string", "v_string", "'+86-' || c_custkey", None),
    ("visits", "int", "v_int", "CAST(c_custkey % 1000 AS INTEGER)", None),
    ("segment", "string", "v_string", "c_mktsegment", None),
    ("waitText", "string", "v_string", "c_nationkey || '分钟'", None),
    ("hours", "string", "v_string",
     "'08:00-12:00 ' || lpad(CAST(c_nationkey % 24 AS VARCHAR), 2, '0') || ':00-22:00 '",
     "c_custkey % 4 <> 0"),
    ("tags", "string", "v_string",
     "n_name || '/' || CASE WHEN c_custkey % 7 = 0 THEN 'null' ELSE c_mktsegment END", None),
    ("promises", "string", "v_string", "c_mktsegment || '/fast ' || c_nationkey", None),
]
_DIRECTORY_ROWS = [
    (_L, "'street'", "string", "v_string", "'nation ' || n_name", None),
    (_L, "'listName'", "string", "v_string", "c_name", None),
    (_L, "'logoFile'", "string", "v_string", "'logo/' || c_custkey || '.png'", None),
    (_L, "'minutes'", "int", "v_int", "CAST(c_nationkey + 30 AS INTEGER)", None),
    (_L, "'offer'", "string", "v_string", "c_mktsegment", None),
    ("'offer'", "day", "string", "v_string", "c_mktsegment", None),
]
_TIME_ROW = ("'downloadTime'", "day", "long", "v_long", "CAST(dt AS BIGINT)", None)


def _customers(detail_rows: list[tuple], list_rows: list[tuple] | None = None) -> str:
    body = _union("cu", detail_rows)
    if list_rows:
        body += "\nUNION ALL\n" + _union("sl", list_rows)
    return "WITH " + _CUSTOMERS + ",\nc AS (\n" + body + ")\n" + _last("c")


def _customer_one(name: str) -> str:
    return _customers(_two([r for r in _CUSTOMER_COLS if r[0] == name]))


_WIDE = [r[0] for r in _CUSTOMER_COLS] + ["never", "listName", "logoFile", "minutes", "offer"]


def _wide() -> str:
    latest = [r for r in _two(_CUSTOMER_COLS) if r[0] == _L]
    cells = _customers(latest, [r for r in _DIRECTORY_ROWS if r[0] == _L])
    text = ("coalesce(v_string, CAST(v_int AS VARCHAR), CAST(v_float AS VARCHAR), CAST(v_double AS VARCHAR), "
            "CAST(v_bool AS VARCHAR))")
    cols = ",\n  ".join(f"max({text}) FILTER (WHERE qualifier = '{n}') AS \"{n}\"" for n in _WIDE)
    return f"SELECT row_key,\n  {cols}\nFROM ({cells}) t GROUP BY row_key"


_WIDE_TYPES = {"balance": "v_double", "zone": "v_float", "isVip": "v_bool", "isBuilder": "v_bool", "visits": "v_int",
               "minutes": "v_int"}


def _wide_typed() -> str:
    latest = [r for r in _two(_CUSTOMER_COLS) if r[0] == _L]
    cells = _customers(latest, [r for r in _DIRECTORY_ROWS if r[0] == _L])
    slot = {n: "v_string" for n in _WIDE} | _WIDE_TYPES
    cols = []
    for n in _WIDE:
        cols.append(f"max({slot[n]}) FILTER (WHERE qualifier = '{n}') AS \"{n}\"")
        if slot[n] != "v_string":
            cols.append(f"max(v_string) FILTER (WHERE qualifier = '{n}') AS \"{n}_text\"")
    return "SELECT row_key,\n  " + ",\n  ".join(cols) + f"\nFROM ({cells}) t GROUP BY row_key"


_TWINS = f"""
WITH t AS (SELECT CAST(s_suppkey AS VARCHAR) AS row_key, s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS n
           FROM supplier)
SELECT row_key, 'content' AS family, 'supplierName' AS qualifier, {_vals('string', 'v_string', 's_name')},
       '店铺' AS output_table FROM t
UNION ALL
SELECT row_key, 'content', 'nationNo', {_vals('string', 'v_string', 'n')}, 'a:b' FROM t WHERE s_suppkey % 2 = 1"""

_TOKEN_HISTORY = r"""
p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS row_key FROM part),
h AS (
  SELECT row_key, '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS day,
    'original_price:' || CAST(p_retailprice AS VARCHAR) || '  sku_id:' || p_partkey
    || '  name:' || p_name || '  packing_fee:' || (p_size % 3)
    || '  recent_rating:' || (p_size % 5) || '.5  promotion_stock:-1  price:'
    || CAST(p_retailprice AS VARCHAR) || '  sold_out:'
    || CASE WHEN p_size % 2 = 0 THEN 'False' ELSE 'True' END
    || '  recent_popularity:' || p_size || '  item_id:' || p_partkey
    || '  specs:    name:规格  value:' || p_type
    || '  stock:' || CASE WHEN p_size = 13 THEN '1.0' ELSE CAST(p_size AS VARCHAR) END
    || CASE WHEN p_size % 7 = 0 THEN '  price:1,2' ELSE '' END AS text
  FROM p
  UNION ALL
  SELECT row_key, '2024-02-01', 'price:' || p_size || '  stock:' || (p_size + 1)
    || '  sold_out:true  recent_rating:' || p_size || '  item_id:' || p_brand FROM p),
t AS (
  SELECT row_key, day, i, regexp_replace(tok, ':+$', '') AS tok FROM (
    SELECT row_key, day, unnest(string_split(text, '  ')) AS tok,
           generate_subscripts(string_split(text, '  '), 1) AS i FROM h)
  WHERE NOT contains(tok, ',')),
kv AS (
  SELECT row_key, day, i, string_split(tok, ':')[1] AS k, string_split(tok, ':')[2] AS v
  FROM t WHERE len(string_split(tok, ':')) = 2),
m AS (SELECT * FROM (VALUES
  ('original_price', 'originalPrice', 'double'), ('packing_fee', 'packingFee', 'double'),
  ('recent_rating', 'recentRating', 'float'), ('promotion_stock', 'promotionStock', 'int'),
  ('price', 'currentPrice', 'double'), ('sold_out', 'isAvailable', 'boolean'),
  ('recent_popularity', 'recentPopularity', 'int'), ('item_id', 'productRawId', 'String'),
  ('stock', 'stock', 'int')) AS m(k, name, typ)),
typed AS (
  SELECT kv.row_key, kv.day, kv.i, m.name, m.typ, kv.v,
    CASE WHEN m.typ = 'int' AND regexp_matches(kv.v, '^[+-]?[0-9]+$') THEN TRY_CAST(kv.v AS INTEGER) END AS iv,
    CASE WHEN m.typ = 'double' THEN TRY_CAST(kv.v AS DOUBLE) END AS dv,
    CASE WHEN m.typ = 'float' THEN CAST(TRY_CAST(kv.v AS FLOAT) AS DOUBLE) END AS fv,
    CASE WHEN m.typ = 'boolean' THEN CASE lower(kv.v) WHEN 'true' THEN false WHEN 'false' THEN true END END AS bv
  FROM kv JOIN m ON kv.k = m.k),
bad AS (
  SELECT DISTINCT row_key, day FROM typed
  WHERE (typ = 'int' AND iv IS NULL) OR (typ = 'double' AND dv IS NULL)
     OR (typ = 'float' AND fv IS NULL) OR (typ = 'boolean' AND bv IS NULL)),
c AS (
  SELECT t.row_key, t.name AS family, t.day AS qualifier,
    CASE typ WHEN 'String' THEN 'string' ELSE typ END AS vtype,
    CASE WHEN typ = 'String' THEN v END AS v_string, iv AS v_int, NULL::BIGINT AS v_long,
    fv AS v_float, dv AS v_double, bv AS v_bool, 0 AS dt, '' AS sk, 0 AS pos, i AS seq
  FROM typed t ANTI JOIN bad b ON t.row_key = b.row_key AND t.day = b.day)"""

_JVM_WS_DUCK = ("[\\t\\n\\x0b\\f\\r\\x1c-\\x1f \\x{1680}\\x{2000}-\\x{2006}"
                "\\x{2008}-\\x{200a}\\x{2028}\\x{2029}\\x{205f}\\x{3000}]")

ORACLE = {
    "clean_latest": _event_cells(latest=True),
    "clean_history": _event_cells(latest=False),
    "coerce_int": _dirty("asInt", _INT_OF.format(t=_TRUNC, typ="INTEGER"), "int", "v_int",
                         text=_TRUNC),
    "coerce_long": _dirty("asLong", _INT_OF.format(t="r", typ="BIGINT"), "long", "v_long"),
    "coerce_float": _dirty("asFloat", _FP_GUARD.format(t="FLOAT"), "float", "v_float"),
    "coerce_double": _dirty("asDouble", _FP_GUARD.format(t="DOUBLE"), "double", "v_double"),
    "coerce_string": f"""WITH {_DIRTY}
SELECT row_key, 'content' AS family, 'asString' AS qualifier, {_vals('string', 'v_string', 'r')} FROM ok
UNION ALL SELECT row_key, 'asString', day, {_vals('string', 'v_string', 'r')} FROM ok""",
    "coerce_boolean": f"""
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS row_key, o_orderstatus AS st,
                  o_orderkey % 3 AS m, strftime(o_orderdate, '%Y-%m-%d') AS day
           FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT row_key, 'content' AS family, 'statusFlag' AS qualifier,
       {_vals('boolean', 'v_bool', "st = 'F'")} FROM o
UNION ALL SELECT row_key, 'statusFlag', day, {_vals('boolean', 'v_bool', "st = 'F'")} FROM o
UNION ALL SELECT row_key, 'content', 'soldOut', {_vals('boolean', 'v_bool', 'm <> 1')} FROM o
UNION ALL SELECT row_key, 'soldOut', day, {_vals('boolean', 'v_bool', 'm <> 1')} FROM o""",
    "list_items": _lines([(_L, f"'{n}'", t, sl, v, w) for n, t, sl, v, w, _ in _LINE_COLS]),
    "list_history": _lines([(f"'{n}'", "day", t, sl, v, w)
                            for n, t, sl, v, w, h in _LINE_COLS if h]),
    "list_properties": _lines([
        (_L, "'supplier_no'", "string", "v_string", "CAST(l_suppkey AS VARCHAR)", None),
        (_L, "'state'", "string", "v_string", "l_linestatus", None),
        (_L, "'flag'", "string", "v_string", "l_returnflag", None),
        (_L, "'remark'", "string", "v_string", "'null'", None)]),
    "regex_key": f"WITH {_LINES} SELECT sk AS source_key, CAST(pos AS INTEGER) AS item_pos, row_key FROM li",
    "string_items": _lines([
        (_L, "'lineNo'", "int", "v_int", "CAST(l_linenumber + extra AS INTEGER)", None),
        (_L, "'title'", "string", "v_string", "CASE pos WHEN 0 THEN 'part ' ELSE 'other ' END || l_partkey", None),
        (_L, "'discountText'", "string", "v_string", "CAST(l_discount AS VARCHAR)", None)]),
    "subfields": _lines(_two(_LINE_SUBS)),
    "subfield_bool": _lines(_two([("isAvailable", "boolean", "v_bool", "l_linestatus = 'F'", None)])),
    "download_time_cells": "WITH " + _LINES + "," + _CUSTOMERS + ",\nc AS (\n"
        + _union("li", [_TIME_ROW]) + "\nUNION ALL\n" + _union("cu", [_TIME_ROW]) + ")\n" + _last("c"),
    "model_fanin": _customers(_two(_CUSTOMER_COLS) + [_TIME_ROW], _DIRECTORY_ROWS),
    "multi_output": _TWINS,
    "cjk_key_md5": """SELECT CAST(c_custkey AS VARCHAR) AS source_key,
  CASE WHEN c_custkey % 3 = 0 THEN substr(md5('店铺' || c_name), 9, 16) ELSE c_name END AS row_key
FROM customer""",
    "array_spaced": _customer_one("hours"),
    "array_names": _customer_one("tags"),
    "array_descriptions": _customer_one("promises"),
    "latest_wide": _wide(),
    "backfill_tokens": "WITH " + _TOKEN_HISTORY + _last("c"),
    "upsert_merge": "WITH " + _EVENTS + ",\nc AS (\n"
        + _event_cells(latest=True).split("c AS (\n", 1)[1].split(")\n\nSELECT", 1)[0]
        + "\nUNION ALL\n"
        + _event_cells(latest=False).split("c AS (\n", 1)[1].split(")\n\nSELECT", 1)[0]
        + ")\n" + _last("c"),
    "upsert_overwrites": f"""WITH {_EVENTS},
c0 AS (
{_event_rows()}),
c1 AS (SELECT *, 0 AS batch FROM c0 UNION ALL
  SELECT row_key, family, qualifier,
    CASE WHEN 'amount' IN (family, qualifier) THEN 'string' ELSE vtype END AS vtype,
    CASE WHEN 'amount' IN (family, qualifier) THEN text ELSE v_string END AS v_string,
    CASE WHEN 'amount' IN (family, qualifier) THEN NULL ELSE v_int END AS v_int,
    v_long, v_float, v_double, v_bool, dt, sk, pos, seq, text, 1 AS batch
  FROM c0 WHERE dt < 1705622400000)
""" + _last("c1", "batch DESC, dt DESC, sk DESC, pos DESC, seq DESC"),
    "backfill_upsert": "WITH " + _TOKEN_HISTORY + f""",
typed_now AS (SELECT *, 1 AS batch FROM c),
stored AS (
  SELECT row_key, 'specfoods' AS family, day AS qualifier, {_vals('string', 'v_string', 'text')},
         0 AS dt, '' AS sk, 0 AS pos, 0 AS seq, 0 AS batch FROM h
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), f.f, '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0'),
         {_vals('int', 'v_int', '-p_size')}, 4102444800000, '', 0, 0, 0
  FROM part CROSS JOIN (VALUES ('stock'), ('shelf')) f(f)),
every AS (SELECT * FROM stored UNION ALL BY NAME SELECT * FROM typed_now)
""" + _last("every", "batch DESC, dt DESC, sk DESC, pos DESC, seq DESC"),
    "distinct_array": """
SELECT doc_id, list_sort(list_distinct(string_split(text, ' '))) AS words FROM documents""",
    "history_lookup": "SELECT * FROM (" + _event_cells(latest=False)
        + ") WHERE row_key = '0click' AND family = 'amount'",
    "regex_matches": """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS match_pos, m AS match FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '(\\d+)', 1)) AS m,
         generate_subscripts(regexp_extract_all(text, '(\\d+)', 1), 1) AS i
  FROM documents)""",
    "sort_records": """
SELECT o_orderkey, o_totalprice,
       row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank
FROM orders""",
    "distinct_sorted": """
SELECT p_name, row_number() OVER (ORDER BY p_name NULLS LAST) AS rank
FROM (SELECT DISTINCT p_name FROM part)""",
    "normalize_timestamp": """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (0, 1) THEN NULL
                        ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts
FROM orders""",
    "blank_tests": f"""
WITH t AS (
  SELECT doc_id, source, CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN chr(12288)
           WHEN 4 THEN chr(160) WHEN 5 THEN ' ' WHEN 6 THEN '店' || source ELSE text END AS text
  FROM documents)
SELECT doc_id, (text IS NULL OR text IN ('null', '')) AS text_blank,
       (text IS NULL OR length(text) = 0) AS text_empty,
       coalesce(regexp_matches(text, '{_JVM_WS_DUCK}'), false) AS text_has_blanks,
       regexp_matches(text, '[一-龥]') AS text_has_cjk,
       coalesce(regexp_matches(source, '{_JVM_WS_DUCK}'), false) AS source_has_blanks
FROM t""",
    "blank_tests_whole": f"""
SELECT doc_id, (text IS NULL OR text IN ('null', '')) AS text_blank,
       (text IS NULL OR length(text) = 0) AS text_empty,
       coalesce(regexp_matches(text, '{_JVM_WS_DUCK}'), false) AS text_has_blanks,
       coalesce(regexp_matches(text, '[一-龥]'), false) AS text_has_cjk,
       coalesce(regexp_matches(source, '{_JVM_WS_DUCK}'), false) AS source_has_blanks
FROM documents""",
    "rejects": f"""WITH {_DIRTY},
j AS (
  SELECT dr.*, '{{"id":' || event_id || ',"as_int":' || t || ',"as_long":' || t || ',"as_float":' || t
    || ',"as_double":' || t || ',"as_string":' || t || ',"flag":"' || flag || '"' AS body
  FROM (SELECT *, CASE WHEN r IS NULL THEN 'null' WHEN event_id % 19 = 0 THEN r ELSE '"' || r || '"' END AS t
        FROM dr) dr)
SELECT row_key AS source_key, 'dirty' AS page_model, 0 AS item_pos,
       CASE reason WHEN 'int_only_dots' THEN 'as_int' WHEN 'bad_boolean' THEN 'flag' END
         AS source_field, reason,
       CASE reason WHEN 'int_only_dots' THEN r WHEN 'bad_boolean' THEN flag ELSE
         CASE event_id % 97 WHEN 0 THEN body || ',' WHEN 1 THEN body || '}} x 1.50'
                            WHEN 2 THEN body || '}}{{"id":2.50}}' WHEN 3 THEN ''
                            WHEN 4 THEN body || '}}],"e":[{{"id":7}}' WHEN 5 THEN body || '}}],"d":[{{"id":7}}'
                            WHEN 6 THEN body || '}}]}}' WHEN 7 THEN body || ',"n":1-2}}'
                            WHEN 8 THEN body || ',"n":1.2.3}}' WHEN 9 THEN body || ',"n":1e+}}'
                            ELSE body || ',"n":"p' || chr(1) || 'q' || chr(2) || 'r' || chr(3) || 's' || chr(4) || '"'
         END END AS raw
FROM j WHERE reason IS NOT NULL""",
    "history_lookup_many": "SELECT * FROM (" + _event_cells(latest=False)
        + """) WHERE family = 'amount' AND row_key IN (
  SELECT CAST(user_id AS VARCHAR) || event_type FROM events WHERE event_type = 'purchase' AND value > 20)""",
    "fanin_ties": _two_sites(),
    "latest_wide_typed": _wide_typed(),
    "sort_stable": """
SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus DESC NULLS LAST, o_orderkey) AS rank
FROM orders""",
    "lenient_timestamp": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 10 = 0 THEN (year(o_orderdate) + 1) || '-01-05 00:00:00'
            WHEN o_orderkey % 10 = 1 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts,
       strftime(make_timestamp(year(o_orderdate) + 1, 2, 1, 2, 2, 1)
                + to_days(CAST(o_orderkey % 400 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS late_ts
FROM orders""",
}
ORACLE["store_update"] = ORACLE["upsert_overwrites"]
ORACLE["store_backfill"] = ORACLE["backfill_upsert"]
