"""Page cleaning: raw pages -> typed cells (+ rejects), one pass for many models.

Plan shape (per source table, whatever the number of models)::

    scan(5 cols, PushedFilters: page_model IN models)
      -> mark numbers where rendering would change them, parse item arrays once   (list models)
      -> posexplode_outer(items)                       (detail: the page is the item)
      -> parse each item once into a struct of wanted keys
      -> per model (own columns, one non-null per row): row key, cells, reject reason
      -> posexplode_outer(cells) => one row per cell, put_seq = write order

All narrow: no shuffle until a merge (see :mod:`cellsmith.operators.merge`).
"""

from __future__ import annotations

from dataclasses import dataclass
from json import dumps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsmith import fixed
from cellsmith.functions import arrays, coerce as co
from cellsmith.functions.jsontext import (ESC_OPEN, NUM_MARK, closed, field_names, flat, mark_inexact, mark_numbers,
                                          parse_items, parse_object_array, parse_record, parse_text_array,
                                          parse_text_map, parse_whole, same_text, sole, unmark)
from cellsmith.functions.sqltext import field, ident, isin, q
from cellsmith.functions.text import day_of, is_blank
from cellsmith.operators.keys import concat_key, regex_key, safe_key
from cellsmith.spec import ColumnSpec, ModelSpec, SubField, Vocab

CELL_FIELDS = [("family", T.StringType()), ("qualifier", T.StringType())] + co.VALUE_FIELDS
CELL_COLUMNS = ["row_key"] + [n for n, _ in CELL_FIELDS] + [
    "download_time", "source_key", "item_pos", "put_seq", "source_no"]
REJECT_COLUMNS = ["source_key", "page_model", "item_pos", "source_field", "raw", "reason"]

PAGE_COLUMNS = ["source_key", "page_model", "data", "propertys", "download_time"]


@dataclass
class CleanResult:
    """Lazy outputs of one cleaning pass over the same item frame."""
    items: DataFrame
    cells: DataFrame
    rejects: DataFrame


def _cell(family: str, qualifier: str, val: str) -> str:
    """SQL of one cell struct; ``val`` is a value struct expression."""
    vals = ", ".join(f"'{n}', {val}.{n}" for n, _ in co.VALUE_FIELDS)
    return f"named_struct('family', {family}, 'qualifier', {qualifier}, {vals})"


def _reason(code: str, source_field: str | None, raw: str | None) -> str:
    return (f"named_struct('reason', {code}, 'source_field', CAST({q(source_field)} AS STRING), "
            f"'raw', CAST({raw or 'NULL'} AS STRING))")


_VALUE_TYPE = "struct<" + ", ".join(f"{n}: {t.simpleString()}" for n, t in co.VALUE_FIELDS) + ">"
_EMPTY_CELLS = ("CAST(array() AS array<struct<family: string, qualifier: string, vtype: string, "
                "v_string: string, v_int: int, v_long: bigint, v_float: float, v_double: double, "
                "v_bool: boolean>>)")


# ---------------------------------------------------------------------------
# item frame (shared by every model of one source table)
# ---------------------------------------------------------------------------
def _model_index(models: list[ModelSpec]) -> tuple[str, bool]:
    """SQL of the indices of the models that clean a page of ``page_model``, and
    whether some pages have more than one (a generator then makes a row for each)."""
    at: dict[str, list[int]] = {}
    for i, m in enumerate(models):
        at.setdefault(m.name, []).append(i)
    many = any(len(v) > 1 for v in at.values())
    body = " ".join(f"WHEN page_model = {q(n)} THEN "
                    + (f"array({', '.join(map(str, v))})" if many else str(v[0])) for n, v in at.items())
    return f"CASE {body} END", many


#: Left of a page's own number marks in a text that is rendered as it stands.
NUM_MARK_ESCAPE = "u0002"


def _of(indices: list[int]) -> str:
    return f"(mi IN ({', '.join(map(str, indices))}))" if indices else "false"


def item_frame(pages: DataFrame, models: list[ModelSpec], zone: str | None = None) -> DataFrame:
    """One row per item (list models) or per page (detail models) and model.

    Columns: source_key, page_model, mi (the model's index in ``models``),
    download_time, day, item_pos, src (a detail page's own text), found (a list item as it
    was found), plain (a list page is rendered as it stands, so ``found`` has no marks), clear (the same of the item, so
    that ``item`` and ``rec`` have none), item (marked item text), rec (the item's
    wanted keys as marked texts; NULL if the item is not one well-formed object), props (map, list models), page_reason.
    """
    names = list(dict.fromkeys(m.name for m in models))
    lists = [i for i, m in enumerate(models) if m.is_list]
    index, many = _model_index(models)
    p = pages.select(*PAGE_COLUMNS).where(F.col("page_model").isin(names))
    p = p.selectExpr(*PAGE_COLUMNS, f"explode({index}) AS mi" if many else f"{index} AS mi")
    p = p.selectExpr("source_key", "page_model", "mi", "download_time", "propertys", "data")
    if lists:
        is_list = _of(lists)
        # a page is parsed for the item array of its own model only
        paths: dict[str, list[int]] = {}
        for i in lists:
            paths.setdefault(models[i].data_path, []).append(i)
        # A mark of the page's own would be an escape in a plain text.
        p = p.selectExpr("*", *[f"CASE WHEN {_of(v)} AND NOT contains(data, {q(NUM_MARK_ESCAPE)}) THEN {parse_items('data', path)} END AS as_is{k}"
                                for k, (path, v) in enumerate(paths.items())])
        # Most plain pages hold objects and nothing else; then what was parsed tells. Others are rendered whole.
        joined = " ".join(f"WHEN {_of(v)} THEN concat({q('{' + dumps(path, ensure_ascii=False) + ':[')}, array_join({sole(f'as_is{k}')}.{ident(path)}, ','), ']}}') = data"
                          for k, (path, v) in enumerate(paths.items()))
        p = p.selectExpr("*", f"coalesce(CASE {joined} END, false) AS joined")
        parsed = " OR ".join(f"{sole(f'as_is{k}')} IS NOT NULL" for k in range(len(paths)))
        p = p.selectExpr("*", f"CASE WHEN NOT joined AND ({parsed}) THEN {parse_whole('data')} END AS whole")
        p = p.selectExpr("source_key", "page_model", "mi", "download_time", "propertys", "data", *[f"as_is{k}" for k in range(len(paths))],
                         f"joined OR {same_text('whole', 'data')} AS plain")
        p = p.selectExpr("*", f"CASE WHEN plain THEN data ELSE {mark_numbers('data')} END AS mdata")
    else:
        p = p.selectExpr("*", "false AS plain", f"{mark_numbers('data')} AS mdata")

    null_data = ("mdata IS NULL", _reason("'null_data'", None, None))
    null_dt = ("download_time IS NULL", _reason("'null_download_time'", None, None))
    if lists:
        p = p.selectExpr(
            "*", *[f"CASE WHEN plain THEN as_is{k} WHEN {_of(v)} THEN {parse_items('mdata', path)} END AS doc{k}"
                   for k, (path, v) in enumerate(paths.items())],
            f"CASE WHEN {is_list} AND propertys IS NOT NULL "
            f"THEN {parse_text_map(mark_inexact('propertys'))} END AS props")
        good = " ".join(f"WHEN {_of(v)} THEN {sole(f'doc{k}')} IS NOT NULL AND (plain OR {closed('mdata')})" for k, v in enumerate(paths.values()))
        items = " ".join(f"WHEN {_of(v)} THEN {sole(f'doc{k}')}.{ident(path)}" for k, (path, v) in enumerate(paths.items()))
        p = p.selectExpr("source_key", "page_model", "mi", "download_time", "propertys", "data", "plain", "mdata", "props",
                         f"CASE {good} END AS good", f"CASE {items} END AS found")
        items = f"CASE WHEN {is_list} THEN CASE WHEN good THEN found END ELSE array(mdata) END"
        bad_props = "(propertys IS NOT NULL AND props IS NULL AND trim(propertys) NOT IN ('null', ''))"
        branches = [
            null_data, null_dt,
            (f"{is_list} AND NOT good", _reason("'bad_data_json'", None, "data")),
            (f"{is_list} AND {bad_props}", _reason("'bad_propertys_json'", "propertys", "propertys")),
            (f"{is_list} AND exists(map_values(props), v -> v IS NULL)",
             _reason("'null_property'", "propertys", "propertys")),
        ]
    else:
        p = p.selectExpr("*", "CAST(NULL AS map<string,string>) AS props")
        items = "array(mdata)"
        branches = [null_data, null_dt]
    page_reason = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + " END"

    # the source text of a detail page; a list page's would be repeated on every item
    src = f"CASE WHEN NOT {is_list} THEN data END" if lists else "data"
    # without escapes and single quotes, an item with a double quote is no string
    quoted = f"(contains(data, {q(chr(92))}) OR contains(data, {q(chr(39))}))"
    # in columns of their own, so that the page's text is not repeated on every item
    x = p.selectExpr("source_key", "page_model", "mi", "download_time", "props", "plain",
                     f"{f'plain AND {quoted}' if lists else 'false'} AS quoted", f"{src} AS src",
                     f"{page_reason} AS page_reason", f"{items} AS found_items")
    x = x.selectExpr("source_key", "page_model", "mi", "download_time", "props", "plain", "quoted", "src", "page_reason",
                     "posexplode_outer(found_items) AS (item_pos, found)")
    # Pages with no items and nothing wrong write nothing.
    x = x.where("item_pos IS NOT NULL OR page_reason IS NOT NULL")
    base = ["source_key", "page_model", "mi", "download_time", "props", "page_reason", "src", "found", "plain"]
    # An item may be an object or a string holding one. An object item's
    # text was rendered from the marked page, so its numbers already carry
    # the (escaped) mark; a string item's JSON was opaque to that pass and
    # is marked now. An object without numbers is marked again: a no-op.
    # An item of a plain page has no marks yet, and needs none if it is rendered as it stands too.
    item, clear = "found", "false"
    if lists:
        x = x.selectExpr(*base, "item_pos", "quoted", f"CASE WHEN quoted THEN {parse_whole('found')} END AS whole")
        clear = f"plain AND CASE WHEN quoted THEN {same_text('whole', 'found')} ELSE contains(found, '{chr(34)}') END"
        if any(_token_columns(m) for m in models):  # a number at the head of an array is told from a string by its mark
            head = f'"{fixed.SUBFIELD_ARRAY_KEY}":['
            clear += f""" AND NOT contains(replace(found, {q(head + '"')}, ''), {q(head)})"""
        x = x.selectExpr(*base, "item_pos", f"coalesce({clear}, false) AS clear")
        item = (f"CASE WHEN clear THEN found WHEN plain OR {is_list} AND NOT contains(found, {q(ESC_OPEN)}) "
                f"AND NOT startswith(found, {q(NUM_MARK)}) THEN {mark_numbers('found')} ELSE found END")
        clear = "clear"
    base.append("clear")
    x = x.selectExpr(*base[:-1], f"{clear} AS clear", "CAST(item_pos AS INT) AS item_pos", f"{item} AS item")
    keys = list(dict.fromkeys(k for m in models for k in m.field_keys())) or [""]
    x = x.selectExpr(*base, "item_pos", "item",
                     f"{day_of('download_time', zone)} AS day", f"{parse_record('item', keys)} AS doc")
    return x.selectExpr(*base, "item_pos", "item", "day", f"CASE WHEN clear OR {flat('item')} OR {closed('item')} THEN {sole('doc')} END AS rec")


# ---------------------------------------------------------------------------
# per-model expressions, in layers so each coercion runs once per item
# ---------------------------------------------------------------------------
class _Names:
    """Column names of the typed layers."""

    def __init__(self, models: list[ModelSpec]):
        keys = list(dict.fromkeys(k for m in models for k in m.field_keys()))
        self.key_index = {k: n for n, k in enumerate(keys)}
        self.names = dict(zip(keys, field_names(keys), strict=True))

    def field(self, key: str) -> str:         # marked field text
        return field("rec", self.names[key])

    def text(self, key: str) -> str:          # unmarked field text
        return f"_t{self.key_index[key]}"

    @staticmethod
    def pre(i: int, j: int) -> str:           # parsed number / boolean / array
        return f"_p{i}_{j}"

    @staticmethod
    def val(i: int, j: int) -> str:           # value struct (or typed tokens)
        return f"_v{i}_{j}"

    @staticmethod
    def sure(i: int, j: int) -> str:          # whether all tokens parse
        return f"_s{i}_{j}"

    @staticmethod
    def tokens(i: int, j: int) -> str:        # tokens by key, where no key is there twice
        return f"_m{i}_{j}"

    @staticmethod
    def sub(i: int, j: int, k: int) -> str:   # value struct of a sub-field in them
        return f"_u{i}_{j}_{k}"

    @staticmethod
    def why(i: int, j: int) -> str:           # column reject reason
        return f"_r{i}_{j}"


def _present(nm: _Names, i: int, c: ColumnSpec) -> str:
    return f"(mi = {i} AND NOT {is_blank(nm.text(c.source))})"


def _pre_layer(nm: _Names, i: int, m: ModelSpec, vocab: Vocab) -> list[str]:
    """Parse steps referenced more than once later (numbers, words, arrays)."""
    out = []
    for j, c in enumerate(m.columns):
        on = _present(nm, i, c)
        t = nm.text(c.source)
        if c.type in ("int", "long", "float", "double"):
            out.append(f"CASE WHEN {on} THEN {co.parsed_number(t, c.type)} END AS {nm.pre(i, j)}")
        elif c.type == "boolean":
            out.append(f"CASE WHEN {on} THEN {co.vocab_boolean(t, c.source, vocab)} END "
                       f"AS {nm.pre(i, j)}")
        elif c.type == "Array":
            raw = nm.field(c.source)
            if not m.is_list and c.source not in vocab.array_keys \
                    and c.source in fixed.JOIN_FIELD_KEYS:
                arr = parse_object_array(raw, fixed.JOIN_FIELD_KEYS[c.source])
            else:
                arr = parse_text_array(raw)
            out.append(f"CASE WHEN {on} THEN {arr} END AS {nm.pre(i, j)}")
    return out


def _token_columns(m: ModelSpec) -> list[int]:
    """Columns of ``m`` whose text is split into sub-fields."""
    return [j for j, c in enumerate(m.columns) if _splits(m, c)]


def _splits(m: ModelSpec, c: ColumnSpec) -> bool:
    return m.is_list and c.type == "Array" and c.source == fixed.SUBFIELD_ARRAY_KEY and bool(c.sub_columns)


def _asked(c: ColumnSpec, wanted: Wanted) -> list[SubField]:
    return [s for s in c.sub_columns if wanted.has_latest(s.name) or wanted.has_history(s.name)]


def _sure_layer(nm: _Names, i: int, m: ModelSpec) -> list[str]:
    """Whether one match tells that all tokens of a text parse."""
    return [f"CASE WHEN size({nm.pre(i, j)}) > 0 THEN "
            f"{arrays.sure_tokens(nm.pre(i, j) + '[0]', {s.source: s.type for s in m.columns[j].sub_columns})} END AS {nm.sure(i, j)}"
            for j in _token_columns(m)]


def _token_layers(nm: _Names, i: int, m: ModelSpec, wanted: Wanted) -> list[list[str]]:
    """The tokens of such texts by key, where each sub-field that is asked for is there once at most: parsed, then told. Cells
    of two keys with one name are written in the tokens' order, so there the tokens are taken one by one."""
    parsed, told = [], []
    for j in _token_columns(m):
        subs = _asked(m.columns[j], wanted)
        on = subs and len({s.name for s in m.columns[j].sub_columns}) == len(m.columns[j].sub_columns)
        made = f"CASE WHEN {nm.sure(i, j)} THEN {arrays.token_map(nm.pre(i, j) + '[0]')} END" if on else "CAST(NULL AS map<string,string>)"
        t = f"{nm.tokens(i, j)}_"
        parsed.append(f"{made} AS {t}")
        # a key that is no sub-field's may be there any number of times
        once = " AND ".join(f"size(array_remove(map_keys({t}), {q(s.source)})) >= size({t}) - 1" for s in subs)
        told.append(f"CASE WHEN {once or 'false'} THEN {t} END AS {nm.tokens(i, j)}")
    return [parsed, told]


def _value_layer(nm: _Names, i: int, m: ModelSpec, vocab: Vocab, wanted: Wanted) -> list[str]:
    """Value struct and reject reason of every column."""
    out = []
    for j, c in enumerate(m.columns):
        on = _present(nm, i, c)
        t = nm.text(c.source)
        pre = nm.pre(i, j)
        if c.type != "Array":
            val, why = co.coerce(t, pre, c.type, c.source, vocab)
            out.append(f"CASE WHEN {on} THEN {val} END AS {nm.val(i, j)}")
            out.append(f"CASE WHEN {on} AND ({why}) IS NOT NULL THEN "
                       f"{_reason(why, c.source, t)} END AS {nm.why(i, j)}")
            continue
        bad = arrays.array_reason(pre)
        if _splits(m, c):
            first, sure, tokens = f"{pre}[0]", nm.sure(i, j), nm.tokens(i, j)

            def typed(subs: list[SubField], sure: bool) -> str:
                def token(k: str, v: str) -> str:
                    named = " ".join(f"WHEN {k} = {q(s.source)} THEN named_struct('name', {q(s.name)}, "
                                     f"'val', {co.strict_parse(v, s.type, sure)})" for s in subs)
                    return f"CASE WHEN NOT {is_blank(v)} THEN CASE {named} END END"
                return arrays.map_tokens(first, token)

            # Every token is checked. One match tells of most texts that all parse, and then only those asked for
            # are typed, from a map where none of them is there twice.
            asked = _asked(c, wanted)
            for k, s in enumerate(c.sub_columns):
                if s in asked:
                    v = f"{tokens}[{q(s.source)}]"
                    out.append(f"CASE WHEN {on} AND NOT {is_blank(v)} THEN {co.strict_parse(v, s.type, True)} END AS {nm.sub(i, j, k)}")
            toks = f"CASE WHEN {sure} THEN {typed(asked, True) if asked else 'NULL'} ELSE {typed(c.sub_columns, False)} END"
            out.append(f"CASE WHEN {on} AND {pre} IS NOT NULL AND size({pre}) > 0 AND {tokens} IS NULL THEN {toks} END "
                       f"AS {nm.val(i, j)}")
            why = (f"CASE WHEN {pre} IS NULL THEN 'bad_array' WHEN size({pre}) = 0 THEN NULL "
                   f"WHEN {first} IS NULL OR startswith({first}, {q(NUM_MARK)}) "
                   f"THEN 'bad_subfield_text' END")
        elif m.is_list or (c.source not in vocab.array_keys and c.source not in fixed.JOIN_FIELD_KEYS):
            # never rendered: it only has to be an array
            out.append(f"CAST(NULL AS {_VALUE_TYPE}) AS {nm.val(i, j)}")
            why = f"CASE WHEN {pre} IS NULL THEN 'bad_array' END"
        else:
            joined = (arrays.join_spaced(pre) if c.source in vocab.array_keys
                      else arrays.join_field(pre, fixed.JOIN_FIELD_KEYS[c.source], "/"))
            out.append(f"CASE WHEN {on} AND ({bad}) IS NULL AND {joined} <> '' THEN "
                       f"{co.value('string', joined)} END AS {nm.val(i, j)}")
            why = bad
        out.append(f"CASE WHEN {on} AND ({why}) IS NOT NULL THEN "
                   f"{_reason(why, c.source, t)} END AS {nm.why(i, j)}")
    return out


def model_key(nm: _Names, m: ModelSpec) -> str:
    """Row key of model ``m``: regex over the item text, else composite + CJK hash."""
    if m.uses_regex_key:
        return regex_key(f"(CASE WHEN plain THEN found ELSE {unmark('found')} END)", m.rowkey_regex)
    return safe_key(concat_key([nm.text(k) for k in m.rowkey_columns]))


@dataclass(frozen=True)
class Wanted:
    """Cells that a job asks for: names of latest cells and history families (None: all).

    Cells that are not asked for are never built; every column's input is still
    checked, so the rejects are the same.
    """
    latest: frozenset[str] | None = None
    history: frozenset[str] | None = None

    def has_latest(self, name: str) -> bool:
        return self.latest is None or name in self.latest

    def has_history(self, family: str) -> bool:
        return self.history is None or family in self.history


def model_cells(nm: _Names, i: int, m: ModelSpec, wanted: Wanted) -> tuple[str, str]:
    """(cells array, reason) of model ``m`` over the typed layers, in write order."""
    parts: list[str] = []
    slots: list[str] = []
    reasons: list[str] = []

    def flush():
        if slots:
            parts.append("array(" + ", ".join(slots) + ")")
            slots.clear()

    day = "day"
    latest = q(fixed.LATEST_FAMILY)
    if (m.record_time or not m.is_list) and wanted.has_history(fixed.DOWNLOAD_TIME_FAMILY):
        slots.append(_cell(q(fixed.DOWNLOAD_TIME_FAMILY), day,
                           co.value("long", "download_time")))
    if m.is_list and (wanted.latest is None or wanted.latest):
        flush()
        asked = "" if wanted.latest is None else f" AND {isin('e.key', sorted(wanted.latest))}"
        props = f"filter(map_entries(props), e -> e.value <> ''{asked})"
        prop_cell = _cell(latest, "e.key", co.value("string", unmark("e.value")))
        parts.append(f"coalesce(transform({props}, e -> {prop_cell}), {_EMPTY_CELLS})")
    for j, c in enumerate(m.columns):
        v, why = nm.val(i, j), nm.why(i, j)
        reasons.append(why)
        if c.type == "Array" and m.is_list:
            if _splits(m, c):
                reasons.append(f"CASE WHEN exists({v}, x -> x IS NOT NULL AND x.val IS NULL) THEN "
                               f"{_reason(q('bad_subfield'), c.source, nm.text(c.source))} END")
                subs = [s.name for s in c.sub_columns]
                two = []
                for cell, names in ((_cell(latest, "x.name", "x.val"), [n for n in subs if wanted.has_latest(n)]),
                                    (_cell("x.name", day, "x.val"), [n for n in subs if wanted.has_history(n)])):
                    if names:
                        on = "x IS NOT NULL" if len(names) == len(subs) else isin("x.name", names)
                        two.append(f"CASE WHEN {on} THEN {cell} END")
                if two:
                    flush()
                    each = []
                    for k, s in enumerate(c.sub_columns):
                        u = nm.sub(i, j, k)
                        each += [f"CASE WHEN {u} IS NOT NULL THEN {cell} END" for cell, has in (
                            (_cell(latest, q(s.name), u), wanted.has_latest(s.name)),
                            (_cell(q(s.name), day, u), wanted.has_history(s.name))) if has]
                    parts.append(f"CASE WHEN {nm.tokens(i, j)} IS NOT NULL THEN array({', '.join(each)}) "
                                 f"ELSE coalesce(flatten(transform({v}, x -> array({', '.join(two)}))), {_EMPTY_CELLS}) END")
            continue
        lat = [f"CASE WHEN {v} IS NOT NULL THEN {_cell(latest, q(c.name), v)} END"] if wanted.has_latest(c.name) else []
        hist = [f"CASE WHEN {v} IS NOT NULL THEN {_cell(q(c.name), day, v)} END"] if wanted.has_history(c.name) else []
        if m.is_list:
            slots.extend(lat + hist if c.is_multi else lat)
        else:
            slots.extend(hist + lat)
    flush()
    # NULL slots stay in the array (dropped after the generator): their
    # positions keep the write order without another pass over the array.
    cells = _EMPTY_CELLS if not parts else parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")"

    item_reason = (f"CASE WHEN found IS NULL THEN {_reason(q('null_item'), None, None)} "
                   f"WHEN rec IS NULL THEN "
                   f"{_reason(q('bad_item_json' if m.is_list else 'bad_data_json'), None, unmark('found') if m.is_list else 'src')} END")
    key_reason = f"CASE WHEN _key{i} = '' THEN {_reason(q('empty_row_key'), None, None)} END"
    return cells, "coalesce(" + ", ".join([item_reason, key_reason] + reasons) + ")"


def clean(pages: DataFrame, models: list[ModelSpec], vocab: Vocab | None = None,
          zone: str | None = None, on_error: str = "reject", wanted: Wanted = Wanted(),
          ordinals: list[int] | None = None) -> CleanResult:
    """Clean every model of one source table in a single pass.

    Two models of the same name (for two output tables, say) each clean that
    name's pages; ``items`` tells them apart by ``model_index``. ``ordinals`` are the
    models' places in a spec of several sources: of two cells alike in all other
    parts of the write order, the later place wins.
    ``on_error='reject'`` routes an item the contract cannot store to
    ``rejects`` (and writes none of its cells); ``'fail'`` raises instead.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")
    vocab = vocab or Vocab()
    models = list(models)
    nm = _Names(models)
    x = item_frame(pages, models, zone)
    x = x.selectExpr("*", *[f"CASE WHEN clear THEN {nm.field(k)} ELSE {unmark(nm.field(k))} END AS {nm.text(k)}" for k in nm.key_index])
    keys = [f"CASE WHEN mi = {i} THEN {model_key(nm, m)} END AS _key{i}" for i, m in enumerate(models)]
    x = x.selectExpr("*", *keys, *[e for i, m in enumerate(models) for e in _pre_layer(nm, i, m, vocab)])
    for layer in zip(*[[_sure_layer(nm, i, m), *_token_layers(nm, i, m, wanted)] for i, m in enumerate(models)], strict=True):
        if any(layer):
            x = x.selectExpr("*", *[e for part in layer for e in part])
    x = x.selectExpr("*", *[e for i, m in enumerate(models) for e in _value_layer(nm, i, m, vocab, wanted)])

    # One column per model for each output; only one is non-null per row, so
    # combining them is a cheap coalesce over column references.
    per_model = []
    for i, m in enumerate(models):
        cells, reason = model_cells(nm, i, m, wanted)
        per_model += [f"CASE WHEN mi = {i} THEN {cells} END AS _cells{i}",
                      f"CASE WHEN mi = {i} THEN {reason} END AS _why{i}"]
    n = len(models)
    x = x.selectExpr("source_key", "page_model", "mi", "download_time", "item_pos", "page_reason",
                     *[f"_key{i}" for i in range(n)], *per_model)

    reject = "coalesce(page_reason, " + ", ".join(f"_why{i}" for i in range(n)) + ")"
    if on_error == "fail":
        reject = (f"CAST(CASE WHEN {reject} IS NOT NULL THEN raise_error(concat('cannot clean item: ', "
                  f"{reject}.reason, ' source_key=', coalesce(source_key, 'null'))) END "
                  f"AS struct<reason: string, source_field: string, raw: string>)")
    row_key = ("CASE WHEN page_reason IS NULL THEN "
               + ("coalesce(" + ", ".join(f"_key{i}" for i in range(n)) + ")" if n > 1 else "_key0")
               + " END")
    x = x.selectExpr("source_key", "page_model", "mi", "download_time", "item_pos",
                     f"{reject} AS reject", f"{row_key} AS row_key",
                     ("coalesce(" + ", ".join(f"_cells{i}" for i in range(n)) + ")" if n > 1
                      else "_cells0") + " AS _cells")
    at = "mi" if ordinals is None else f"element_at(array({', '.join(map(str, ordinals))}), mi + 1)"
    items = x.selectExpr("source_key", "page_model", "mi AS model_index", f"{at} AS source_no", "download_time",
                         "item_pos", "reject", "row_key", "CASE WHEN reject IS NULL THEN _cells END AS cells")

    return CleanResult(items=items, cells=cells_from_items(items), rejects=rejects_from_items(items))


def cells_from_items(items: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per cell of the accepted items; ``put_seq`` is the write order.

    ``extra`` item columns (e.g. an output-table tag) are carried along.
    """
    # A rejected item has NULL cells, so no filter is needed before the
    # generator (a filter there would be pushed down and repeat the reason
    # expression). posexplode_outer also avoids the size(cells) > 0 filter
    # Catalyst infers for a plain generator.
    cells = items.selectExpr("row_key", "download_time", "source_key", "item_pos", "source_no", *extra,
                             "posexplode_outer(cells) AS (put_seq, cell)")
    return cells.where("cell IS NOT NULL").selectExpr(
        "row_key", *[f"cell.{n} AS {n}" for n, _ in CELL_FIELDS],
        "download_time", "source_key", "item_pos", "CAST(put_seq AS INT) AS put_seq", "source_no", *extra)


def rejects_from_items(items: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per rejected item, with the first reason found."""
    # The reason goes through a generator and is filtered on its output: a filter
    # on the item would be pushed below the layers and repeat all of them.
    r = items.selectExpr("source_key", "page_model", "item_pos", *extra,
                         "explode_outer(CASE WHEN reject IS NOT NULL THEN array(reject) END) AS r")
    return r.where("r IS NOT NULL").selectExpr(
        "source_key", "page_model", "item_pos", "r.source_field AS source_field",
        "r.raw AS raw", "r.reason AS reason", *extra)
