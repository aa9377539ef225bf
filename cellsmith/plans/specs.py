"""Specs of the driver queries, over the page shapes of :mod:`cellsmith.sources.views`."""

from __future__ import annotations

from cellsmith import fixed
from cellsmith.spec import TableSpec, parse_spec

EVENT_TYPES = ["view", "purchase", "signup", "click", "error"]


def _events(amount_type: str):
    columns = {
        "user_id": {"name": "userId", "type": "long"},
        "event_type": {"name": "eventType", "type": "String"},
        "value": {"name": "amount", "type": amount_type},
        "props": {"name": "props", "type": "String"},
    }
    return parse_spec([{
        "tableName": "event_pages", "outputTable": "events_clean",
        "models": {t: {"rowkeyColumns": ["user_id", "event_type"], "columns": columns} for t in EVENT_TYPES},
    }])


EVENTS = _events("int")
#: The same pages with one column typed anew.
EVENTS_RETYPED = _events("String")

#: Two sites of the same pages that write into one table, in either order.
TWO_SITES = [EVENTS[0], TableSpec("second_event_pages", "events_clean", EVENTS[0].models)]
TWO_SITES_TURNED = TWO_SITES[::-1]

DIRTY = parse_spec([{
    "tableName": "dirty_pages", "outputTable": "dirty_clean",
    "models": {"dirty": {"rowkeyColumns": ["id"], "columns": {
        "as_int": {"name": "asInt", "type": "int"},
        "as_long": {"name": "asLong", "type": "long"},
        "as_float": {"name": "asFloat", "type": "float"},
        "as_double": {"name": "asDouble", "type": "double"},
        "as_string": {"name": "asString", "type": "String"},
        "flag": {"name": "flag", "type": "boolean"},
    }}},
}])

BOOL_WORDS = parse_spec([{
    "tableName": "order_pages", "outputTable": "order_flags",
    "models": {"order": {"rowkeyColumns": ["id"], "columns": {
        "status_word": {"name": "statusFlag", "type": "boolean"},
        "sold_out": {"name": "soldOut", "type": "boolean"},
    }}},
}])

_LINE_COLUMNS = {
    "line_no": {"name": "lineNo", "type": "int", "isMulti": True},
    "discount": {"name": "discountRate", "type": "float", "isMulti": True},
    "picture": {"name": "pictureFile", "type": "String", "isMulti": True},
    "qty": {"name": "quantity", "type": "int", "isMulti": True},
    "flags": {"name": "flagPair", "type": "String", "isMulti": True},
    "taxed_qty": {"name": "taxedQuantity", "type": "int", "isMulti": True},
    "tax": {"name": "taxRate", "type": "float", "isMulti": True},
    "return_flag": {"name": "returnFlag", "type": "String"},
    "supplier": {"name": "supplierText", "type": "String"},
    "title": {"name": "title", "type": "String", "isMulti": True},
}


def line_spec(record_time: bool = False):
    """Line pages: row key from the token text, sub-fields of its tokens."""
    subs = {k: {"name": n, "type": t} for k, (n, t) in fixed.MENU_SUBFIELDS.items()}
    model = {"dataPath": "lines", "rowKeyRegex": fixed.MENU_ROWKEY_REGEX,
             "columns": _LINE_COLUMNS | {"specfoods": {"name": "specfoods", "type": "Array", "subColumns": subs}}}
    if record_time:
        model["recordTime"] = True
    return parse_spec([{"tableName": "line_pages", "outputTable": "parts", "models": {"line": model}}])


LINES = line_spec()
LINES_TIMED = line_spec(record_time=True)
#: Row key from a bare number of the item, object or string.
LINES_BY_CODE = parse_spec([{
    "tableName": "line_pages", "outputTable": "parts_by_code",
    "models": {"line": {"dataPath": "lines", "rowKeyRegex": r'"code":(\d+)', "columns": {
        "line_no": {"name": "lineNo", "type": "int"}, "title": {"name": "title", "type": "String"},
        "discount": {"name": "discountText", "type": "String"}}}},
}])

_CUSTOMER_COLUMNS = {
    "name": {"name": "displayName", "type": "String"},
    "id": {"name": "customerId", "type": "String"},
    "street": {"name": "street", "type": "String"},
    "balance": {"name": "balance", "type": "double"},
    "zone": {"name": "zone", "type": "float"},
    "vip": {"name": "isVip", "type": "boolean"},
    "builder": {"name": "isBuilder", "type": "boolean"},
    "phone": {"name": "contact", "type": "String"},
    "visits": {"name": "visits", "type": "int"},
    "segment": {"name": "segment", "type": "String"},
    "wait": {"name": "waitText", "type": "String"},
    "missing": {"name": "never", "type": "String"},
    "opening_hours": {"name": "hours", "type": "Array"},
    "flavors": {"name": "tags", "type": "Array"},
    "supports": {"name": "promises", "type": "Array"},
}

CUSTOMERS = parse_spec([
    {"tableName": "customer_pages", "outputTable": "customers",
     "models": {"customer": {"rowkeyColumns": ["id"], "columns": _CUSTOMER_COLUMNS}}},
    {"tableName": "directory_pages", "outputTable": "customers",
     "models": {"directory": {"dataPath": "members", "rowkeyColumns": ["id"], "columns": {
         "name": {"name": "listName", "type": "String"},
         "logo": {"name": "logoFile", "type": "String"},
         "minutes": {"name": "minutes", "type": "int"},
         "offer": {"name": "offer", "type": "String", "isMulti": True},
     }}}},
])

#: Customer pages keyed by their (possibly CJK) name.
CUSTOMERS_BY_NAME = parse_spec([
    {"tableName": "customer_pages", "outputTable": "customers_by_name",
     "models": {"customer": {"rowkeyColumns": ["name"], "columns": {
         "id": {"name": "customerId", "type": "String"}}}}},
])


def _twin(path: str, column: str, name: str):
    return {"dataPath": path, "rowkeyColumns": ["ID"], "columns": {column: {"name": name, "type": "String"}}}


#: One source, two list paths, model ``a`` in two outputs with other columns, keys ``ID`` and ``id``.
TWINS = parse_spec([
    {"tableName": "twin_pages", "outputTable": "店铺",
     "models": {"a": _twin("as", "id", "supplierName"), "b": _twin("bs", "id", "supplierName")}},
    {"tableName": "twin_pages", "outputTable": "a:b", "models": {"a": _twin("as", "nation", "nationNo")}},
])
