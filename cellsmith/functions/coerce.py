"""Typed coercion of field text into a cell value (SQL expression text).

A cell value is ``struct<vtype, v_string, v_int, v_long, v_float, v_double,
v_bool>`` with exactly one ``v_*`` set; ``vtype`` names it. A number that does
not parse is kept as text (``vtype = 'string'``), never nulled.

Each coercion returns ``(value, reason)``: ``reason`` is NULL for a good value
and a short code for input the cleaning contract cannot store (it becomes a
reject). Spark's casts accept more than the JVM number parsers (padded ints,
``inf``, ``nan``), so every cast is guarded to JVM grammar first.
"""

from __future__ import annotations

from pyspark.sql import types as T

from cellsmith.functions.sqltext import isin, q
from cellsmith.spec import Vocab

VALUE_FIELDS = [
    ("vtype", T.StringType()),
    ("v_string", T.StringType()),
    ("v_int", T.IntegerType()),
    ("v_long", T.LongType()),
    ("v_float", T.FloatType()),
    ("v_double", T.DoubleType()),
    ("v_bool", T.BooleanType()),
]
_SQL_TYPE = {"v_string": "STRING", "v_int": "INT", "v_long": "BIGINT", "v_float": "FLOAT",
             "v_double": "DOUBLE", "v_bool": "BOOLEAN"}
_SLOT = {"string": "v_string", "int": "v_int", "long": "v_long", "float": "v_float",
         "double": "v_double", "boolean": "v_bool"}

# JVM integer grammar: optional sign, ASCII digits, nothing else.
INT_TEXT = r"^[+-]?[0-9]+\z"
_SPARK_ONLY_SPECIAL = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*\z"
_JVM_SPECIAL = r"^\s*[+-]?(NaN|Infinity)\s*\z"
# Only ASCII letters have a lower case among those of these words.
TRUE_TEXT, FALSE_TEXT = r"(?i)\Atrue\z", r"(?i)\Afalse\z"
NO_REASON = "CAST(NULL AS STRING)"
#: Sub-field texts that :func:`strict_parse` parses whatever their digits, by type; no text fails as ``String``.
SURE = {"int": "[+-]?[0-9]{1,9}", "float": r"[+-]?[0-9]{1,15}(?:\.[0-9]{1,15})?",
        "double": r"[+-]?[0-9]{1,15}(?:\.[0-9]{1,15})?", "boolean": "(?i:true|false)"}


def value(vtype: str, v: str) -> str:
    """A cell value holding ``v`` in the slot of ``vtype``."""
    slot = _SLOT[vtype]
    parts = [f"'vtype', {q(vtype)}"]
    for n, t in _SQL_TYPE.items():
        parts.append(f"'{n}', CAST({v if n == slot else 'NULL'} AS {t})")
    return f"named_struct({', '.join(parts)})"


def number_or_text(parsed: str, vtype: str, text: str) -> str:
    """The parsed number, or the text when it did not parse (``parsed`` is
    referenced three times, so callers pass a column name)."""
    slot = _SLOT[vtype]
    parts = [f"'vtype', CASE WHEN {parsed} IS NULL THEN 'string' ELSE {q(vtype)} END"]
    for n, t in _SQL_TYPE.items():
        if n == "v_string":
            v = f"CASE WHEN {parsed} IS NULL THEN {text} END"
        elif n == slot:
            v = parsed
        else:
            v = "NULL"
        parts.append(f"'{n}', CAST({v} AS {t})")
    return f"named_struct({', '.join(parts)})"


def parse_int(t: str) -> str:
    return f"CASE WHEN {t} RLIKE {q(INT_TEXT)} THEN try_cast({t} AS INT) END"


def parse_long(t: str) -> str:
    return f"CASE WHEN {t} RLIKE {q(INT_TEXT)} THEN try_cast({t} AS BIGINT) END"


def _parse_fp(t: str, sql_type: str) -> str:
    return (f"CASE WHEN NOT ({t} RLIKE {q(_SPARK_ONLY_SPECIAL)} AND NOT {t} RLIKE {q(_JVM_SPECIAL)}) "
            f"THEN try_cast({t} AS {sql_type}) END")


def parse_float(t: str) -> str:
    return _parse_fp(t, "FLOAT")


def parse_double(t: str) -> str:
    return _parse_fp(t, "DOUBLE")


def truncate_at_dot(v: str) -> str:
    """Text before the first ``.`` (the whole text when there is none)."""
    return f"CASE WHEN contains({v}, '.') THEN substring_index({v}, '.', 1) ELSE {v} END"


def parsed_number(v: str, ctype: str) -> str | None:
    """The parse step of a numeric spec type (None for non-numeric types)."""
    if ctype == "int":
        return parse_int(f"({truncate_at_dot(v)})")
    if ctype == "long":
        return parse_long(v)
    if ctype == "float":
        return parse_float(v)
    if ctype == "double":
        return parse_double(v)
    return None


def vocab_boolean(v: str, source_key: str, vocab: Vocab) -> str:
    """Boolean by vocabulary, in order: true words, false words, a special key
    (any other text means true), then case-insensitive ``true``/``false``."""
    head = (f"WHEN {isin(v, vocab.true_words)} THEN true "
            f"WHEN {isin(v, vocab.false_words)} THEN false")
    if source_key in vocab.special_bool_keys:
        return f"(CASE {head} ELSE true END)"
    return (f"(CASE {head} WHEN lower({v}) = 'true' THEN true "
            f"WHEN lower({v}) = 'false' THEN false END)")


def coerce(v: str, parsed: str | None, ctype: str, source_key: str, vocab: Vocab
           ) -> tuple[str, str]:
    """Field text (known non-blank) to ``(value, reason)`` by spec type.

    ``parsed`` names a column holding :func:`parsed_number` (numeric types)
    or :func:`vocab_boolean` (boolean).
    """
    if ctype == "String":
        return value("string", v), NO_REASON
    if ctype == "int":
        t = f"({truncate_at_dot(v)})"
        why = f"CASE WHEN {v} RLIKE '^[.]+$' THEN 'int_only_dots' END"
        return number_or_text(parsed, "int", t), why
    if ctype in ("long", "float", "double"):
        return number_or_text(parsed, ctype, v), NO_REASON
    if ctype == "boolean":
        return value("boolean", parsed), f"CASE WHEN {parsed} IS NULL THEN 'bad_boolean' END"
    raise ValueError(f"not a scalar type: {ctype}")


def strict_parse(v: str, stype: str, sure: bool = False) -> str:
    """Sub-field value, strictly typed; NULL when it does not parse.

    No truncation and no text fallback; a boolean is stored negated
    (``sold_out:False`` means available). ``sure``: of a text that :data:`SURE` has matched, so that
    it is parsed once and without the guards.
    """
    if stype == "String":
        return value("string", v)
    if sure and stype == "boolean":
        return value("boolean", f"lower({v}) = 'false'")
    if sure:
        return value(stype, f"try_cast({v} AS {_SQL_TYPE[_SLOT[stype]]})")
    if stype == "boolean":
        neg = f"(CASE WHEN {v} RLIKE {q(TRUE_TEXT)} THEN false WHEN {v} RLIKE {q(FALSE_TEXT)} THEN true END)"
        return f"CASE WHEN {neg} IS NOT NULL THEN {value('boolean', neg)} END"
    p = {"int": parse_int, "float": parse_float, "double": parse_double}[stype](v)
    vt = {"int": "int", "float": "float", "double": "double"}[stype]
    return f"CASE WHEN ({p}) IS NOT NULL THEN {value(vt, p)} END"
