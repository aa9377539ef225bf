"""Scalar text predicates and helpers (built-in SQL; ``*_col`` give Columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellsmith.functions.sqltext import ident, q

# --- fixed values: character classes ----------------------------------------
# CJK unified ideographs U+4E00..U+9FA5.
CJK_CLASS = "[一-龥]"
# JVM whitespace: separators and the ASCII/ISO whitespace controls, but not the
# no-break spaces U+00A0, U+2007, U+202F.
JVM_WHITESPACE = r"[\s\x1c-\x1f\p{Z}&&[^\u00a0\u2007\u202f]]"


def is_blank(x: str) -> str:
    """NULL, the text ``null`` or the empty text; whitespace-only is not blank."""
    return f"({x} IS NULL OR {x} IN ('null', ''))"


def is_empty(x: str) -> str:
    return f"({x} IS NULL OR length({x}) = 0)"


def contains_blanks(x: str) -> str:
    """True iff the text holds any JVM whitespace character; false on NULL."""
    return f"coalesce({x} RLIKE {q(JVM_WHITESPACE)}, false)"


def contains_cjk(x: str) -> str:
    return f"({x} RLIKE {q(CJK_CLASS)})"


def md5_16(x: str) -> str:
    """Middle 16 hex characters (8..23) of the lower-case MD5 of the UTF-8 text."""
    return f"substring(md5({x}), 9, 16)"


def day_of(ms: str, zone: str | None = None) -> str:
    """``yyyy-MM-dd`` of an epoch-millisecond time.

    With no zone the day is UTC and computed arithmetically; otherwise the
    wall-clock day in ``zone``. Neither depends on the session time zone.
    """
    if zone is None or zone.upper() in ("UTC", "Z", "GMT"):
        return f"CAST(date_from_unix_date(CAST(floor({ms} / 86400000) AS INT)) AS STRING)"
    utc = f"(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {ms} / 1000))"
    return f"date_format(convert_timezone('UTC', {q(zone)}, {utc}), 'yyyy-MM-dd')"


def normalize_timestamp(x: str, lenient: bool = False) -> str:
    """``yyyy-MM-dd HH:mm:ss`` from loose date-time text, else NULL.

    Every character that is not a digit or ``:`` counts as a separator; the
    text must then read ``year month day hour:minute:second``. With ``lenient`` a part
    beyond its range rolls over into the next larger one (month 13 is January of the
    next year, day 0 the last of the month before, hour 25 one o'clock of the next
    day); parts of more than six digits, and results beyond the years 1 to 9999, are NULL.
    """
    shape = q(r"(?s)^[^0-9:]*([0-9]+)[^0-9:]+([0-9]+)[^0-9:]+([0-9]+)[^0-9:]+([0-9]+):([0-9]+):([0-9]+).*$")
    one = f"split(regexp_replace({x}, {shape}, '$1 $2 $3 $4 $5 $6'), ' ')"
    if lenient:
        n = [f"CAST(p[{i}] AS BIGINT)" for i in range(6)]
        # months since January of year 0, then days, then seconds
        month = f"({n[0]} * 12 + {n[1]} - 1)"
        date = (f"date_add(make_date(CAST({month} DIV 12 AS INT), CAST({month} % 12 AS INT) + 1, 1), "
                f"CAST({n[2]} - 1 AS INT))")
        seconds = f"({n[3]} * 3600 + {n[4]} * 60 + {n[5]})"
        made = (f"CASE WHEN {month} BETWEEN 12 AND 119999 THEN timestampadd(SECOND, {seconds}, "
                f"CAST({date} AS TIMESTAMP_NTZ)) END")
        ok = "size(p) = 6 AND NOT exists(p, v -> length(v) > 6)"
        ts = f"transform(array({one}), p -> CASE WHEN {ok} THEN {made} END)[0]"
        inside = f"transform(array({ts}), t -> CASE WHEN year(t) BETWEEN 1 AND 9999 THEN t END)[0]"
        return f"(CASE WHEN {x} RLIKE {shape} THEN date_format({inside}, 'yyyy-MM-dd HH:mm:ss') END)"
    parts = ", ".join(f"try_cast(get(p, {i}) AS INT)" for i in range(6))
    ts = f"transform(array({one}), p -> CASE WHEN size(p) = 6 THEN try_make_timestamp_ntz({parts}) END)[0]"
    return f"(CASE WHEN {x} RLIKE {shape} THEN date_format({ts}, 'yyyy-MM-dd HH:mm:ss') END)"


def _wrap(fn):
    def col_fn(c: str, *args) -> Column:
        return F.expr(fn(ident(c), *args))
    col_fn.__doc__ = fn.__doc__
    return col_fn


is_blank_col = _wrap(is_blank)
is_empty_col = _wrap(is_empty)
contains_blanks_col = _wrap(contains_blanks)
contains_cjk_col = _wrap(contains_cjk)
md5_16_col = _wrap(md5_16)
day_of_col = _wrap(day_of)
normalize_timestamp_col = _wrap(normalize_timestamp)
