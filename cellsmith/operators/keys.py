"""Row keys: composite, regex, CJK-hashed (SQL text; ``*_col`` give Columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsmith.functions.sqltext import ident, q
from cellsmith.functions.text import contains_cjk, md5_16


def concat_key(fields: list[str]) -> str:
    """Key fields' texts concatenated, no separator; a missing field adds ``null``."""
    return "concat(" + ", ".join(f"coalesce({f}, 'null')" for f in fields) + ")"


def safe_key(k: str) -> str:
    """A key holding a CJK character is replaced by its 16-character MD5."""
    return f"(CASE WHEN {contains_cjk(k)} THEN {md5_16(k)} ELSE {k} END)"


def regex_key(text: str, regex: str) -> str:
    """Group 1 of the *last* match of ``regex`` in ``text``; empty text if none."""
    return f"coalesce(try_element_at(regexp_extract_all({text}, {q(regex)}, 1), -1), '')"


def regex_key_col(c: str, regex: str) -> Column:
    return F.expr(regex_key(ident(c), regex))


def regex_matches(df: DataFrame, text_col: str, regex: str, out: str = "match") -> DataFrame:
    """One row per match of ``regex`` (group 1) in ``text_col``, with its position."""
    gen = f"posexplode(regexp_extract_all({ident(text_col)}, {q(regex)}, 1)) AS (match_pos, {ident(out)})"
    return df.selectExpr("*", gen)
