"""Helpers to write Spark SQL expression text.

The cleaning compiler emits SQL expression text and hands each output column
to Spark as one ``selectExpr`` string: the JVM parses and analyses it in one
call, instead of one Python-to-JVM call per function of the expression tree.
"""

from __future__ import annotations

def q(s: str | None) -> str:
    """A SQL string literal (``NULL`` for None)."""
    if s is None:
        return "NULL"
    out = []
    for ch in s:
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif ord(ch) < 0x20 or ord(ch) == 0x7F:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def ident(name: str) -> str:
    """A quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def field(struct_sql: str, name: str) -> str:
    return f"{struct_sql}.{ident(name)}"


def isin(x: str, values) -> str:
    return f"({x} IN ({', '.join(q(v) for v in values)}))" if values else "false"
