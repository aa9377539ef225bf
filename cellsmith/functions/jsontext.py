"""JSON field access that keeps every number's own text.

Spark's JSON readers re-print numbers (``10000000.0`` becomes ``1.0E7``), which
would change what text-based coercion sees. So before parsing, every bare JSON
number is wrapped as a string between two marks, U+0002 and U+0004: ``1.50``
becomes ``"\u00021.50\u0004"``. Parsing then yields the exact source text,
and :func:`unmark` strips the marks again (for a nested object or array it puts
the number back unquoted). All of it is built-in SQL, JVM-side.

Functions here build SQL expression text; ``*_col`` variants return Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellsmith.functions.sqltext import ident, q

NUM_MARK = "\u0002"      # opens a number's text inside its added quotes
NUM_END = "\u0004"       # closes it
_OPEN = "\u0001"
_CLOSE = "\u0003"
# Bare numbers and string literals in either kind of quotes. Strings are consumed whole so
# digits inside them are never touched.
_NUMBER = r"-?[0-9]++(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|' + r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
# ``1-2``, ``1.2.3`` and ``1e+`` are no numbers, nor is a part of them.
_BARE = f"(?<![0-9.eE+\\-]){_NUMBER}(?![0-9.eE+\\-])"
# All up to the next bare number (group 1) and the number (group 2): one match a number. ``\\G`` keeps a
# search from starting anew within the rest behind the last number.
_TO_NUMBER = rf"""\G((?:{_STRING}|[^"'0-9\-]++|(?!{_BARE})[\s\S])*+)({_NUMBER})"""
_NO_BRACKET = "(?s)" + _STRING + r"""|[^\[\]{}"']++"""


def _nested(depth: int) -> str:
    """Regex of a text whose brackets are paired, at most ``depth`` deep."""
    inner = "" if depth == 0 else rf"|\[{_nested(depth - 1)}\]|\{{{_nested(depth - 1)}\}}"
    return rf"""(?:{_STRING}|[^\[\]{{}}"']++{inner})*+"""


_PAIRED = rf"(?s)\A{_nested(4)}\z"
# Inside nested JSON text the parser re-escapes the marks as six characters
# each (backslash-u-0002 / backslash-u-0004); text that was not parsed has them
# raw. Either way only a whole marked number is restored. The source's own control
# characters U+0001 to U+0004 are written as escapes before numbers are marked.
ESC_OPEN = '"\\u0002'
_MARKED = '"\\\\u0002(' + _NUMBER + ')\\\\u0004"'
_MARKED_RAW = '"(?:\\\\u0002|' + NUM_MARK + ")(" + _NUMBER + ")(?:\\\\u0004|" + NUM_END + ')"'
_MARKED_NUMBER = "^" + NUM_MARK + _NUMBER + NUM_END + r"\z"

# Integers are rendered as they stand, but for ``-0``, leading zeros and such as the parser finds too long.
_INEXACT = r"[0-9][.eE]|-0|(?<![0-9])0[0-9]|[0-9]{300}"

CORRUPT = "_corrupt"
_OPTS = "map('allowUnquotedControlChars', 'true')"
_RECORD_OPTS = ("map('allowUnquotedControlChars', 'true', 'mode', 'PERMISSIVE', "
                f"'columnNameOfCorruptRecord', {q(CORRUPT)})")


def mark_numbers(x: str) -> str:
    """Quote every bare number of a JSON text between the number marks."""
    own = x
    for c in (_OPEN, NUM_MARK, _CLOSE, NUM_END):  # the text's own ones, as escapes
        own = f"replace({own}, {q(c)}, {q(f'{chr(92)}u{ord(c):04x}')})"
    has = " OR ".join(f"contains({x}, {q(c)})" for c in (_OPEN, NUM_MARK, _CLOSE, NUM_END))
    x = f"CASE WHEN {has} THEN {own} ELSE {x} END"
    return f"regexp_replace({x}, {q(_TO_NUMBER)}, {q('$1' + chr(34) + NUM_MARK + '$2' + NUM_END + chr(34))})"


def unmark(x: str, parsed: bool = True) -> str:
    """Field text as the source had it: number text without its marks. ``parsed`` False: of a
    marked text that no parser has read."""
    if not parsed:
        return (f"(CASE WHEN contains({x}, {q(NUM_MARK)}) OR contains({x}, {q(ESC_OPEN)}) "
                f"THEN regexp_replace({x}, {q(_MARKED_RAW)}, '$1') ELSE {x} END)")
    return (f"(CASE WHEN startswith({x}, {q(NUM_MARK)}) AND {x} RLIKE {q(_MARKED_NUMBER)} "
            f"THEN substring({x}, 2, length({x}) - 2) "
            f"WHEN contains({x}, {q(ESC_OPEN)}) "
            f"THEN regexp_replace({x}, {q(_MARKED)}, '$1') ELSE {x} END)")


def closed(marked: str) -> str:
    """Whether every closing bracket of the text closes one that the text opened. A text that closes
    others could end the array that :func:`_parse_alone` puts around it, and go on beyond it.

    Texts with pairs at most four deep, the common case, are told by one match. Of others strings and all
    that is no bracket go first, then the innermost pairs, three times; what is left is counted bracket
    by bracket.
    """
    s = f"regexp_replace({marked}, {q(_NO_BRACKET)}, '')"
    for _ in range(3):
        s = f"regexp_replace({s}, {q(r'\[\]|\{\}')}, '')"
    fold = ("aggregate(split(s, ''), 0, (a, c) -> CASE WHEN a < 0 THEN a WHEN c IN ('[', '{') THEN a + 1 "
            "WHEN c IN (']', '}') THEN a - 1 ELSE a END) = 0")
    return f"({marked} RLIKE {q(_PAIRED)} OR NOT contains({marked}, ']') OR transform(array({s}), s -> s = '' OR {fold})[0])"


def flat(marked: str) -> str:
    """Whether the text begins with ``{`` and its last character is its only ``}``. Where such a text parses,
    its object ends with it, so that :func:`closed` need not be asked."""
    return f"(startswith({marked}, '{{') AND instr({marked}, '}}') = length({marked}))"


def _parse_alone(marked: str, fields: str) -> str:
    """Parse ``marked`` as the only element of an array, so that an empty text,
    a second value and text after the object do not pass for a document."""
    ddl = f"struct<d: array<struct<{fields}>>, {CORRUPT}: string>"
    text = f"concat({q('{' + chr(34) + 'd' + chr(34) + ':[')}, {marked}, ']}}')"
    return f"from_json({text}, {q(ddl)}, {_RECORD_OPTS})"


def field_names(keys: list[str]) -> list[str]:
    """Names of a record's fields: the keys, or ``f0``, ``f1``, ... where some
    differ by case only."""
    if len({k.lower() for k in keys}) == len(keys):
        return list(keys)
    return [f"f{i}" for i in range(len(keys))]


def sole(doc: str) -> str:
    """The object that :func:`parse_record` or :func:`parse_items` found; NULL
    unless the text was well-formed and exactly one object. ``doc`` is a column."""
    return f"(CASE WHEN {doc}.{CORRUPT} IS NULL AND size({doc}.d) = 1 THEN get({doc}.d, 0) END)"


def parse_record(marked: str, keys: list[str]) -> str:
    """A marked JSON object's wanted keys as text fields, named :func:`field_names`.

    A repeated key keeps its last value. Take the object out with :func:`sole`.
    """
    parsed = _parse_alone(marked, ", ".join(f"{ident(k)}: string" for k in keys))
    names = field_names(keys)
    if names == list(keys):
        return parsed
    fields = ", ".join(f"{n}: string" for n in names)
    return f"CAST({parsed} AS struct<d: array<struct<{fields}>>, {CORRUPT}: string>)"


def parse_items(marked: str, data_path: str) -> str:
    """The page object's item array ``data_path`` as an array of item texts.
    Take the object out with :func:`sole`."""
    return _parse_alone(marked, f"{ident(data_path)}: array<string>")


def parse_whole(text: str) -> str:
    """Any JSON value rendered as the parser renders it: see :func:`same_text`."""
    text = f"concat({q('{' + chr(34) + 'd' + chr(34) + ':[')}, {text}, ']}}')"
    return f"from_json({text}, 'struct<d: array<string>>', {_OPTS})"


def same_text(whole: str, text: str) -> str:
    """Whether ``text`` is one object or array that is rendered (``whole``, a column of :func:`parse_whole`)
    as it stands. Then every number in it is rendered as its own text, and need not be marked; and none
    of its brackets closes one that it did not open. A text of single quotes, blanks between its values, ``1.10`` or
    ``1E3`` is not, and neither is one that another value follows."""
    return f"coalesce(get({whole}.d, 0) = {text}, false)"


def parse_text_map(marked: str) -> str:
    """A flat JSON object as map<string,string>; NULL when malformed."""
    return f"from_json({marked}, 'map<string,string>', {_OPTS})"


def mark_inexact(x: str) -> str:
    """:func:`mark_numbers` where some number may be rendered as another text; else ``x``."""
    return f"CASE WHEN {x} RLIKE {q(_INEXACT)} THEN {mark_numbers(x)} ELSE {x} END"


def _lone_string(text: str) -> str:
    """Whether the text is an array of one string without escapes."""
    return (f"(startswith({text}, '[\"') AND endswith({text}, '\"]') AND NOT contains({text}, {q(chr(92))}) "
            f"AND octet_length(substring_index({text}, '\"', 2)) = octet_length({text}) - 2)")


def parse_text_array(marked: str) -> str:
    """A JSON array as array<string> (elements as text); NULL when not an array."""
    return (f"(CASE WHEN {_lone_string(marked)} THEN array(substring(substring_index({marked}, '\"', 2), 3)) "
            f"WHEN startswith(ltrim({marked}), '[') "
            f"THEN from_json({marked}, 'array<string>', {_OPTS}) END)")


def parse_object_array(marked: str, key: str) -> str:
    """A JSON array of objects as array<struct<key:string>>; NULL otherwise."""
    ddl = f"array<struct<{ident(key)}: string>>"
    return (f"(CASE WHEN startswith(ltrim({marked}), '[') "
            f"THEN from_json({marked}, {q(ddl)}, {_OPTS}) END)")


def mark_numbers_col(c: str) -> Column:
    return F.expr(mark_numbers(ident(c)))


def unmark_col(c: str) -> Column:
    return F.expr(unmark(ident(c)))
