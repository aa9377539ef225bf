"""Array and ``key:value`` token-text functions (SQL higher-order functions)."""

from __future__ import annotations

import re

from cellsmith import fixed
from cellsmith.functions.coerce import SURE
from cellsmith.functions.jsontext import parse_text_map, unmark
from cellsmith.functions.sqltext import ident, q


def join_spaced(arr: str) -> str:
    """Parsed text array -> every element's text followed by one space (the
    last too); empty text for an empty array."""
    return (f"(CASE WHEN size({arr}) > 0 THEN "
            f"concat(array_join(transform({arr}, e -> {unmark('e')}), ' '), ' ') ELSE '' END)")


def join_field(arr: str, key: str, sep: str = "/") -> str:
    """Parsed object array -> ``key`` of each joined by ``sep``; missing -> ``null``."""
    return f"array_join(transform({arr}, e -> coalesce({unmark('e.' + ident(key))}, 'null')), {q(sep)})"


def distinct_sorted(arr: str) -> str:
    """The array's distinct elements, ascending, NULL last."""
    return f"array_sort(array_distinct({arr}))"


def array_reason(arr: str) -> str:
    """Why a parsed array cannot be stored (NULL when it can)."""
    return (f"(CASE WHEN {arr} IS NULL THEN 'bad_array' "
            f"WHEN exists({arr}, e -> e IS NULL) THEN 'null_array_element' END)")


def map_tokens(text: str, body, skip_commas: bool = False) -> str:
    """``transform`` over the two-space tokens of ``text``: ``body(k, v)`` (SQL over the
    token's key and value) for a valid ``key:value`` token, NULL else.

    A token splits into exactly two parts at ":" once trailing colons are dropped: any key
    (may be empty), a non-empty value. Each is split once, and its parts bound to a lambda.
    """
    parts = "split(TRIM(TRAILING ':' FROM t), ':')"
    if skip_commas:
        parts = f"CASE WHEN NOT contains(t, ',') THEN {parts} END"
    return (f"transform(transform(split({text}, {q(fixed.TOKEN_SEPARATOR)}), t -> {parts}), "
            f"p -> CASE WHEN size(p) = 2 THEN {body('get(p, 0)', 'get(p, 1)')} END)")


def token_map(text: str) -> str:
    """The tokens of ``text`` as a map in one parse; NULL where a token is not one key, a colon and one value
    (an empty one stands for the invalid token of a key alone). Runs of four spaces hold an empty token, which is none.
    Take it as the tokens only if no key is there twice."""
    sep = fixed.TOKEN_SEPARATOR
    one = f"replace({text}, {q(2 * sep)}, {q(sep)})"
    json = f"""concat('{{"', replace(replace({one}, ':', '":"'), {q(sep)}, '","'), '"}}')"""
    return f"CASE WHEN NOT contains({text}, '\"') AND NOT contains({text}, {q(chr(92))}) THEN {parse_text_map(json)} END"


def sure_tokens(text: str, types: dict[str, str]) -> str:
    """Whether one match tells that no token of ``text`` fails as its key's type (``types``: type by key).

    It looks at every place where a token of such a key may begin, and there for a text that parses
    whatever its digits, or none. False says nothing: the tokens are then to be parsed one by one.
    """
    sep = fixed.TOKEN_SEPARATOR
    end = rf"(?:{sep}|\z)"
    keys: dict[str, list[str]] = {}
    for key, stype in types.items():
        if stype in SURE:
            keys.setdefault(SURE[stype], []).append(re.escape(key))
    if not keys:
        return f"({text} IS NOT NULL)"
    unsure = "|".join(rf"(?:{'|'.join(names)}):(?!(?:{good})?{end})" for good, names in keys.items())
    return f"(NOT concat({q(sep)}, {text}) RLIKE {q(f'{sep}(?:{unsure})')})"
