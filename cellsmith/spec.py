"""Cleaning spec: which pages, which fields, which types.

A spec is a small driver-side JSON document (a list of source tables, each
with an output table and an ordered map of page models). It is compiled to
Spark ``Column`` expressions by :mod:`cellsmith.plans.job`; it never becomes
a data-plane table.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from cellsmith import fixed

SCALAR_TYPES = ("String", "int", "long", "float", "double", "boolean")
COLUMN_TYPES = SCALAR_TYPES + ("Array",)
SUBFIELD_TYPES = ("String", "int", "float", "double", "boolean")


class SpecError(ValueError):
    """A spec the cleaner cannot run (unknown type, no row key, ...)."""


@dataclass(frozen=True)
class SubField:
    source: str
    name: str
    type: str


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    name: str
    type: str
    # History cells are written when the column has the key ``isMulti``,
    # whatever its value (list mode only; detail mode always writes history).
    is_multi: bool = False
    sub_columns: tuple[SubField, ...] = ()


@dataclass(frozen=True)
class ModelSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    data_path: str | None = None
    rowkey_columns: tuple[str, ...] | None = None
    rowkey_regex: str | None = None
    record_time: bool = False

    @property
    def is_list(self) -> bool:
        return self.data_path is not None

    @property
    def uses_regex_key(self) -> bool:
        # Detail pages ignore ``rowKeyRegex``.
        return self.is_list and self.rowkey_regex is not None

    def field_keys(self) -> list[str]:
        """Every top-level record key the model reads, in first-use order."""
        keys: list[str] = []
        if not self.uses_regex_key:
            keys.extend(self.rowkey_columns or ())
        keys.extend(c.source for c in self.columns)
        return list(dict.fromkeys(keys))


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    output_table: str
    models: tuple[ModelSpec, ...]


@dataclass(frozen=True)
class Vocab:
    true_words: tuple[str, ...] = field(default_factory=lambda: _texts(fixed.TRUE_WORDS))
    false_words: tuple[str, ...] = field(default_factory=lambda: _texts(fixed.FALSE_WORDS))
    special_bool_keys: tuple[str, ...] = field(
        default_factory=lambda: _texts(fixed.SPECIAL_BOOL_KEYS))
    array_keys: tuple[str, ...] = field(default_factory=lambda: _texts(fixed.ARRAY_KEYS))


def _texts(words: list[Any]) -> tuple[str, ...]:
    # A non-text entry (the number 0 among the false words) can never equal
    # a field's text, so it takes no part in matching.
    return tuple(w for w in words if isinstance(w, str))


def _load_json(path_or_obj: Any) -> Any:
    if isinstance(path_or_obj, (str, Path)):
        return json.loads(Path(path_or_obj).read_text(encoding="utf-8"))
    return path_or_obj


def parse_column(source: str, info: dict[str, Any]) -> ColumnSpec:
    ctype = info.get("type")
    if ctype not in COLUMN_TYPES:
        raise SpecError(f"column {source!r}: unknown type {ctype!r}")
    subs = tuple(parse_subfields(info.get("subColumns") or {}).values())
    return ColumnSpec(source=source, name=str(info["name"]), type=ctype,
                      is_multi="isMulti" in info, sub_columns=subs)


def parse_subfields(obj: dict[str, Any]) -> dict[str, SubField]:
    out = {}
    for key, info in obj.items():
        if isinstance(info, (tuple, list)):
            name, stype = info
        else:
            name, stype = info["name"], info["type"]
        if stype not in SUBFIELD_TYPES:
            raise SpecError(f"sub-field {key!r}: unsupported type {stype!r}")
        out[key] = SubField(source=key, name=str(name), type=stype)
    return out


def parse_model(name: str, obj: dict[str, Any]) -> ModelSpec:
    if "hasRecordTime" in obj and "recordTime" not in obj:
        warnings.warn(f"model {name!r}: 'hasRecordTime' is ignored; the download-time "
                      "cell of list pages is enabled by the key 'recordTime'", stacklevel=2)
    columns = tuple(parse_column(k, v) for k, v in obj["columns"].items())
    data_path = obj.get("dataPath")
    rk_cols = obj.get("rowkeyColumns")
    model = ModelSpec(
        name=name,
        columns=columns,
        data_path=None if data_path is None else str(data_path),
        rowkey_columns=None if rk_cols is None else tuple(str(c) for c in rk_cols),
        rowkey_regex=obj.get("rowKeyRegex"),
        record_time="recordTime" in obj,
    )
    if not model.uses_regex_key and not model.rowkey_columns:
        raise SpecError(f"model {name!r}: needs 'rowkeyColumns' (or 'rowKeyRegex' on list pages)")
    return model


def parse_spec(obj: Any) -> list[TableSpec]:
    obj = _load_json(obj)
    tables = []
    for t in obj:
        models = tuple(parse_model(k, v) for k, v in t["models"].items())
        tables.append(TableSpec(table_name=str(t["tableName"]),
                                output_table=str(t["outputTable"]), models=models))
    return tables


load_spec = parse_spec


def load_vocab(path_or_obj: Any = None) -> Vocab:
    if path_or_obj is None:
        return Vocab()
    obj = _load_json(path_or_obj)
    return Vocab(true_words=_texts(obj.get("trueWords", [])),
                 false_words=_texts(obj.get("falseWords", [])),
                 special_bool_keys=_texts(obj.get("specialBoolKeys", [])),
                 array_keys=_texts(obj.get("arrayKeys", [])))


def load_subfields(path_or_obj: Any) -> dict[str, SubField]:
    return parse_subfields(_load_json(path_or_obj))
