"""Last-write-wins merge of cells, wide view, upsert and point lookup.

Every cell carries its write order ``(download_time, source_key, item_pos,
put_seq, source_no)``, the last of which is the place of its source table and model in
the spec, so no two cells of a run tie; the merged value of a ``(row_key, family, qualifier)`` is the one
with the greatest order, whatever the values. An upsert puts the batch ahead of
that order: what is written now overwrites what was there, as a later put does.
``max_by`` over structs aggregates partially on the map side, so a hot row key
reaches the exchange as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.functions.coerce import VALUE_FIELDS
from cellsmith.operators.cells import cells_from_items
from cellsmith.spec import ModelSpec

CELL_KEY = ["row_key", "family", "qualifier"]
ORDER = ["download_time", "source_key", "item_pos", "put_seq", "source_no"]
VALUES = [n for n, _ in VALUE_FIELDS]


#: Cells that one task merges or sorts, a few hundred MB of them.
TASK_CELLS = 500_000


def tasks_for(spark: SparkSession, cells: int) -> int | None:
    """Tasks of some :data:`TASK_CELLS` cells each; None where the session's make no larger ones: its
    shuffle partitions may be joined again to as many as it has cores."""
    n = -(-cells // TASK_CELLS)
    least = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return n if n > least else None


def merge_cells(cells: DataFrame, key: list[str] = CELL_KEY, before: list[str] = (), tasks: int | None = None) -> DataFrame:
    """One cell per ``key``: the last write. Columns ``before`` come ahead of the order.

    ``tasks`` (of :func:`tasks_for`): the cells are dealt to so many by row key and qualifier and merged there,
    so that a task's size does not grow with the table. (Dealt by a column that is one literal, as an output table or
    a family may be, they would be exchanged again, as Spark leaves literals out of the grouping.) Without, they are merged in the tasks that made
    them first, and the number of tasks after the exchange is the session's."""
    if tasks:
        cells = cells.repartition(tasks, *([k for k in key if k in ("row_key", "qualifier")] or key))
    last = F.max_by(F.struct(*VALUES, *ORDER), F.struct(*before, *ORDER)).alias("w")
    out = cells.groupBy(*key).agg(last)
    return out.select(*key, *[F.col("w")[c].alias(c) for c in VALUES + ORDER])


def merge_items(items: DataFrame, tasks: int | None = None) -> DataFrame:
    """The merged cells of cleaned items (of ``CleanResult.items``). ``tasks``: the items are dealt by row key and their
    cells made there, so that a shuffle holds an item once and not a row with its whole key and order for every cell of it."""
    if tasks:
        items = items.select("row_key", "download_time", "source_key", "item_pos", "source_no", "cells").repartition(tasks, "row_key")
    return merge_cells(cells_from_items(items))


def latest(cells: DataFrame) -> DataFrame:
    """Merged latest cells (family ``content``)."""
    return merge_cells(cells.where(F.col("family") == fixed.LATEST_FAMILY))


def history(cells: DataFrame) -> DataFrame:
    """Merged history cells: one value per column per day."""
    return merge_cells(cells.where(F.col("family") != fixed.LATEST_FAMILY))


def upsert_cells(existing: DataFrame, new: DataFrame, key: list[str] = CELL_KEY, tasks: int | None = None) -> DataFrame:
    """Existing merged cells overwritten by the cells written now, whatever their
    download times; other cells stay.

    Idempotent: upserting the same batch twice gives the same table.
    """
    cols = [*key, *VALUES, *ORDER]
    both = existing.select(*cols, F.lit(0).alias("batch")).unionByName(new.select(*cols, F.lit(1).alias("batch")))
    return merge_cells(both, key, ["batch"], tasks)


def cell_text(prefix: str = "") -> Column:
    """A cell value rendered as text, whatever its type."""
    p = (lambda n: F.col(prefix + n))
    return F.coalesce(p("v_string"), p("v_int").cast("string"), p("v_long").cast("string"),
                      p("v_float").cast("string"), p("v_double").cast("string"),
                      p("v_bool").cast("string"))


def latest_wide(cells: DataFrame, names: list[str]) -> DataFrame:
    """What a reader of each output row sees: one text column per latest name.

    Merges and pivots in a single aggregation keyed by ``row_key`` (one
    exchange); the name list is explicit so no extra job discovers it.
    """
    c = cells.where((F.col("family") == fixed.LATEST_FAMILY) & F.col("qualifier").isin(names))
    last = F.max_by(cell_text(), F.struct(*ORDER))
    wide = c.groupBy("row_key").pivot("qualifier", names).agg(last)
    return wide.select("row_key", *[F.col(f"`{n}`").alias(n) for n in names])


#: Value column of a spec type; arrays are stored as text.
SLOTS = {"String": "v_string", "int": "v_int", "long": "v_long", "float": "v_float", "double": "v_double",
         "boolean": "v_bool", "Array": "v_string"}


def latest_wide_typed(cells: DataFrame, types: dict[str, str]) -> DataFrame:
    """The wide view with every column in its spec type, and for types other than text a column
    ``<name>_text`` with the text that did not parse (then the typed one is NULL). One exchange; the
    whole cell is picked, so a value never stands beside an older one's text."""
    c = cells.where((F.col("family") == fixed.LATEST_FAMILY) & F.col("qualifier").isin(list(types)))
    last = F.max_by(F.struct(*VALUES), F.struct(*ORDER))
    wide = c.groupBy("row_key").pivot("qualifier", list(types)).agg(last)
    out = []
    for name, kind in types.items():
        cell = F.col(f"`{name}`")
        out.append(cell[SLOTS[kind]].alias(name))
        if SLOTS[kind] != "v_string":
            out.append(cell["v_string"].alias(f"{name}_text"))
    return wide.select("row_key", *out)


def wide_types(models: list[ModelSpec]) -> dict[str, str]:
    """Name and type of every latest column of ``models``; a name of two types is text."""
    types: dict[str, str] = {}
    for m in models:
        for c in m.columns:
            if c.type == "Array" and m.is_list:
                types |= {x.name: x.type for x in c.sub_columns}
            else:
                types[c.name] = c.type if types.get(c.name, c.type) == c.type else "String"
    return types


def lookup_history(cells: DataFrame, row_key: str, column: str) -> DataFrame:
    """Every day of one column of one row. On a stored table (see
    :mod:`cellsmith.sources.sinks`) the column is a folder and the row key a
    pushed filter over files that are ranges of row keys."""
    hit = cells.where((F.col("row_key") == row_key) & (F.col("family") == column))
    return merge_cells(hit)


def cell_values(df: DataFrame) -> DataFrame:
    """Comparable projection of (merged) cells: floats shown as doubles."""
    return df.select(*CELL_KEY, "vtype", "v_string", "v_int", "v_long",
                     F.col("v_float").cast("double").alias("v_float"), "v_double", "v_bool")
