"""Spec-driven jobs: every (source table x model), fanned in per output table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellsmith.operators.backfill import backfill
from cellsmith.operators.cells import CleanResult, Wanted, cells_from_items, clean, rejects_from_items
from cellsmith.operators.merge import CELL_KEY, merge_cells, tasks_for, upsert_cells
from cellsmith.session import cut
from cellsmith.sources.pages import CELL_SCHEMA, read_history
from cellsmith.sources.sinks import MONTH, write_cells
from cellsmith.sources.store import KEY, CellStore, file_tasks
from cellsmith.spec import ModelSpec, SubField, TableSpec, Vocab


def _by_source(spec: list[TableSpec]) -> dict[str, list[tuple[ModelSpec, str, int]]]:
    """Every source table with its (model, output table, place in the spec), in spec order."""
    out: dict[str, list[tuple[ModelSpec, str, int]]] = {}
    pairs = [(t.table_name, m, t.output_table) for t in spec for m in t.models]
    for place, (source, m, output) in enumerate(pairs):
        out.setdefault(source, []).append((m, output, place))
    return out


def run_spec(pages_by_table: dict[str, DataFrame], spec: list[TableSpec],
             vocab: Vocab | None = None, zone: str | None = None, on_error: str = "reject",
             wanted: Wanted = Wanted()) -> dict[str, CleanResult]:
    """Lazy cleaning results per output table.

    Each source table is cleaned once with all of its models; an output table
    fed by several sources is the union of their parts. (Writing the outputs:
    :func:`run_job`.)
    """
    parts: dict[str, list[CleanResult]] = {}
    for source, pairs in _by_source(spec).items():
        res = clean(pages_by_table[source], [m for m, _, _ in pairs], vocab=vocab, zone=zone,
                    on_error=on_error, wanted=wanted, ordinals=[n for _, _, n in pairs])
        outputs = list(dict.fromkeys(o for _, o, _ in pairs))
        for out in outputs:
            if len(outputs) == 1:
                parts.setdefault(out, []).append(res)
                continue
            items = res.items.where(F.col("model_index").isin([i for i, (_, o, _) in enumerate(pairs) if o == out]))
            parts.setdefault(out, []).append(CleanResult(
                items=items, cells=cells_from_items(items), rejects=rejects_from_items(items)))
    return {out: _union(results) for out, results in parts.items()}


def run_job(spark: SparkSession, pages_by_table: dict[str, DataFrame], spec: list[TableSpec], out_root: str,
            existing_root: str | None = None, vocab: Vocab | None = None, zone: str | None = None,
            period: int = MONTH) -> None:
    """Clean all sources and upsert the cells into the output tables: the tables
    at ``existing_root`` with this run's cells over them become those at ``out_root``.

    Each source is scanned and cleaned once (the items are written to the shared
    folder, and cells and rejects both come from there). ``out_root`` is a new
    path, so a failed run leaves the old tables as they were. Layout:
    ``cells/output_table=<o>/family=<f>/period=<p>`` (:func:`read_output`) and
    ``rejects/output_table=<o>``, this run's.
    """
    if existing_root is not None and existing_root.rstrip("/") == out_root.rstrip("/"):
        raise ValueError("write the new tables to a new path, not the one being read")
    staged, n = _staged_items(pages_by_table, spec, vocab, zone)
    key = ["output_table", *CELL_KEY]
    cells = cells_from_items(staged, extra=("output_table",))
    if existing_root is None:
        tasks = tasks_for(spark, n)
        merged = merge_cells(cells, key, tasks=tasks)
    else:
        old = _stored(spark, existing_root)
        tasks = tasks_for(spark, n + old.count())
        merged = upsert_cells(old, cells, key, tasks)
    with file_tasks(spark):
        write_cells(merged, f"{out_root}/cells", by=["output_table"], period=period, files=tasks)
    rejects_from_items(staged, extra=("output_table",)).write.partitionBy("output_table") \
        .parquet(f"{out_root}/rejects")


@dataclass(frozen=True)
class ModelCount:
    """What one model of one source did: its pages (with an item or a reject), items, the cells it
    wrote and the items it rejected."""
    source: str
    model: str
    output_table: str
    pages: int
    items: int
    cells: int
    rejects: int


def _metrics(i: int) -> list[Column]:
    """Sums over the items of the model with index ``i``, taken while the items are written."""
    mine = F.col("model_index") == i
    first = F.coalesce(F.col("item_pos"), F.lit(0)) == 0  # a page's first item, or its reject
    n_cells = F.coalesce(F.size(F.filter("cells", lambda c: c.isNotNull())), F.lit(0))
    count = lambda when, what=F.lit(1): F.coalesce(F.sum(F.when(mine & when, what)), F.lit(0))
    return [count(first).alias(f"pages{i}"), count(F.col("item_pos").isNotNull()).alias(f"items{i}"),
            count(F.col("reject").isNull(), n_cells).alias(f"cells{i}"),
            count(F.col("reject").isNotNull()).alias(f"rejects{i}")]


def _staged_items(pages_by_table: dict[str, DataFrame], spec: list[TableSpec], vocab: Vocab | None,
                  zone: str | None, counts: list[ModelCount] | None = None) -> tuple[DataFrame, int]:
    """All sources' items with their output table, written to the shared folder, and the number of
    their cells (empty ones included). ``counts`` gets a row a model, counted in the same pass."""
    items, n = [], 0
    for source, pairs in _by_source(spec).items():
        res = clean(pages_by_table[source], [m for m, _, _ in pairs], vocab=vocab, zone=zone,
                    ordinals=[n for _, _, n in pairs]).items
        output = F.element_at(F.array(*[F.lit(o) for _, o, _ in pairs]), F.col("model_index") + 1)
        res = res.withColumn("output_table", output)
        seen = Observation()
        cells = F.sum(F.when(F.col("cells").isNotNull(), F.size("cells"))).alias("n")
        res = res.observe(seen, cells, *[m for i in range(len(pairs)) if counts is not None for m in _metrics(i)])
        items.append(cut(res, "items"))
        got = seen.get
        n += got["n"] or 0
        if counts is not None:
            counts.extend(ModelCount(source, m.name, o, *(got[f"{c}{i}"] for c in ("pages", "items", "cells", "rejects")))
                          for i, (m, o, _) in enumerate(pairs))
    return reduce(DataFrame.unionByName, items), n


def update_store(store: CellStore, pages_by_table: dict[str, DataFrame], spec: list[TableSpec],
                 vocab: Vocab | None = None, zone: str | None = None,
                 max_reject_share: float | None = None) -> list[ModelCount]:
    """Clean all sources and write the cells over those of ``store``; the rejects go to
    ``rejects/batch=<n>/output_table=<o>`` below its root.

    Each source is cleaned in one pass, which also counts what its models did. Where a
    model rejects more than ``max_reject_share`` of its items and pages, the job raises before
    anything is written.
    """
    counts: list[ModelCount] = []
    staged, n = _staged_items(pages_by_table, spec, vocab, zone, counts)
    if max_reject_share is not None:
        bad = [c for c in counts if c.rejects > max_reject_share * max(c.items, c.pages)]
        if bad:
            raise ValueError(f"too many rejects, nothing was written: {bad}")
    batch = store.upsert(cells_from_items(staged, extra=("output_table",)), tasks_for(store.spark, n))
    rejects_from_items(staged, extra=("output_table",)).withColumn("batch", F.lit(batch).cast("long")) \
        .write.mode("append").partitionBy("batch", "output_table").parquet(f"{store.root}/rejects")
    return counts


def backfill_store(store: CellStore, output_table: str, column: str, subfields: dict[str, SubField]) -> DataFrame:
    """Type the token texts of ``column`` that were written since the last backfill of it, and write the
    cells back; the rejects of this run. Only the folders of later updates are read.

    The mark moves on last, so a run that failed is done again, with the same result.
    """
    name, last = f"backfill {output_table} {column}", store.last_batch()
    new = store.changes(store.mark(name)).where((F.col("batch") <= last) & (F.col("output_table") == output_table)
                                                & (F.col("family") == column))
    texts = new.count()
    latest = merge_cells(new, KEY, ["batch"], tasks_for(store.spark, texts))
    res = backfill(read_history(latest, column), subfields)
    store.upsert(res.cells.withColumn("output_table", F.lit(output_table)), tasks_for(store.spark, texts * len(subfields)))
    store.set_mark(name, last)
    return res.rejects


def backfill_job(spark: SparkSession, existing_root: str, output_table: str, column: str,
                 subfields: dict[str, SubField], out_root: str, period: int = MONTH) -> None:
    """Type the token texts in the stored history of ``column`` and write the cells
    back into the same table: ``existing_root`` with them over it, at ``out_root``."""
    if existing_root.rstrip("/") == out_root.rstrip("/"):
        raise ValueError("write the new tables to a new path, not the one being read")
    stored = _stored(spark, existing_root)
    res = backfill(read_history(stored.where(F.col("output_table") == output_table), column), subfields)
    new = res.cells.withColumn("output_table", F.lit(output_table))
    key = ["output_table", *CELL_KEY]
    texts = stored.where((F.col("output_table") == output_table) & (F.col("family") == column)).count()
    tasks = tasks_for(spark, stored.count() + texts * len(subfields))
    with file_tasks(spark):
        write_cells(upsert_cells(stored, new, key, tasks), f"{out_root}/cells", by=["output_table"], period=period, files=tasks)
    res.rejects.withColumn("output_table", F.lit(output_table)).write.partitionBy("output_table") \
        .parquet(f"{out_root}/rejects")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    cells = spark.read.schema(f"{CELL_SCHEMA}, output_table STRING, family STRING, period STRING") \
        .option("basePath", f"{root}/cells").parquet(f"{root}/cells")
    return cells.drop("period")


def read_output(spark: SparkSession, root: str, output_table: str) -> DataFrame:
    """All cells of one output table; other tables' folders are not read."""
    return _stored(spark, root).where(F.col("output_table") == output_table).drop("output_table")


def _union(results: list[CleanResult]) -> CleanResult:
    if len(results) == 1:
        return results[0]
    return CleanResult(
        items=reduce(DataFrame.unionByName, [r.items for r in results]),
        cells=reduce(DataFrame.unionByName, [r.cells for r in results]),
        rejects=reduce(DataFrame.unionByName, [r.rejects for r in results]))
