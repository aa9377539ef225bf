"""Sinks: cell snapshots, one folder per column and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.operators.merge import merge_cells, upsert_cells
from cellsmith.sources.pages import read_cells


MONTH = 7


def write_cells(cells: DataFrame, path: str, mode: str = "errorifexists", by: list[str] = (),
                period: int = MONTH, files: int | None = None) -> None:
    """Write cells in folders of ``by``, ``family`` and ``period``: the first characters
    of a history cell's day (10: a folder a day, 7: a month, 4: a year; to be chosen so
    that a folder fills files), ``latest`` for the latest values. The rows are
    range-partitioned by folder and row key, so a file holds a range of row keys and
    a lookup skips the others by statistics. ``files``: so many ranges, whatever their size
    (by default small ones are joined)."""
    part = F.when(F.col("family") == fixed.LATEST_FAMILY, F.lit("latest")).otherwise(
        F.substring("qualifier", 1, period))
    order = [*by, "family", "period", "row_key"]
    ranges = (files, *order) if files else order
    (cells.withColumn("period", part).repartitionByRange(*ranges).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy(*by, "family", "period").parquet(path))


def upsert_snapshot(spark: SparkSession, existing_path: str | None, new_cells: DataFrame,
                    out_path: str) -> DataFrame:
    """Merge new cells into the snapshot at ``existing_path`` and write the
    result as a *new* snapshot at ``out_path`` (never the path being read)."""
    if existing_path is not None and existing_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("write the merged snapshot to a new path, not the one being read")
    if existing_path is None:
        merged = merge_cells(new_cells)
    else:
        merged = upsert_cells(read_cells(spark, existing_path), new_cells)
    write_cells(merged, out_path)
    return read_cells(spark, out_path)
