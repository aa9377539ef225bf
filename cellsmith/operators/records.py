"""Record helpers re-aimed at DataFrames: ordered sort with a global rank,
distinct sorted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.session import cut


def sort_columns(field: str, mode: str | None, tie_breakers: list[str] = ()) -> list[Column]:
    """Order of one field: ascending for ``mode`` None or ``asc`` (any case),
    descending otherwise; NULLs last; ties broken by ``tie_breakers``."""
    asc = mode is None or mode.lower() == "asc"
    first = F.col(field).asc_nulls_last() if asc else F.col(field).desc_nulls_last()
    return [first] + [F.col(t).asc_nulls_last() for t in tie_breakers]


#: Columns of :func:`with_input_position`.
POSITION = ["_file", "_row"]


def with_input_position(scan: DataFrame) -> DataFrame:
    """``scan``, read straight from files, with each row's place in the input: file and row in it."""
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def stable_order(field: str, mode: str | None = "ASC") -> list[Column]:
    """Order of :func:`sort_columns` in which equal rows keep their places in the input. The places are part of
    the key that rows are range-partitioned by, so a run of equal values of any length is split."""
    return sort_columns(field, mode, POSITION)


def stable_sort(scan: DataFrame, field: str, mode: str | None = "ASC") -> DataFrame:
    """Globally sorted records of a file scan, equal ones in input order."""
    return with_input_position(scan).orderBy(*stable_order(field, mode)).drop(*POSITION)


def sort_by(df: DataFrame, field: str, mode: str | None = "ASC",
            tie_breakers: list[str] = ()) -> DataFrame:
    """Globally sorted records (range-partitioned sort, no single-task step)."""
    return df.orderBy(*sort_columns(field, mode, tie_breakers))


def with_global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Attach a 1-based global rank in ``order`` (a total order) at any scale.

    Range-partition and sort by ``order``; ``monotonically_increasing_id`` then
    holds the partition and the place in it. The numbered rows are written to
    the shared folder, so that both uses see the same partitions. The rows of
    all earlier partitions are added by a join with a table of a row a partition.
    """
    numbered = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_id", F.monotonically_increasing_id()), "numbered")
    pid = F.shiftrightunsigned("_id", 33).alias("_pid")
    counts = numbered.groupBy(pid).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_pid")) - F.col("n")
    offsets = counts.select("_pid", before.alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn("_pid", pid).join(offsets, "_pid").select(
        *df.columns, (F.col("_before") + place + 1).alias(rank_col))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, ascending, with their rank."""
    d = df.select(column).distinct()
    return with_global_rank(d, [F.col(column).asc_nulls_last()], "rank")
