"""Sources: raw page tables, cell tables and one column's history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = ("source_key STRING, page_model STRING, data STRING, propertys STRING, "
               "download_time BIGINT, request_url STRING")
PAGE_COLUMNS = ["source_key", "page_model", "data", "propertys", "download_time", "request_url"]

#: Stored columns of a cell but those that are folders: names that look like numbers stay texts.
CELL_SCHEMA = ("row_key STRING, qualifier STRING, vtype STRING, v_string STRING, v_int INT, v_long BIGINT, "
               "v_float FLOAT, v_double DOUBLE, v_bool BOOLEAN, download_time BIGINT, source_key STRING, "
               "item_pos INT, put_seq INT, source_no INT")


def read_pages(spark: SparkSession, path_or_df, fmt: str = "parquet") -> DataFrame:
    """Raw pages with the fixed six-column projection (pruned at the scan)."""
    if isinstance(path_or_df, DataFrame):
        df = path_or_df
    elif fmt == "json":
        df = spark.read.schema(PAGE_SCHEMA).json(path_or_df)
    else:
        df = spark.read.format(fmt).load(path_or_df)
    have = set(df.columns)
    cols = []
    for name, typ in (c.split(" ") for c in PAGE_SCHEMA.split(", ")):
        col = F.col(name) if name in have else F.lit(None)
        cols.append(col.cast(typ.lower()).alias(name))
    return df.select(*cols)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """A cell table written by :func:`cellsmith.sources.sinks.write_cells`."""
    return spark.read.schema(f"{CELL_SCHEMA}, family STRING, period STRING").parquet(path).drop("period")


def read_history(cells: DataFrame, column: str) -> DataFrame:
    """Every (row, day, text) of one history family; ``family`` is the
    partition column of written cell tables, so this prunes to one folder."""
    return cells.where(F.col("family") == column).select(
        "row_key", F.col("qualifier").alias("day"), F.col("v_string").alias("text"))
