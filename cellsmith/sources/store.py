"""A stored cell table that is updated where it stands.

Layout below ``root``:

* ``cells``: one Spark table, folders by output table, family and period, every folder
  in the same number of buckets by (row key, qualifier), sorted. A hot row is spread
  over buckets by its qualifiers.
* ``changes``: the cells of every update, folders by batch, output table and family.
* ``options``, ``marks``: the number of buckets and the period; how far each follower of
  the changes has read.

An update reads and rewrites only the folders that its cells touch, by dynamic
partition overwrite; all other files stay as they are. The stored side of the merge has no
exchange: it is read bucket by bucket, and the new cells alone are dealt to the buckets. Its
cost follows the new cells and the folders they touch, not the table. Spark writes the
folders to a staging place and moves them when the job has ended, so an update that fails
before leaves the table as it was. One that is killed while it moves folders may leave some
out; the changes hold every cell ever written, and :meth:`CellStore.rebuild` restores the
table from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith import fixed
from cellsmith.functions.sqltext import ident, q
from cellsmith.operators.merge import CELL_KEY, merge_cells, tasks_for
from cellsmith.session import cut
from cellsmith.sources.pages import CELL_SCHEMA
from cellsmith.sources.sinks import MONTH

FOLDERS = ["output_table", "family", "period"]
KEY = ["output_table", *CELL_KEY]
_COLUMNS = [c.split(" ")[0] for c in CELL_SCHEMA.split(", ")]


@contextmanager
def _configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def file_tasks(spark: SparkSession) -> Iterator[None]:
    """What runs within reads a file a task. Files written between steps hold what one task made, and Spark
    would join those up to 128 MB, which are many million cells, in a task that sorts them."""
    with _configured(spark, **{"spark.sql.files.maxPartitionBytes": spark.conf.get("spark.sql.files.openCostInBytes")}):
        yield


@dataclass(frozen=True)
class CellStore:
    """An opened store; see :func:`create_store` and :func:`open_store`."""
    spark: SparkSession
    root: str
    buckets: int
    period: int

    @property
    def table(self) -> str:
        return "cells_" + hashlib.md5(self.root.encode()).hexdigest()

    def cells(self, output_table: str | None = None) -> DataFrame:
        """The current cells; those of one output table read its folders alone."""
        cells = self.spark.table(self.table)
        if output_table is not None:
            cells = cells.where(F.col("output_table") == output_table).drop("output_table")
        return cells.drop("period")

    def changes(self, after: int = 0) -> DataFrame:
        """Cells of the updates with a number above ``after``; older folders are not read."""
        schema = f"{CELL_SCHEMA}, batch BIGINT, output_table STRING, family STRING"
        return self.spark.read.schema(schema).parquet(f"{self.root}/changes").where(F.col("batch") > after)

    def last_batch(self) -> int:
        return self.changes().agg(F.max("batch")).first()[0] or 0

    def mark(self, name: str) -> int:
        """The last batch that ``name`` has read, 0 before its first run."""
        marks = self.spark.read.schema("name STRING, batch BIGINT").parquet(f"{self.root}/marks")
        return marks.where(F.col("name") == name).agg(F.max("batch")).first()[0] or 0

    def set_mark(self, name: str, batch: int) -> None:
        self.spark.createDataFrame([(name, batch)], "name STRING, batch BIGINT").coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/marks")

    def _period(self) -> Column:
        return F.when(F.col("family") == fixed.LATEST_FAMILY, F.lit("latest")).otherwise(
            F.substring("qualifier", 1, self.period))

    def merged(self, new: DataFrame, folders: list[tuple[str, str, str]]) -> DataFrame:
        """The cells of ``folders`` with ``new`` (one cell a key) over them: one exchange, of ``new``."""
        at = [reduce(Column.__and__, [F.col(c) == v for c, v in zip(FOLDERS, f, strict=True)]) for f in folders]
        old = self.spark.table(self.table).where(reduce(Column.__or__, at))
        new = new.repartition(self.buckets, "row_key", "qualifier")
        rest = [c for c in _COLUMNS if c not in KEY]
        new = new.select(*KEY, "period", F.struct(*rest).alias("_new"))
        old = old.select(*KEY, "period", F.struct(*rest).alias("_old"))
        both = old.join(new, [*KEY, "period"], "full").withColumn("_cell", F.coalesce("_new", "_old"))
        return both.select(*[F.col("_cell")[c].alias(c) if c in rest else F.col(c) for c in _COLUMNS], *FOLDERS)

    def upsert(self, cells: DataFrame, tasks: int | None = None) -> int:
        """Write ``cells`` (with ``output_table``) over the stored ones, whatever their times, and
        log them; the number of the update. ``tasks`` as in :func:`cellsmith.operators.merge.merge_cells`."""
        with file_tasks(self.spark):
            return self._upsert(cells, tasks)

    def _upsert(self, cells: DataFrame, tasks: int | None) -> int:
        staged = cut(merge_cells(cells, KEY, tasks=tasks).withColumn("period", self._period()), "new")
        batch = self.last_batch() + 1
        staged.select(*_COLUMNS, F.lit(batch).cast("long").alias("batch"), "output_table", "family") \
            .write.mode("append").partitionBy("batch", "output_table", "family").parquet(f"{self.root}/changes")
        # a row a folder that the new cells touch
        folders = [tuple(r) for r in staged.select(*FOLDERS).distinct().collect()]
        if folders:
            with _configured(self.spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic",
                                            "spark.sql.requireAllClusterKeysForCoPartition": "false"}):
                self.merged(staged, folders).write.mode("overwrite").insertInto(self.table)
            self.spark.catalog.refreshTable(self.table)
        return batch

    def rebuild(self) -> None:
        """Write the whole table anew from the logged changes, the later update over the earlier."""
        changes = self.changes()
        cells = merge_cells(changes, KEY, ["batch"], tasks_for(self.spark, changes.count())).withColumn("period", self._period())
        cells = cells.repartition(self.buckets, "row_key", "qualifier").select(*_COLUMNS, *FOLDERS)
        with _configured(self.spark, **{"spark.sql.sources.partitionOverwriteMode": "static"}), file_tasks(self.spark):
            cells.write.mode("overwrite").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def lookup(self, output_table: str, keys: DataFrame, column: str) -> DataFrame:
        """Every day of one column for many rows at once: ``keys`` (row_key). The folders are pruned
        when the query is planned. The distinct keys are written first, so Spark knows their size: few
        are broadcast and filter the rows as they are read, many are joined by exchange."""
        hist = self.cells(output_table).where(F.col("family") == column)
        return hist.join(cut(keys.select("row_key").distinct(), "keys"), "row_key", "left_semi")


def create_store(spark: SparkSession, root: str, buckets: int = 64, period: int = MONTH) -> CellStore:
    """An empty store. ``buckets``: files of a folder, so that the largest folder's fill a few
    hundred MB each; ``period`` as in :func:`cellsmith.sources.sinks.write_cells`."""
    one = spark.createDataFrame([(buckets, period)], "buckets INT, period INT")
    one.coalesce(1).write.parquet(f"{root}/options")
    spark.createDataFrame([], f"{CELL_SCHEMA}, output_table STRING, family STRING, period STRING") \
        .write.partitionBy(*FOLDERS).parquet(f"{root}/cells")
    empty = spark.createDataFrame([], f"{CELL_SCHEMA}, batch BIGINT, output_table STRING, family STRING")
    empty.write.partitionBy("batch", "output_table", "family").parquet(f"{root}/changes")
    spark.createDataFrame([], "name STRING, batch BIGINT").write.parquet(f"{root}/marks")
    return open_store(spark, root)


def open_store(spark: SparkSession, root: str) -> CellStore:
    """The store at ``root``, its cells known to the session as a bucketed table."""
    row = spark.read.schema("buckets INT, period INT").parquet(f"{root}/options").first()
    store = CellStore(spark, root, row["buckets"], row["period"])
    # Parquet's bloom filters of row keys let a lookup leave out row groups between least and greatest key
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ident(store.table)} ({CELL_SCHEMA}, output_table STRING, family STRING, "
              f"period STRING) USING parquet OPTIONS ('parquet.bloom.filter.enabled#row_key' 'true') "
              f"PARTITIONED BY ({', '.join(FOLDERS)}) CLUSTERED BY (row_key, qualifier) "
              f"SORTED BY (row_key, qualifier) INTO {store.buckets} BUCKETS LOCATION {q(root + '/cells')}")
    spark.sql(f"MSCK REPAIR TABLE {ident(store.table)}")  # the folders that other sessions wrote
    return store
