"""Structured Streaming: clean pages as they arrive.

The cleaning is stateless per page (parse, explode, type, melt), so a stream of
raw pages is cleaned micro-batch by micro-batch with the very same plan as a
batch job. Each micro-batch appends its cells (and rejects) under
``batch_id=<n>`` folders; re-running a batch after a failure overwrites only
its own folder, so the sink is exactly-once with the checkpoint's batch ids.

The cell log is merge-on-read: :func:`read_latest` / :func:`compact` apply the
last-write-wins merge over all batches. No unbounded streaming state is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellsmith.operators.cells import cells_from_items, clean, rejects_from_items
from cellsmith.operators.merge import latest, merge_cells
from cellsmith.sources.pages import CELL_SCHEMA, PAGE_SCHEMA, read_cells
from cellsmith.sources.sinks import write_cells
from cellsmith.spec import ModelSpec, Vocab


def read_page_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw pages from files landing under ``path``."""
    r = spark.readStream.format(fmt).schema(PAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def start_clean_stream(pages: DataFrame, models: list[ModelSpec], cells_path: str,
                       rejects_path: str, checkpoint_location: str,
                       vocab: Vocab | None = None, zone: str | None = None,
                       available_now: bool = False,
                       processing_time: str | None = None) -> StreamingQuery:
    """Start the cleaning stream; returns the running query."""
    models = list(models)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # cells and rejects are written from one persisted item frame, so the
        # batch is parsed once; a retried batch overwrites its own folders.
        items = clean(batch, models, vocab=vocab, zone=zone).items.persist()
        try:
            write_cells(cells_from_items(items), f"{cells_path}/batch_id={batch_id}",
                        mode="overwrite")
            (rejects_from_items(items).write.mode("overwrite")
             .parquet(f"{rejects_path}/batch_id={batch_id}"))
        finally:
            items.unpersist()

    w = pages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_cell_log(spark: SparkSession, cells_path: str) -> DataFrame:
    schema = f"{CELL_SCHEMA}, batch_id BIGINT, family STRING, period STRING"
    return spark.read.schema(schema).parquet(cells_path).drop("batch_id", "period")


def read_latest(spark: SparkSession, cells_path: str) -> DataFrame:
    """Latest cells over every batch written so far (merge on read)."""
    return latest(read_cell_log(spark, cells_path))


def compact(spark: SparkSession, cells_path: str, out_path: str) -> DataFrame:
    """Merge the whole cell log into one snapshot at a new path."""
    write_cells(merge_cells(read_cell_log(spark, cells_path)), out_path)
    return read_cells(spark, out_path)
