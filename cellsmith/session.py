"""Session helpers: a local session for tests/bench, and tables in the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cellsmith", shared: str | None = None) -> SparkSession:
    """A session on this machine; ``shared`` names the folder for tables between steps."""
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config(map={"spark.checkpoint.dir": shared} if shared else {})
             .config("spark.driver.memory", os.environ.get("CELLSMITH_DRIVER_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``
    as the cluster names it, or where that is unset a folder of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def work_path(spark: SparkSession, label: str) -> str:
    """A path of the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/cellsmith-{uuid.uuid4().hex}/{label}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table of the shared folder and read it back.

    Later steps start from these files: a lost executor repeats only the steps
    after them, and what reads the table twice does not compute it twice.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
