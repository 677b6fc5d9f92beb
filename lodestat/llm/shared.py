"""Tables and folders that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lodestat.session import ensure_checkpoint_dir

TEXT_ROWS = 1_000  # whole texts that a task hands to Python at once
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new name below the folder in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def at_most(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run in here hand Python no more than ``rows`` rows at once; then the session has its own setting again.

    A batch is held several times, as Arrow vectors and stream on the JVM side and in the worker, for each running task.
    """
    own = spark.conf.get(ARROW_ROWS)
    if 0 < int(own) <= rows:
        yield
        return
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, own)


def written(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """``df`` as a compressed table in the shared folder: it is computed once, whatever executors get lost later.

    ``texts``: Python tasks of ``df`` get whole texts, so few rows at once."""
    folder = new_folder(df.sparkSession, name)
    if texts:
        with at_most(df.sparkSession, TEXT_ROWS):
            df.write.option("compression", "zstd").parquet(folder)
    else:
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
