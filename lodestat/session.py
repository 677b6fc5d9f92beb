"""Session helpers: size checks before broadcasts, and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table that is ever broadcast, in rows (the rows are narrow: a key and a few numbers).
BROADCAST_ROWS = 500_000


def local_session(app: str = "lodestat", cores: str | int = "*") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("LODESTAT_SHUFFLE", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; make a scratch one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-checkpoint-")
    sc.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for a table that a loop joins round after round: written to the same folder and read as files.

    A checkpoint keeps the size that Spark guessed for its plan, and the guess for a join is the product of its sides. Fed back
    in a loop it gains digits exponentially, until the guess alone fills the driver. Files have the size they have.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops counting right after the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if its size is within the bound; leave the join to Catalyst otherwise."""
    return F.broadcast(df) if fits(df, max_rows) else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute a table read from too few file splits; a well-split table is left alone.

    The hash on ``key`` (not round robin) is stable under task retries, and later grouping by
    ``key`` reuses it. Large inputs have more splits than cores, so they are never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
