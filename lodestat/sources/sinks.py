"""Writers."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def show_table(df: DataFrame, order: list[Column | str], n: int = 20) -> DataFrame:
    """The first ``n`` rows under a total order: what a display needs, and all the driver gets."""
    return df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order]).limit(n)
