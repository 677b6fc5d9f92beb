"""Readers and the shaping steps that belong to reading."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions import text as tx
from lodestat.roles import Roles
from lodestat.session import spread


def read_dataset(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    """One parquet table of a folder, spread over the cores only if the files give too few splits."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df, spread_by) if spread_by else df


def read_lines(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """One row per text line of a file or of every file in a folder."""
    lines = spark.read.text(path)
    return lines.withColumn("file", F.input_file_name()) if with_file else lines


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True
) -> DataFrame:
    """Delimited file with a declared schema (no inference pass over the data)."""
    return spark.read.csv(
        path, schema=schema, sep=sep, header=header, quote='"', escape='"', encoding="UTF-8"
    )


@dataclass(frozen=True)
class RoleTable:
    df: DataFrame
    roles: Roles


def read_role_table(
    spark: SparkSession, path: str, schema: T.StructType | str, roles: Roles, sep: str = ","
) -> RoleTable:
    """Delimited file whose columns carry roles; columns without a role are not read."""
    return RoleTable(read_table(spark, path, schema, sep).select(*roles.columns()), roles)


def parse_doc_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``<doc id="..." url=...>text`` lines to (doc_id, text); lines without the marks are dropped."""
    line = F.col(column)
    return (
        lines.filter(line.contains("id"))
        .select(
            tx.between(line, 'id="', '" url=').alias("doc_id"),
            tx.after(line, '">').alias("text"),
        )
        .filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    )


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema=schema)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths and sizes of binary files; the content column is never read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    )


def vectors_of_length(df: DataFrame, column: str, length: int) -> DataFrame:
    """Keep rows whose vector exists and has exactly ``length`` elements."""
    return df.filter(F.col(column).isNotNull() & (F.size(column) == length))


def json_field(df: DataFrame, column: str, path: str, name: str) -> DataFrame:
    """Add one field of a JSON text column; rows where it is missing or empty are dropped."""
    out = df.withColumn(name, F.get_json_object(F.col(column), path))
    return out.filter(F.col(name).isNotNull() & (F.col(name) != ""))
