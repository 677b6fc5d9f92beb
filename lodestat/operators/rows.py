"""Projection, row selection, global row positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.functions import arrays as ar
from lodestat.roles import Roles
from lodestat.session import BROADCAST_ROWS, broadcast_if_small, cut_lineage, fits


def select_range(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Columns by position."""
    return df.select(*df.columns[start:stop])


def with_roles(df: DataFrame, roles: Roles, vector: str | None = None) -> DataFrame:
    """Keep the columns that have a role; optionally assemble the features into one ML vector."""
    kept = df.select(*roles.columns())
    if vector is None:
        return kept
    return VectorAssembler(inputCols=list(roles.features), outputCol=vector).transform(kept)


def code_to_category(df: DataFrame, column: str, names: Sequence[str], name: str) -> DataFrame:
    """Integer part of a number to a name; codes outside the list give null."""
    return df.withColumn(name, F.get(F.array(*[F.lit(n) for n in names]), F.col(column).cast("int")))


def category_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Alphabetical integer codes. Only the distinct values are ranked, never the rows."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if fits(values, BROADCAST_ROWS):
        codes = F.broadcast(
            values.withColumn(name, (F.row_number().over(W.orderBy(column)) - 1).cast("bigint"))
        )
    else:
        codes = with_row_id(values, [column], name)
    return df.join(codes, column, "left")


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str, value: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(columns), key, value)


def concat_arrays(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    return df.withColumn(name, F.concat(a, b))


def split_array(df: DataFrame, column: str, at: int, head: str, tail: str) -> DataFrame:
    return df.withColumn(head, F.slice(column, 1, at)).withColumn(
        tail, F.slice(F.col(column), F.lit(at + 1), F.greatest(F.size(column) - at, F.lit(0)))
    )


def add_bias(df: DataFrame, name: str = "bias") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def split_where(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that match, and all the others (a null condition counts as no match)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.filter(condition), df.filter(~hit)


def filter_norm(df: DataFrame, column: str, radius: float) -> DataFrame:
    """Rows whose vector is longer than ``radius``."""
    return df.filter(ar.norm(ar.doubles(F.col(column))) > radius)


def with_row_id(df: DataFrame, order: Sequence[str | Column], name: str = "row_id") -> DataFrame:
    """Zero-based position of every row under a total order, without a one-task window.

    The rows are range-partitioned on all order columns (so one repeated value can still be cut by
    the columns behind it), sorted inside the partitions and written once; a row's position is its
    place in its partition plus the sizes of the partitions before it.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # one row per partition of the sort: small whatever the data size
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def rank_within(df: DataFrame, by: str, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Zero-based position inside each group, safe for a group that holds most of the rows.

    A group is a contiguous run of the global order (by, order), so its rows share out over as many
    tasks as the range partitioning gives, and the position is the distance to the group's first row.
    """
    placed = with_row_id(df, [by, *order], "_at")
    firsts = placed.groupBy(by).agg(F.min("_at").alias("_first"), F.count("*").alias(f"{name}_size"))
    return (
        placed.join(broadcast_if_small(firsts), by)
        .withColumn(name, F.col("_at") - F.col("_first"))
        .drop("_at", "_first")
    )


def slice_rows(
    df: DataFrame, order: Sequence[str | Column], start: int = 0, stop: int | None = None, step: int = 1
) -> DataFrame:
    """Rows start, start+step, ... below stop of the ordered table; negative bounds count from the end."""
    placed = with_row_id(df, order, "_row")
    size = df.agg(F.count("*")).scalar()
    low = F.lit(start) if start >= 0 else size + start
    keep = (F.col("_row") >= low) & (F.pmod(F.col("_row") - low, F.lit(step)) == 0)
    if stop is not None:
        keep = keep & (F.col("_row") < (F.lit(stop) if stop >= 0 else size + stop))
    return placed.filter(keep).drop("_row")
