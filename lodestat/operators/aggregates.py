"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.session import cut_lineage


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def running_total(counts: DataFrame, by: str, value: str, name: str = "running") -> DataFrame:
    """Sum of ``value`` over the rows up to each one in the order of ``by``, whose values don't repeat; null comes first.

    The rows are dealt out by ranges of ``by`` and written once; a running sum inside each range starts at the total of the
    ranges before it. So no task holds all rows, however many distinct values there are.
    """
    ranged = cut_lineage(counts.repartitionByRange(by).withColumn("_part", F.spark_partition_id()))
    # one row per range: small whatever the data size
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_total"))
    starts = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_part").orderBy(by).rowsBetween(W.unboundedPreceding, 0)
    placed = ranged.join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_part", "_start")


def collect_values(df: DataFrame, key: str | Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted values per key. Meant for keys that are bounded by nature, such as one document."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))


def vector_sum(df: DataFrame, column: str) -> DataFrame:
    """Element-wise sum as (pos, total); rows are combined per task before the small shuffle."""
    return (
        df.select(F.posexplode(F.col(column)).alias("pos", "v"))
        .groupBy("pos")
        .agg(F.sum(F.col("v").cast("double")).alias("total"))
    )


def xty(df: DataFrame, column: str, target: Column) -> DataFrame:
    """Sum of target * x per position."""
    return (
        df.select(target.alias("_y"), F.posexplode(F.col(column)).alias("pos", "v"))
        .groupBy("pos")
        .agg(F.sum(F.col("_y") * F.col("v").cast("double")).alias("total"))
    )


def group_mean(df: DataFrame, by: str, column: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(column).alias("mean"))


def group_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Sum, mean and sample standard deviation per group."""
    return df.groupBy(by).agg(
        F.sum(column).alias("total"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")
    )


def score_stats(df: DataFrame, column: str) -> DataFrame:
    """Mean and population standard deviation of a score column."""
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def extent(df: DataFrame, *columns: str) -> DataFrame:
    out = [F.count("*").alias("n")]
    for c in columns:
        out += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*out)


def covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population covariance and correlation of every column pair, long form, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(
        *[F.covar_pop(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
        *[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"),
                F.col(f"c{i}").alias("cov"), F.col(f"r{i}").alias("corr"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(rows))


# --- count cubes -------------------------------------------------------------------------------


def marginal(df: DataFrame, keep: Sequence[str], value: str = "cnt") -> DataFrame:
    """Sum of a count cube over every axis that is not kept."""
    return df.groupBy(*keep).agg(F.sum(value).alias("total"))


def all_marginals(df: DataFrame, axes: Sequence[str], value: str = "cnt") -> DataFrame:
    """Every margin at once; ``level`` tells summed-out axes (bit set) from kept ones."""
    return df.cube(*axes).agg(F.sum(value).alias("total"), F.grouping_id().alias("level"))


def argmax_by(df: DataFrame, group: str, item: str, value: str = "cnt") -> DataFrame:
    """The item with the largest total per group, ties to the smaller item."""
    totals = df.groupBy(group, item).agg(F.sum(value).alias("total"))
    best = totals.groupBy(group).agg(F.min(F.struct((-F.col("total")).alias("neg"), item)).alias("b"))
    return best.select(group, F.col(f"b.{item}").alias(item), (-F.col("b.neg")).alias("total"))


def max_marginal(df: DataFrame, group: str, item: str, value: str = "cnt") -> DataFrame:
    """Per group, the count of its most frequent item."""
    totals = df.groupBy(group, item).agg(F.sum(value).alias("total"))
    return totals.groupBy(group).agg(F.max("total").alias("total"))


# --- histograms --------------------------------------------------------------------------------


def histogram(
    df: DataFrame, column: str, bins: int, by: str | None = None, density: bool = False, cumulative: bool = False
) -> DataFrame:
    """Equal-width bins over the whole range, last bin closed, empty bins kept.

    ``by`` counts each group over the same edges. ``density`` divides by (rows * width);
    ``cumulative`` adds the running count. At most bins * groups rows leave the aggregate.
    """
    x = F.col(column).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    width = (hi - lo) / bins
    keys = [by] if by else []
    placed = df.filter(x.isNotNull()).select(
        *keys,
        F.when(hi > lo, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(0).cast("bigint").alias("bin"),
    )
    counts = placed.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")).alias("bin")
    frame = (
        df.select(by).distinct().select(by, every)
        if by
        else df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    )
    out = frame.join(counts, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out = out.withColumn("edge", lo + F.col("bin") * width)
    within = W.partitionBy(*keys) if by else W.partitionBy(F.lit(0))
    if density:
        out = out.withColumn("density", F.col("n") / (F.sum("n").over(within) * width))
    if cumulative:
        running = within.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumn("running", F.sum("n").over(running))
    return out
