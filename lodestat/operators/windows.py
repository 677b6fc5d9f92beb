"""Ranking, lag and lead, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows under a total order: a bounded heap per task, then one merge."""
    return df.orderBy(*order).limit(k)


def top_k_per(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First k rows per group, ranked from 1. Spark prunes every task's rows to k per group before
    the shuffle, so a hot group reaches its task already cut down."""
    keys = [by] if isinstance(by, str) else list(by)
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def best(df: DataFrame, metric: str, mode: str = "min", tie: Sequence[str] = ()) -> DataFrame:
    order = F.col(metric).asc() if mode == "min" else F.col(metric).desc()
    return df.orderBy(order, *tie).limit(1)


def periodic_lag_lead(
    df: DataFrame, key: str, when: str, period: str, measures: dict[str, Column]
) -> DataFrame:
    """Roll a table up to one row per key and calendar period, then add the neighbours in time.

    Each measure m gets m_prev, m_next, m_pct_prev (change from the period before, percent) and
    m_pct_next (change to the period after). The roll-up runs first, so a key has at most one row
    per calendar period when the window sees it, however many raw rows it has.
    """
    rolled = df.groupBy(key, F.date_trunc(period, F.col(when)).cast("date").alias("period")).agg(
        *[expr.alias(name) for name, expr in measures.items()]
    )
    w = W.partitionBy(key).orderBy("period")
    out = rolled
    for m in measures:
        prev, nxt = F.lag(m).over(w), F.lead(m).over(w)
        out = (
            out.withColumn(f"{m}_prev", prev)
            .withColumn(f"{m}_next", nxt)
            .withColumn(f"{m}_pct_prev", 100 * (F.col(m) - prev) / F.nullif(prev, F.lit(0)))
            .withColumn(f"{m}_pct_next", 100 * (nxt - F.col(m)) / F.nullif(F.col(m), F.lit(0)))
        )
    return out


def improved(steps: DataFrame, order: str, column: str) -> DataFrame:
    """Marks each step of a short series (one row per step) as start, better or not better."""
    before = F.lag(column).over(W.orderBy(order))
    verdict = (
        F.when(before.isNull(), "start").when(F.col(column) < before, "better").otherwise("not better")
    )
    return steps.withColumn("verdict", verdict)
