"""Sufficient statistics: counts, means, centred covariances and Gram matrices by distributed sums.

Their size depends on the number of features only. That bound is checked before anything of that
size is brought to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists, as_matrix

MAX_FEATURES = 4_096
MAX_GROUPS = 1_024
MAX_ROWS = 81_920  # matrix rows, over all groups, that may come to the driver
AGGREGATED = 8  # columns whose covariances are written out as one aggregate
TASK_CELLS = 16_000_000  # doubles a task may hold before it hands its partial sums on


def _source(df: DataFrame, vec: str | Column, by: str | None) -> DataFrame:
    group = F.col(by).cast("string") if by else F.lit("")
    v = F.col(vec) if isinstance(vec, str) else vec
    return df.select(group.alias("grp"), v.cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & F.col("grp").isNotNull())


def gram_rows(df: DataFrame, vec: str | Column, by: str | None = None, shifts: Mapping[str, np.ndarray] | None = None) -> DataFrame:
    """Rows of X'X per group as (grp, i, row): one block product per Arrow batch, one partial matrix
    per task, and an element-wise sum of the partial rows. ``shifts`` has a vector per group that is
    taken off its rows first."""
    src = _source(df, vec, by)

    def emit(acc):
        for g, m in acc.items():
            d = m.shape[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * d, pa.string()), pa.array(np.arange(d, dtype=np.int32)), as_lists(m)],
                names=["grp", "i", "row"],
            )

    def partial(batches):
        acc: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = as_matrix(batch.column("v"))
            if x.shape[1] > MAX_FEATURES:
                raise ValueError(f"more than {MAX_FEATURES} features")
            codes = batch.column("grp").dictionary_encode()
            names = codes.dictionary.to_pylist()
            at = codes.indices.to_numpy(zero_copy_only=False)
            for c, g in enumerate(names):
                part = x if len(names) == 1 else x[at == c]
                if shifts is not None:
                    part = part - shifts[g]
                acc[g] = acc.get(g, 0.0) + part.T @ part
            if len(acc) * x.shape[1] ** 2 > TASK_CELLS:
                yield from emit(acc)
                acc = {}
        yield from emit(acc)

    partials = src.mapInArrow(partial, "grp string, i int, row array<double>")
    total = Summarizer.sum(array_to_vector(F.col("row")))
    return partials.groupBy("grp", "i").agg(vector_to_array(total).alias("row"))


def gram(df: DataFrame, vec: str) -> DataFrame:
    """Gram matrix of a vector column in long form (i, j, value)."""
    return gram_rows(df, vec).select(
        F.col("i").cast("bigint").alias("i"), F.posexplode("row").alias("j", "value")
    ).withColumn("j", F.col("j").cast("bigint"))


@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariances of a set of columns."""

    n: float
    mean: np.ndarray
    cov: np.ndarray

    def scatter(self) -> np.ndarray:
        """Sum of centred outer products."""
        return self.cov * self.n


def gram_matrices(
    df: DataFrame, vec: str | Column, by: str | None = None, shifts: Mapping[str, np.ndarray] | None = None
) -> dict[str, np.ndarray]:
    """Gram matrices on the driver, one per group; features and groups are bounded and checked."""
    rows = gram_rows(df, vec, by, shifts).limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} matrix rows over all groups")
    found: dict[str, dict[int, list[float]]] = {}
    for r in rows:
        found.setdefault(r["grp"], {})[r["i"]] = r["row"]
    if len(found) > MAX_GROUPS or any(len(m) > MAX_FEATURES for m in found.values()):
        raise ValueError(f"more than {MAX_FEATURES} features or {MAX_GROUPS} groups")
    return {g: np.array([m[i] for i in range(len(m))]) for g, m in found.items()}


def vector_moments(df: DataFrame, vec: str, *targets: str) -> Moments:
    """Moments of [targets..., vector]."""
    both = F.concat(F.array(*[F.col(t).cast("double") for t in targets]), F.col(vec).cast("array<double>")) if targets else F.col(vec)
    (m,) = _centred(df, both, None).values()
    return m


def vector_moments_by(df: DataFrame, vec: str, by: str) -> dict[str, Moments]:
    return _centred(df, vec, by)


def _centred(df: DataFrame, vec: str | Column, by: str | None) -> dict[str, Moments]:
    """Moments per group, summed about the group's mean: values far from zero lose no digits.

    The means come from a first pass, which also shows how many groups and features there are before
    anything of the size of a matrix is made.
    """
    src = _source(df, vec, by)
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("v"))))
    first = src.groupBy("grp").agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), mean.alias("mean"))
    seen = first.select("n", "d").limit(MAX_GROUPS + 1).collect()
    if len(seen) > MAX_GROUPS or any(r["d"] > MAX_FEATURES for r in seen) or sum(r["d"] for r in seen) > MAX_ROWS:
        raise ValueError(f"more than {MAX_FEATURES} features, {MAX_GROUPS} groups or {MAX_ROWS} matrix rows")
    begun = {r["grp"]: (float(r["n"]), np.array(r["mean"])) for r in first.collect()}
    one = F.concat(F.array(F.lit(1.0)), F.col("v"))
    grams = gram_matrices(src, one, "grp", {g: np.concatenate([[0.0], m]) for g, (_, m) in begun.items()})
    out = {}
    for g, (n, shift) in begun.items():
        off = grams[g][0, 1:] / n  # what rounding has left between the shift and the mean
        out[g] = Moments(n, shift + off, grams[g][1:, 1:] / n - np.outer(off, off))
    return out


def column_moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments of named columns; rows with a null are left out."""
    return next(iter(column_moments_by(df, columns, None).values()))


def column_moments_by(df: DataFrame, columns: Sequence[str], by: str | None) -> dict[str, Moments]:
    """Per-group moments of named columns: one grouped aggregate for a few, blocks for many. Both are centred."""
    d = len(columns)
    if d > AGGREGATED:
        packed = df.dropna(subset=list(columns)).select(
            *([by] if by else []), F.array(*[F.col(c).cast("double") for c in columns]).alias("_v")
        )
        return vector_moments_by(packed, "_v", by) if by else {"": vector_moments(packed, "_v")}
    kept = df.dropna(subset=list(columns))
    grouped = kept.groupBy(F.col(by).cast("string").alias("_g")) if by else kept.groupBy(F.lit("").alias("_g"))
    rows = (
        grouped.agg(
            F.count("*").alias("_n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)],
        )
        .limit(MAX_GROUPS + 1)
        .collect()
    )
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    out = {}
    for r in rows:
        cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)], dtype=float)
        out[r["_g"]] = Moments(float(r["_n"]), np.array([r[f"m{i}"] for i in range(d)], dtype=float), cov)
    return out
