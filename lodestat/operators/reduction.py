"""Principal components from the moments of a vector column, and spectral bi-clustering."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists, as_matrix
from lodestat.operators.clustering import assign, centre_matrix, kmeans
from lodestat.operators.moments import Moments, gram_matrices, vector_moments


@dataclass(frozen=True)
class Components:
    mean: np.ndarray
    scale: np.ndarray
    axes: np.ndarray  # (features, kept)
    variances: np.ndarray  # of all components
    kept: int

    def table(self, spark: SparkSession) -> DataFrame:
        """(component, variance, ratio, cumulative) of every component."""
        share = self.variances / self.variances.sum()
        rows = [
            (i + 1, float(v), float(s), float(c))
            for i, (v, s, c) in enumerate(zip(self.variances, share, np.cumsum(share)))
        ]
        return spark.createDataFrame(rows, "component int, variance double, ratio double, cumulative double")


def components_from(m: Moments, k: int | None, variance: float | None, normalize: bool) -> Components:
    scale = np.sqrt(np.diag(m.cov)) if normalize else np.ones(len(m.mean))
    scale = np.where(scale > 0, scale, 1.0)
    cov = m.cov / np.outer(scale, scale) * (m.n / max(m.n - 1, 1))
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)
    values, axes = np.maximum(values[order], 0.0), axes[:, order]
    if variance is not None:
        reached = np.cumsum(values) / values.sum() >= variance - 1e-12
        k = int(np.argmax(reached)) + 1
    k = len(values) if k is None else min(k, len(values))
    axes = axes[:, :k]
    # a component's sign is free; the largest loading is made positive
    big = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[big, np.arange(k)] < 0, -1.0, 1.0)
    return Components(m.mean, scale, axes, values, k)


def pca(df: DataFrame, vec: str, k: int | None = None, variance: float | None = None, normalize: bool = False) -> Components:
    """Components of the centred (and, with ``normalize``, standardised) vectors: one Gram pass, then
    an eigenproblem of the size of the feature set. Give ``k`` or a target ``variance`` share."""
    return components_from(vector_moments(df, vec), k, variance, normalize)


def pca_scores(df: DataFrame, fit: Components, vec: str, name: str = "scores") -> DataFrame:
    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        return as_lists(((as_matrix(v) - fit.mean) / fit.scale) @ fit.axes)

    return df.withColumn(name, project(F.col(vec)))


# --- bi-clustering ------------------------------------------------------------------------------


def bicluster(df: DataFrame, id_col: str, vec: str, n: int, rounds: int = 100, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Spectral bi-clustering with bistochastic scaling (Kluger et al. 2003): row labels and column
    labels, each (key, cluster).

    Column factors have one number per feature and live on the driver; row factors are a column of
    the table. A scaling round is one pass that ships one number per feature and task. The leading
    singular vectors of the scaled table come from its Gram matrix, the first (constant) pair is
    left out, and rows and columns are clustered in the coordinates of the others.
    """
    width = df.select(F.size(vec)).first()[0]
    low = df.agg(F.min(F.array_min(F.col(vec).cast("array<double>")))).first()[0]
    shift = max(0.0, -float(low)) + 1e-9 if low is not None and low <= 0 else 0.0
    rows = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")).persist()
    col = np.ones(width)
    for _ in range(rounds):
        new = 1.0 / _column_sums(rows, col, shift, width)
        new *= np.sqrt(width) / np.linalg.norm(new)
        if np.allclose(new, col, rtol=1e-8, atol=0):
            break
        col = new
    scaled = rows.withColumn("s", _balanced(F.col("v"), col, shift))
    (g,) = gram_matrices(scaled, "s").values()
    values, vectors = np.linalg.eigh(g)
    take = np.argsort(-values)[1 : 1 + max(1, min(n, 4))]
    axes = vectors[:, take]
    embedded = pca_like(scaled, "s", axes / np.sqrt(np.maximum(values[take], 1e-300)))
    row_model = kmeans(embedded, "e", n, iters=50, seed=seed)
    row_labels = assign(embedded, "e", centre_matrix(row_model)).select("id", "cluster")
    spark = df.sparkSession
    columns = spark.createDataFrame([(j, [float(x) for x in axes[j]]) for j in range(width)], "pos int, e array<double>")
    col_model = kmeans(columns, "e", min(n, width), iters=50, seed=seed)
    col_labels = assign(columns, "e", centre_matrix(col_model)).select("pos", "cluster")
    return row_labels, col_labels


def pca_like(df: DataFrame, vec: str, axes: np.ndarray) -> DataFrame:
    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        return as_lists(as_matrix(v) @ axes)

    return df.select("id", project(F.col(vec)).alias("e"))


def _balanced(v, col: np.ndarray, shift: float):
    """Row scaled to a fixed length sum under the current column factors."""

    @F.arrow_udf("array<double>")
    def scale(x: pa.Array) -> pa.Array:
        m = (as_matrix(x) + shift) * col
        return as_lists(m / m.sum(1, keepdims=True))

    return scale(v)


def _column_sums(rows: DataFrame, col: np.ndarray, shift: float, width: int) -> np.ndarray:
    """Column sums of the row-balanced table without its column factors."""

    def partial(batches):
        acc = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                m = as_matrix(batch.column("v")) + shift
                acc += (m / (m @ col)[:, None]).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(acc)], names=["j", "s"])

    sums = rows.select("v").mapInArrow(partial, "j bigint, s double").groupBy("j").agg(F.sum("s").alias("s"))
    out = np.ones(width)
    for r in sums.collect():  # one number per feature
        out[r["j"]] = r["s"]
    return out
