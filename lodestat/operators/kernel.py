"""RBF kernel models through random Fourier features (Rahimi and Recht, 2007): the kernel matrix of
all row pairs is replaced by a bounded number of seeded cosine features per row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists, as_matrix
from lodestat.operators.moments import gram_matrices


def _features(x: np.ndarray, gamma: float, dim: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    omega = rng.normal(0.0, np.sqrt(2.0 * gamma), (x.shape[1], dim))
    phase = rng.uniform(0.0, 2.0 * np.pi, dim)
    return np.sqrt(2.0 / dim) * np.cos(x @ omega + phase)


def rbf_features(vec: str | Column, gamma: float, dim: int, seed: int) -> Column:
    """Array column whose dot products approximate exp(-gamma |a - b|^2)."""

    @F.arrow_udf("array<double>")
    def expand(v: pa.Array) -> pa.Array:
        return as_lists(_features(as_matrix(v), gamma, dim, seed))

    return expand(F.col(vec) if isinstance(vec, str) else vec)


@dataclass(frozen=True)
class KernelFit:
    weights: np.ndarray
    intercept: float
    gamma: float
    dim: int
    seed: int


def predict(df: DataFrame, fit: KernelFit, vec: str, name: str = "prediction") -> DataFrame:
    @F.arrow_udf("double")
    def score(v: pa.Array) -> pa.Array:
        return pa.array(_features(as_matrix(v), fit.gamma, fit.dim, fit.seed) @ fit.weights + fit.intercept)

    return df.withColumn(name, score(F.col(vec)))


def rbf_ridge(df: DataFrame, y: str, vec: str, gamma: float, alpha: float, dim: int = 256, seed: int = 0) -> KernelFit:
    """Kernel ridge without intercept: one Gram pass over [y, features]."""
    z = rbf_features(vec, gamma, dim, seed)
    (g,) = gram_matrices(df, F.concat(F.array(F.col(y).cast("double")), z)).values()
    w = np.linalg.solve(g[1:, 1:] + alpha * np.eye(dim), g[1:, 0])
    return KernelFit(w, 0.0, gamma, dim, seed)


def rbf_svr(
    df: DataFrame, y: str, vec: str, gamma: float, C: float = 1.0, eps: float = 0.1, dim: int = 128,
    steps: int = 40, seed: int = 0,
) -> KernelFit:
    """Epsilon-insensitive regression: |w|^2 / 2 + C sum(max(0, |e| - eps)).

    Full-batch subgradient steps on the standardised target, averaged over the second half. Each
    step is one map over the rows and a sum of per-task gradients; a task ships dim + 1 numbers. The rows are kept as given
    and their features made anew in each step: ``dim`` features are many times the size of the vector they come from.
    """
    n, mean, std = df.agg(F.count(y), F.avg(y), F.stddev_pop(y)).first()
    std = float(std) or 1.0
    target = (F.col(y).cast("double") - float(mean)) / std
    rows = df.filter(F.col(y).isNotNull()).select(target.alias("y"), F.col(vec).alias("x")).persist()
    lam, tube = std / (C * n), eps / std
    w, b, avg_w, avg_b, kept = np.zeros(dim), 0.0, np.zeros(dim), 0.0, 0
    for t in range(1, steps + 1):
        g = _tube_gradient(rows, w, b, tube, dim, gamma, seed)
        eta = min(1.0 / (lam * t), 2.0 / np.sqrt(t))
        w = w - eta * (lam * w - g[:dim] / n)
        b = b + eta * g[dim] / n
        if t > steps // 2:
            avg_w, avg_b, kept = avg_w + w, avg_b + b, kept + 1
    rows.unpersist()
    return KernelFit(std * avg_w / kept, float(mean) + std * avg_b / kept, gamma, dim, seed)


def _tube_gradient(rows: DataFrame, w: np.ndarray, b: float, eps: float, dim: int, gamma: float, seed: int) -> np.ndarray:
    def partial(batches):
        acc = np.zeros(dim + 1)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            z = _features(as_matrix(batch.column("x")), gamma, dim, seed)
            e = batch.column("y").to_numpy(zero_copy_only=False) - z @ w - b
            side = np.sign(e) * (np.abs(e) > eps)
            acc[:dim] += side @ z
            acc[dim] += side.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1)), pa.array(acc)], names=["i", "g"])

    sums = rows.mapInArrow(partial, "i bigint, g double").groupBy("i").agg(F.sum("g").alias("g"))
    out = np.zeros(dim + 1)
    for r in sums.collect():  # dim + 1 rows
        out[r["i"]] = r["g"]
    return out


def rbf_svm(df: DataFrame, y: str, vec: str, gamma: float, C: float = 1.0, dim: int = 256, seed: int = 0):
    """RBF support-vector classifier; more than two classes go one against the rest. Returns the
    fitted Spark model and the function that adds its feature column."""

    def expand(d: DataFrame) -> DataFrame:
        return d.withColumn("_z", array_to_vector(rbf_features(vec, gamma, dim, seed)))

    data = expand(df.withColumn("_y", F.col(y).cast("double"))).persist()
    n, classes = data.agg(F.count("*"), F.max("_y")).first()
    svc = LinearSVC(featuresCol="_z", labelCol="_y", regParam=1.0 / (C * n), standardization=False, maxIter=60)
    est = svc if classes <= 1 else OneVsRest(classifier=svc, featuresCol="_z", labelCol="_y", parallelism=4)
    model = est.fit(data)
    data.unpersist()
    return model, expand


def rf_regress(df: DataFrame, y: str, features: str, trees: int = 100, min_split: int = 5, depth: int = 8, seed: int = 0):
    """Random forest; the smallest splittable node becomes a floor on the rows per child."""
    return RandomForestRegressor(
        featuresCol=features, labelCol=y, numTrees=trees, maxDepth=depth, minInstancesPerNode=max(1, min_split // 2), seed=seed
    ).fit(df)
