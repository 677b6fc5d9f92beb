"""Linear models. The data is read once for its moments; what is solved on the driver has the size
of the feature set, never of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists, as_matrix
from lodestat.operators import joins as jo
from lodestat.operators.moments import Moments, column_moments, vector_moments


@dataclass(frozen=True)
class LinearFit:
    names: tuple[str, ...]
    weights: np.ndarray
    intercept: float

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [("(intercept)", float(self.intercept)), *[(n, float(w)) for n, w in zip(self.names, self.weights)]]
        return spark.createDataFrame(rows, "term string, estimate double")

    def expression(self) -> Column:
        out = F.lit(float(self.intercept))
        for n, w in zip(self.names, self.weights):
            out = out + F.col(n) * float(w)
        return out


def predict(df: DataFrame, fit: LinearFit, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, fit.expression())


def _solve(scatter: np.ndarray, cross: np.ndarray, alpha: float) -> np.ndarray:
    a = scatter + alpha * np.eye(len(scatter))
    return np.linalg.lstsq(a, cross, rcond=None)[0]


def from_moments(m: Moments, names: Sequence[str], alpha: float = 0.0, normalize: bool = False) -> LinearFit:
    """Least squares with squared penalty ``alpha`` from the moments of [y, x...]; the intercept is
    not penalised. ``normalize`` penalises columns scaled to unit centred length."""
    s = m.scatter()
    lengths = np.sqrt(np.diag(s)[1:]) if normalize else np.ones(len(names))
    lengths = np.where(lengths > 0, lengths, 1.0)
    w = _solve(s[1:, 1:] / np.outer(lengths, lengths), s[1:, 0] / lengths, alpha) / lengths
    return LinearFit(tuple(names), w, float(m.mean[0] - m.mean[1:] @ w))


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> LinearFit:
    return from_moments(column_moments(df, [y, *xs]), xs)


def ridge(df: DataFrame, y: str, xs: Sequence[str], alpha: float, normalize: bool = False) -> LinearFit:
    """Minimises |y - Xw|^2 + alpha |w|^2."""
    return from_moments(column_moments(df, [y, *xs]), xs, alpha, normalize)


def lasso(df: DataFrame, y: str, xs: Sequence[str], alpha: float, normalize: bool = False) -> LinearFit:
    """Minimises |y - Xw|^2 / (2n) + alpha |w|_1."""
    data, lengths = df.select(F.col(y).cast("double").alias(y), *xs), np.ones(len(xs))
    if normalize:
        m = column_moments(df, list(xs))
        lengths = np.sqrt(np.diag(m.scatter()))
        lengths = np.where(lengths > 0, lengths, 1.0)
        data = data.withColumns({x: F.col(x) / float(s) for x, s in zip(xs, lengths)})
    fitted = lasso_vectors(VectorAssembler(inputCols=list(xs), outputCol="_f").transform(data), y, "_f", alpha)
    return LinearFit(tuple(xs), fitted.coefficients.toArray() / lengths, float(fitted.intercept))


def lasso_vectors(df: DataFrame, y: str, features: str, alpha: float, intercept: bool = True):
    """The same on a vector column, sparse or dense; gives the fitted Spark model."""
    return LinearRegression(
        featuresCol=features, labelCol=y, elasticNetParam=1.0, regParam=alpha, standardization=False,
        fitIntercept=intercept, maxIter=1000, tol=1e-10,
    ).fit(df)


def coef_path(
    df: DataFrame, y: str, xs: Sequence[str], alphas: Sequence[float], kind: str = "ridge", normalize: bool = False
) -> DataFrame:
    """Coefficients over a list of penalties as (alpha, variable, estimate). The ridge path needs
    one pass over the data, whatever the number of penalties."""
    spark, rows = df.sparkSession, []
    if kind == "ridge":
        m = column_moments(df, [y, *xs])
        fits = [(a, from_moments(m, xs, a, normalize)) for a in alphas]
    elif kind == "lasso":
        kept = df.select(y, *xs).persist()
        fits = [(a, lasso(kept, y, xs, a, normalize)) for a in alphas]
        kept.unpersist()
    else:
        raise ValueError(f"unknown kind {kind}")
    for a, f in fits:
        rows += [(float(a), n, float(w)) for n, w in zip(f.names, f.weights)]
    return spark.createDataFrame(rows, "alpha double, variable string, estimate double")


def ridge_cv(df: DataFrame, y: str, xs: Sequence[str], alphas: Sequence[float]) -> tuple[LinearFit, DataFrame]:
    """Penalty with the smallest mean squared leave-one-out error, all penalties scored in one
    second pass through e / (1 - h) with h the leverage of the row."""
    m = column_moments(df, [y, *xs])
    s, fits = m.scatter(), [from_moments(m, xs, a) for a in alphas]
    inverses = [np.linalg.pinv(s[1:, 1:] + a * np.eye(len(xs))) for a in alphas]

    def partial(batches):
        total = np.zeros(len(alphas))
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(xs) + 1)])
            x = rows[:, 1:] - m.mean[1:]
            for i, (fit, inv) in enumerate(zip(fits, inverses)):
                e = rows[:, 0] - m.mean[0] - x @ fit.weights
                h = 1.0 / m.n + np.einsum("ij,jk,ik->i", x, inv, x)
                total[i] += ((e / (1.0 - h)) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([float(a) for a in alphas]), pa.array(total)], names=["alpha", "sse"])

    kept = df.dropna(subset=[y, *xs]).select(*[F.col(c).cast("double") for c in [y, *xs]])
    scores = (
        kept.mapInArrow(partial, "alpha double, sse double")
        .groupBy("alpha")
        .agg((F.sum("sse") / F.lit(m.n)).alias("loo_mse"))
    )
    best = min(scores.collect(), key=lambda r: (r["loo_mse"], r["alpha"]))["alpha"]
    return fits[[float(a) for a in alphas].index(best)], scores


@dataclass(frozen=True)
class MultiFit:
    weights: np.ndarray  # (inputs, outputs)
    intercept: np.ndarray


def multi_ridge(df: DataFrame, x_vec: str, y_vec: str, alpha: float = 0.0) -> MultiFit:
    """Predict one vector from another; one Gram pass over the joined vector."""
    width = df.select(F.size(y_vec)).first()[0]
    joined = df.select(F.concat(F.col(y_vec).cast("array<double>"), F.col(x_vec).cast("array<double>")).alias("_v"))
    m = vector_moments(joined, "_v")
    s = m.scatter()
    w = _solve(s[width:, width:], s[width:, :width], alpha)
    return MultiFit(w, m.mean[:width] - m.mean[width:] @ w)


def predict_vector(df: DataFrame, fit: MultiFit, x_vec: str, name: str = "prediction") -> DataFrame:
    @F.arrow_udf("array<double>")
    def apply(v: pa.Array) -> pa.Array:
        return as_lists(as_matrix(v) @ fit.weights + fit.intercept)

    return df.withColumn(name, apply(x_vec))


# --- gradient descent and the loss surface ------------------------------------------------------


@dataclass(frozen=True)
class Descent:
    theta: np.ndarray  # bias first
    history: list[tuple[int, float, list[float]]]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, loss, theta) for i, loss, theta in self.history]
        return spark.createDataFrame(rows, "iteration int, loss double, theta array<double>")


def gd_linear(df: DataFrame, y: str, xs: Sequence[str], lr: float, iters: int, reg: float = 0.0) -> Descent:
    """Batch gradient descent on sum(e^2)/(2N) + reg/(2N) sum(theta_j^2, j > 0), from zero.

    The loss and its gradient depend on the data only through second moments, so one pass gives the
    same iterates as a pass per step. ``history`` holds the loss before each update.
    """
    m = column_moments(df, [y, *xs])
    second = m.cov + np.outer(m.mean, m.mean)
    a = np.block([[np.ones((1, 1)), m.mean[None, 1:]], [m.mean[1:, None], second[1:, 1:]]])
    b = np.concatenate([[m.mean[0]], second[1:, 0]])
    penal = np.concatenate([[0.0], np.full(len(xs), reg / m.n)])
    theta, history = np.zeros(len(xs) + 1), []
    for i in range(iters):
        loss = (theta @ a @ theta - 2 * b @ theta + second[0, 0]) / 2 + (penal * theta * theta).sum() / 2
        history.append((i, float(loss), [float(t) for t in theta]))
        theta = theta - lr * (a @ theta - b + penal * theta)
    return Descent(theta, history)


def loss_surface(df: DataFrame, y: str, x: str, grid0: Column, grid1: Column) -> DataFrame:
    """Squared loss over a grid of (intercept, slope): five sums of the data, then the grid."""
    sums = df.dropna(subset=[y, x]).agg(
        F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"),
        F.avg(F.col(x) * F.col(x)).alias("mxx"), F.avg(F.col(x) * F.col(y)).alias("mxy"), F.avg(F.col(y) * F.col(y)).alias("myy"),
    )
    c = F.col
    cells = jo.grid(sums, grid0, grid1, "theta0", "theta1")
    loss = (
        c("myy") + c("theta0") * c("theta0") + c("theta1") * c("theta1") * c("mxx")
        + 2 * c("theta0") * c("theta1") * c("mx") - 2 * c("theta0") * c("my") - 2 * c("theta1") * c("mxy")
    ) / 2
    return cells.select("theta0", "theta1", loss.alias("loss"))
