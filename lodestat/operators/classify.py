"""Classifiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists, as_matrix
from lodestat.operators.moments import Moments, column_moments_by, vector_moments_by
from lodestat.session import cut_lineage


def logistic(df: DataFrame, y: str, features: str, C: float = 1.0, penalty: str = "l2", iters: int = 200):
    """Logistic regression with inverse penalty C; the intercept is not penalised."""
    n = df.count()
    return LogisticRegression(
        featuresCol=features, labelCol=y, regParam=1.0 / (C * n), elasticNetParam={"l2": 0.0, "l1": 1.0}[penalty],
        standardization=False, maxIter=iters, tol=1e-9,
    ).fit(df)


def coefficient_table(model, names: Sequence[str]) -> DataFrame:
    """(class, term, estimate) of a fitted linear classifier."""
    session = SparkSession.getActiveSession()
    if hasattr(model, "coefficientMatrix"):
        weights, cuts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    else:
        weights, cuts = model.coefficients.toArray()[None, :], np.array([model.intercept])
    rows = []
    for k, (w, b) in enumerate(zip(weights, cuts)):
        rows.append((k, "(intercept)", float(b)))
        rows += [(k, n, float(v)) for n, v in zip(names, w)]
    return session.createDataFrame(rows, "class int, term string, estimate double")


def predict_proba(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, "prediction", vector_to_array("probability").alias("probability"))


def sparsity(coefficients: DataFrame) -> DataFrame:
    """Percentage of coefficients that are exactly zero, intercepts aside."""
    zero = F.when(F.col("estimate") == 0, 100.0).otherwise(0.0)
    return coefficients.filter(F.col("term") != "(intercept)").agg(F.avg(zero).alias("zero_percent"))


def gaussian_nb(df: DataFrame, y: str, features: str):
    return NaiveBayes(featuresCol=features, labelCol=y, modelType="gaussian").fit(df)


def linear_svm(df: DataFrame, y: str, features: str, C: float = 1.0, iters: int = 200):
    n = df.count()
    return LinearSVC(featuresCol=features, labelCol=y, regParam=1.0 / (C * n), standardization=False, maxIter=iters).fit(df)


def svm_margin(model) -> float:
    """Distance between the two margin lines, 2 / |w|."""
    return float(2.0 / np.linalg.norm(model.coefficients.toArray()))


def tree(df: DataFrame, y: str, features: str, depth: int = 5, seed: int = 0):
    return DecisionTreeClassifier(featuresCol=features, labelCol=y, maxDepth=depth, seed=seed).fit(df)


def forest(df: DataFrame, y: str, features: str, n: int = 10, depth: int = 5, per_split: str = "1", seed: int = 0):
    return RandomForestClassifier(
        featuresCol=features, labelCol=y, numTrees=n, maxDepth=depth, featureSubsetStrategy=per_split, seed=seed
    ).fit(df)


def boosted_trees(df: DataFrame, y: str, features: str, rounds: int = 20, depth: int = 3, seed: int = 0):
    """Gradient boosting, the built-in alternative to ``adaboost`` for two classes."""
    return GBTClassifier(featuresCol=features, labelCol=y, maxIter=rounds, maxDepth=depth, seed=seed).fit(df)


def mlp_classify(df: DataFrame, y: str, features: str, layers: Sequence[int], iters: int = 100, seed: int = 0):
    """Sigmoid hidden layers and a softmax output."""
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=y, layers=list(layers), maxIter=iters, seed=seed
    ).fit(df)


# --- boosting by re-weighting -------------------------------------------------------------------


@dataclass(frozen=True)
class Boosted:
    models: tuple
    alphas: tuple[float, ...]
    classes: tuple[float, ...]


def adaboost(df: DataFrame, y: str, features: str, rounds: int = 10, depth: int = 1, seed: int = 0) -> Boosted:
    """Multi-class boosting of stumps (SAMME, Zhu et al. 2009). A round is one weighted tree fit and
    one aggregate; the weights are written out every few rounds so that the plan stays short."""
    classes = tuple(
        float(r[0]) for r in df.select(F.col(y).cast("double")).distinct().limit(1_001).orderBy(1).collect()
    )
    if len(classes) > 1_000:
        raise ValueError("more than 1000 classes")
    data = df.select(F.col(y).cast("double").alias("_y"), F.col(features).alias("_f")).withColumn("_w", F.lit(1.0))
    models, alphas = [], []
    for r in range(rounds):
        model = DecisionTreeClassifier(
            featuresCol="_f", labelCol="_y", weightCol="_w", maxDepth=depth, seed=seed + r
        ).fit(data)
        scored = model.transform(data).select("_y", "_f", "_w", "prediction")
        miss = F.when(F.col("prediction") != F.col("_y"), F.col("_w")).otherwise(0.0)
        lost, total = scored.agg(F.sum(miss), F.sum("_w")).first()
        err = lost / total
        if err >= 1.0 - 1.0 / len(classes):
            if not models:
                models, alphas = [model], [1.0]
            break
        alpha = float(np.log((1 - err) / max(err, 1e-12)) + np.log(len(classes) - 1))
        models.append(model)
        alphas.append(alpha)
        if err <= 1e-12:
            break
        grown = F.when(F.col("prediction") != F.col("_y"), F.col("_w") * float(np.exp(alpha))).otherwise(F.col("_w"))
        data = scored.select("_y", "_f", (grown / float(total)).alias("_w"))
        if (r + 1) % 4 == 0:
            data = cut_lineage(data)
    return Boosted(tuple(models), tuple(alphas), classes)


def adaboost_predict(df: DataFrame, boosted: Boosted, features: str, name: str = "prediction") -> DataFrame:
    """Class with the largest sum of model weights."""
    out, votes = df, []
    for i, model in enumerate(boosted.models):
        spare = model.copy({model.featuresCol: features, model.predictionCol: f"_p{i}", model.rawPredictionCol: "_r", model.probabilityCol: "_q"})
        out = spare.transform(out).drop("_r", "_q")
        votes.append(f"_p{i}")
    score = [
        sum((F.when(F.col(v) == c, a).otherwise(0.0) for v, a in zip(votes, boosted.alphas)), F.lit(0.0))
        for c in boosted.classes
    ]
    ranked = F.array(*[F.struct((-s).alias("neg"), F.lit(c).alias("c")) for s, c in zip(score, boosted.classes)])
    return out.withColumn(name, F.array_min(ranked)["c"]).drop(*votes)


# --- discriminant analysis ----------------------------------------------------------------------


@dataclass(frozen=True)
class Discriminant:
    labels: tuple[str, ...]
    means: np.ndarray
    inverses: np.ndarray  # one per class, or one shared
    offsets: np.ndarray
    scalings: np.ndarray | None = None
    centre: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.labels)))
        for k in range(len(self.labels)):
            d = x - self.means[k]
            inv = self.inverses[k if len(self.inverses) > 1 else 0]
            out[:, k] = self.offsets[k] - 0.5 * np.einsum("ij,jk,ik->i", d, inv, d)
        return out


def _by_class(df: DataFrame, y: str, xs: Sequence[str] | str) -> dict[str, Moments]:
    found = vector_moments_by(df, xs, y) if isinstance(xs, str) else column_moments_by(df, list(xs), y)
    return dict(sorted(found.items()))


def lda(df: DataFrame, y: str, xs: Sequence[str] | str) -> Discriminant:
    """Class means, priors and one pooled covariance (divisor n - classes) from one grouped pass."""
    m = _by_class(df, y, xs)
    n = sum(v.n for v in m.values())
    within = sum(v.scatter() for v in m.values()) / (n - len(m))
    means = np.array([v.mean for v in m.values()])
    priors = np.array([v.n / n for v in m.values()])
    centre = priors @ means
    d = means - centre
    between = (d * (priors * n)[:, None]).T @ d / (n - 1 if n > 1 else 1)
    # generalised eigenproblem in coordinates where the pooled covariance is the identity
    values, vectors = np.linalg.eigh(within)
    keep = values > values.max() * 1e-10
    white = vectors[:, keep] / np.sqrt(values[keep])
    spread, axes = np.linalg.eigh(white.T @ between @ white)
    order = np.argsort(-spread)[: max(1, len(m) - 1)]
    scalings = white @ axes[:, order]
    big = np.abs(scalings).argmax(axis=0)
    scalings = scalings * np.where(scalings[big, np.arange(scalings.shape[1])] < 0, -1.0, 1.0)
    return Discriminant(tuple(m), means, (white @ white.T)[None], np.log(priors), scalings, centre)


def qda(df: DataFrame, y: str, xs: Sequence[str] | str) -> Discriminant:
    """One sample covariance per class."""
    m = _by_class(df, y, xs)
    n = sum(v.n for v in m.values())
    covs = [v.scatter() / max(v.n - 1, 1) for v in m.values()]
    inverses = np.array([np.linalg.pinv(c) for c in covs])
    logdets = np.array([np.log(np.maximum(np.linalg.eigvalsh(c), 1e-300)).sum() for c in covs])
    priors = np.array([v.n / n for v in m.values()])
    return Discriminant(tuple(m), np.array([v.mean for v in m.values()]), inverses, np.log(priors) - 0.5 * logdets)


def _vector(xs: Sequence[str] | str) -> Column:
    return F.col(xs).cast("array<double>") if isinstance(xs, str) else F.array(*[F.col(x).cast("double") for x in xs])


def discriminate(df: DataFrame, model: Discriminant, xs: Sequence[str] | str, name: str = "prediction") -> DataFrame:
    """Label with the largest score (labels come back as text)."""

    @F.arrow_udf("string")
    def label(v: pa.Array) -> pa.Array:
        return pa.array([model.labels[k] for k in model.scores(as_matrix(v)).argmax(1)], pa.string())

    return df.withColumn(name, label(_vector(xs)))


def discriminant_proba(df: DataFrame, model: Discriminant, xs: Sequence[str] | str, name: str = "probability") -> DataFrame:
    @F.arrow_udf("array<double>")
    def proba(v: pa.Array) -> pa.Array:
        s = model.scores(as_matrix(v))
        e = np.exp(s - s.max(1, keepdims=True))
        return as_lists(e / e.sum(1, keepdims=True))

    return df.withColumn(name, proba(_vector(xs)))


def lda_transform(df: DataFrame, model: Discriminant, xs: Sequence[str] | str, n: int, name: str = "components") -> DataFrame:
    """Coordinates on the first n discriminant axes."""
    axes = model.scalings[:, :n]

    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        return as_lists((as_matrix(v) - model.centre) @ axes)

    return df.withColumn(name, project(_vector(xs)))


# --- many models --------------------------------------------------------------------------------


def compare(
    models: Mapping[str, Callable[[DataFrame, DataFrame], DataFrame]],
    datasets: Mapping[str, tuple[DataFrame, DataFrame]],
    score: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Score table (dataset, model, metric, value). A model is a function that fits on the first
    table and gives predictions for the second; ``score`` turns predictions into a one-row table."""
    rows, spark = [], None
    for d, (train, test) in datasets.items():
        spark = train.sparkSession
        train, test = train.persist(), test.persist()
        for m, run in models.items():
            rows += [(d, m, k, float(v)) for k, v in score(run(train, test)).first().asDict().items() if v is not None]
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "dataset string, model string, metric string, value double")
