"""Model selection: cross-validation, sweeps, repeated hold-out, learning and complexity curves.

The data is cached once, folds are filters on a fold column, and independent fits are submitted
from a small thread pool so that Spark can overlap their jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions import hashing as hs
from lodestat.functions.blocks import as_lists, as_matrix
from lodestat.operators import linear as li
from lodestat.operators import metrics as me
from lodestat.operators import prep
from lodestat.operators.moments import AGGREGATED, Moments, column_moments, column_moments_by

PARALLEL = 4


def chain(*stages) -> Pipeline:
    """Transformers and one estimator in sequence."""
    return Pipeline(stages=list(stages))


def _run(spark, jobs: list[Callable[[], list[tuple]]]) -> list[tuple]:
    """Run independent fits side by side; the order of the results is the order of the jobs."""
    pool = ThreadPool(PARALLEL)
    try:
        parts = pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs)
    finally:
        pool.close()
    return [row for part in parts for row in part]


def cv_score(estimator: Estimator, df: DataFrame, fold: str, n: int, evaluator: Evaluator) -> DataFrame:
    """Score of every fold as (fold, value)."""
    data = df.persist()

    def one(i):
        rest, hit = prep.fold_split(data, fold, i)
        return [(i, float(evaluator.evaluate(estimator.fit(rest).transform(hit))))]

    rows = _run(df.sparkSession, [lambda i=i: one(i) for i in range(n)])
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, value double")


def grid_search(
    make: Callable[..., Estimator], grid: Mapping[str, Sequence[float]], df: DataFrame, fold: str, n: int, evaluator: Evaluator
) -> DataFrame:
    """Every parameter combination on every fold: (one column per parameter, fold, value)."""
    data = df.persist()
    names = list(grid)

    def one(values, i):
        rest, hit = prep.fold_split(data, fold, i)
        model = make(**dict(zip(names, values))).fit(rest)
        return [(*[float(v) for v in values], i, float(evaluator.evaluate(model.transform(hit))))]

    cells = [(v, i) for v in product(*grid.values()) for i in range(n)]
    rows = _run(df.sparkSession, [lambda v=v, i=i: one(v, i) for v, i in cells])
    data.unpersist()
    schema = ", ".join([*[f"{p} double" for p in names], "fold int", "value double"])
    return df.sparkSession.createDataFrame(rows, schema)


def grid_summary(scores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean, population deviation and standard error per parameter cell."""
    return scores.groupBy(*names).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        (F.stddev_pop("value") / F.sqrt(F.count("*"))).alias("stderr"),
    )


def sweep(
    make: Callable[..., Estimator], grid: Mapping[str, Sequence[float]], df: DataFrame, fold: str, n: int, evaluator: Evaluator
):
    """Cross-validate every cell, pick the best mean, refit on all rows: (model, parameters, scores)."""
    scores = grid_search(make, grid, df, fold, n, evaluator)
    means = grid_summary(scores, list(grid))
    first = F.col("mean").desc() if evaluator.isLargerBetter() else F.col("mean").asc()
    best = means.orderBy(first, *grid).limit(1).first()
    params = {p: best[p] for p in grid}
    return make(**params).fit(df), params, scores


def _minus(a: Moments, parts: Sequence[Moments]) -> Moments:
    """Moments of the rows that are in ``a`` but in none of ``parts``; scatters are split, raw squares never subtracted."""
    import numpy as np

    b = _merge(parts)
    n, gap = a.n - b.n, b.mean - a.mean
    scatter = a.scatter() - b.scatter() - (a.n * b.n / n) * np.outer(gap, gap)
    return Moments(n, a.mean - (b.n / n) * gap, scatter / n)


def _mse(fit: li.LinearFit, m: Moments) -> float:
    """Mean squared error of a linear fit on rows known by their moments of [y, x...]."""
    import numpy as np

    c = np.concatenate([[1.0], -fit.weights])
    bias = float(m.mean @ c) - fit.intercept
    return float(c @ m.cov @ c) + bias * bias


def ridge_cv_path(df: DataFrame, y: str, xs: Sequence[str], alphas: Sequence[float], fold: str) -> DataFrame:
    """Cross-validated MSE of ridge for any number of penalties from one grouped pass: the moments
    of a training side are the total minus the fold's own."""
    per = column_moments_by(df, [y, *xs], fold)
    whole = _merge(list(per.values()))
    rows = []
    for f, m in sorted(per.items()):
        rest = _minus(whole, [m])
        rows += [(float(a), int(float(f)), _mse(li.from_moments(rest, xs, a), m)) for a in alphas]
    return df.sparkSession.createDataFrame(rows, "alpha double, fold int, mse double")


def _merge(parts: Sequence[Moments]) -> Moments:
    import numpy as np

    n, start = sum(p.n for p in parts), parts[0].mean
    mean = start + sum(p.n * (p.mean - start) for p in parts) / n
    scatter = sum(p.scatter() + p.n * np.outer(p.mean - mean, p.mean - mean) for p in parts)
    return Moments(n, mean, scatter / n)


def repeated_holdout(
    df: DataFrame, y: str, xs: Sequence[str], key: str, repeats: int, test_frac: float, alpha: float, seed: int = 0
) -> DataFrame:
    """Random train/test splits, scores of OLS and ridge per repeat: (repeat, model, train_r2,
    test_r2, test_mse).

    All repeats share one pass. A key meets every repeat once, inside its own task, and its rows join
    the test moments of those repeats that drew it; the training moments follow by subtraction.
    """
    whole = column_moments(df, [y, *xs])
    if len(whole.mean) > AGGREGATED:
        drawn = F.array_compact(
            F.array(*[F.when(hs.hash_below(key, seed + r, test_frac), F.lit(r)) for r in range(repeats)])
        )
        per = column_moments_by(df.select(y, *xs, F.explode(drawn).alias("_r")), [y, *xs], "_r")
    else:
        per = _drawn_moments(df, [y, *xs], key, range(seed, seed + repeats), test_frac, whole)
    rows = []
    for r in range(repeats):
        test = per[str(r)]
        train = _minus(whole, [test])
        for name, a in (("ols", 0.0), ("ridge", alpha)):
            fit = li.from_moments(train, xs, a)
            mse = _mse(fit, test)
            rows.append((r, name, float(1 - _mse(fit, train) / train.cov[0, 0]), float(1 - mse / test.cov[0, 0]), mse))
    return df.sparkSession.createDataFrame(rows, "repeat int, model string, train_r2 double, test_r2 double, test_mse double")


def _drawn_moments(df: DataFrame, columns: Sequence[str], key: str, seeds: Sequence[int], frac: float, whole: Moments) -> dict[str, Moments]:
    """Moments of the rows that a hash of ``key`` draws under each seed, by the number of the seed.

    Rows of one key are drawn together, so they are first added up to one row of sums about the mean of all rows; the hashes
    are made once a key, and a task adds the sums of its keys to those of all seeds by one matrix product a batch.
    """
    import numpy as np

    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.col(c).cast("double") - float(m) for c, m in zip(columns, whole.mean)]
    kept = df.dropna(subset=list(columns)).select(F.col(key).cast("string").alias("_key"), *[v.alias(f"_x{i}") for i, v in enumerate(x)])
    sums = kept.groupBy("_key").agg(
        F.count("*").cast("double").alias("_n"), *[F.sum(f"_x{i}").alias(f"_s{i}") for i in range(d)],
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_q{i}_{j}") for i, j in pairs],
    )
    packed = sums.select("_key", F.array("_n", *[f"_s{i}" for i in range(d)], *[f"_q{i}_{j}" for i, j in pairs]).alias("sums"))

    def partial(batches):
        acc = None
        for batch in batches:
            if batch.num_rows:
                drawn = hs.drawn_below(batch.column("_key").to_pylist(), seeds, frac)
                part = drawn.T.astype(np.float64) @ as_matrix(batch.column("sums"))
                acc = part if acc is None else acc + part
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc), dtype=np.int32)), as_lists(acc)], names=["r", "sums"])

    total = vector_to_array(Summarizer.sum(array_to_vector(F.col("sums"))))
    out = {}
    for r, found in packed.mapInArrow(partial, "r int, sums array<double>").groupBy("r").agg(total.alias("sums")).collect():
        n, s, q = found[0], np.array(found[1 : d + 1]), np.zeros((d, d))
        if n:
            for (i, j), value in zip(pairs, found[d + 1 :]):
                q[i, j] = q[j, i] = value
            out[str(r)] = Moments(n, whole.mean + s / n, q / n - np.outer(s / n, s / n))
    return out


def learning_curve(
    estimator: Estimator, df: DataFrame, key: Sequence[str], sizes: Sequence[int], fold: str, n: int, evaluator: Evaluator, seed: int = 0
) -> DataFrame:
    """Train and held-out score by training size: (size, fold, train, test). The first ``size`` rows
    are taken in hashed order of the whole row key, so smaller training sets are nested in larger ones."""
    data = df.withColumn("_h", hs.hash_hex(F.concat_ws(":", *key), seed)).persist()

    def one(size, i):
        rest, hit = prep.fold_split(data, fold, i)
        part = rest.orderBy("_h", *key).limit(size)
        model = estimator.fit(part)
        return [(size, i, float(evaluator.evaluate(model.transform(part))), float(evaluator.evaluate(model.transform(hit))))]

    rows = _run(df.sparkSession, [lambda s=s, i=i: one(s, i) for s in sizes for i in range(n)])
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "size int, fold int, train double, test double")


def degree_curve(train: DataFrame, test: DataFrame, y: str, x: str, degrees: Sequence[int]) -> DataFrame:
    """Train and test squared error of polynomials of growing degree, one pass per side: the moments
    of the highest degree contain those of all lower ones."""
    top = max(degrees)
    columns = [y, *["*".join(t) for t in prep.poly_terms([x], top)]]
    a = column_moments(prep.poly(train.select(y, x), [x], top), columns)
    b = column_moments(prep.poly(test.select(y, x), [x], top), columns)

    def cut(m: Moments, d: int) -> Moments:
        return Moments(m.n, m.mean[: d + 1], m.cov[: d + 1, : d + 1])

    rows = []
    for d in degrees:
        fit = li.from_moments(cut(a, d), columns[1 : d + 1])
        rows.append((d, _mse(fit, cut(a, d)) * a.n, _mse(fit, cut(b, d)) * b.n))
    return train.sparkSession.createDataFrame(rows, "degree int, train_error double, test_error double")


def training_history(model) -> DataFrame:
    """Objective per iteration of a fitted Spark model."""
    from pyspark.sql import SparkSession

    values = model.summary.objectiveHistory
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return SparkSession.getActiveSession().createDataFrame(rows, "iteration int, objective double")


def regression_score(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return me.reg_metrics(pred, label, prediction)
