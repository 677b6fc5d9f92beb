"""Lasso on a sparse design given as cells (row, column, value), with an unpenalised intercept.

Minimises |y - b - Xw|^2 / (2n) + alpha |w|_1, the objective of ``LinearRegression(elasticNetParam=1, standardization=False)``.

The design is never densified and never centred in place: column means enter the sums as corrections. The work is:

- the cells are packed to one record per row, with its target, and written once; a record is bounded by the columns;
- one pass for each column's sum, sum of squares and cross product with y, which gives the first gradient;
- screening: of the columns whose gradient passes the strong rule (|g_j| >= 2 alpha - lambda_max), the ones of largest
  gradient enter the working set. Where the penalty is far below lambda_max the rule leaves out nothing, so the first set
  and its growth in a round are bounded: a set is as large as the solution asks for, not as the dictionary;
- coordinate descent on the working set through its centred Gram matrix (covariance updates), on the driver, whose size is
  that of the working set, never that of the rows. New columns bring only their own rows of the matrix, each task adding up
  GRAM_BLOCK of them at a time;
- a check of the optimality conditions on every column: each task makes the residuals of its rows and their products with all
  columns. Of the columns that break the conditions the worst join the working set, and the round is repeated until none does.

The result is the exact lasso solution to the tolerance, not an approximation on a subset of columns. Rows without cells
count as rows of zeros; a column without cells or with zero variance keeps weight 0; an empty table gives no weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import cut_lineage

WORKING_LIMIT = 20_000  # largest working set whose Gram matrix the driver holds (3.2 GB at the limit); beyond it: error
GROW = 200  # columns that may join the working set in a round, or as many as have a weight
GRAM_BLOCK = 512  # rows of the Gram matrix that a task adds up at a time
DENSE_CELLS = 4_000_000  # cells of the working columns that a task unpacks at a time


@dataclass
class SparseLasso:
    weights: dict[int, float]  # column -> non-zero weight
    intercept: float
    rounds: int
    working: int

    def table(self, spark) -> DataFrame:
        rows = sorted(self.weights.items())
        return spark.createDataFrame(rows, "pos bigint, estimate double")


def descend(gram: np.ndarray, corr: np.ndarray, alpha_n: float, w: np.ndarray, tol: float = 1e-10, sweeps: int = 100_000) -> np.ndarray:
    """Coordinate descent by covariance updates: minimises w'Gw/2 - corr'w + alpha_n |w|_1 (all sums, not means).

    Columns with a weight are swept until they rest, then all columns once; it ends when a sweep over all changes no more than
    ``tol`` or the noise of the sums. Columns much alike rest slowly, so every few sweeps the equations for the present
    columns and signs are solved at once; the solution stands if it keeps the signs.
    """
    w = w.copy()
    diag = np.diag(gram).copy()
    grad = corr - gram @ w
    live = np.flatnonzero(diag > 1e-12)
    root = np.sqrt(np.maximum(diag, 0.0))
    tol = max(tol, 1e-13 * float((np.abs(corr[live]) / root[live]).max())) if len(live) else tol

    def sweep(columns) -> float:
        largest = 0.0
        for j in columns.tolist():
            old = float(w[j])
            rho = float(grad[j]) + diag[j] * old
            new = (rho - alpha_n if rho > alpha_n else rho + alpha_n if rho < -alpha_n else 0.0) / diag[j]
            if new != old:
                grad[:] -= gram[j] * (new - old)  # the matrix is symmetric and its rows are contiguous
                w[j] = new
                largest = max(largest, abs(new - old) * root[j])
        return largest

    left = sweeps
    while left > 0:
        left -= 1
        if sweep(live) <= tol:
            break
        some = np.flatnonzero(w)
        for turn in range(left):
            left -= 1
            if sweep(some) <= tol:
                break
            if turn % 10 == 9:
                some = np.flatnonzero(w)
                sign = np.sign(w[some])
                solved = np.linalg.lstsq(gram[np.ix_(some, some)], corr[some] - alpha_n * sign, rcond=None)[0]
                if (np.sign(solved) == sign).all():
                    w[some] = solved
                    grad[:] = corr - gram @ w
                    break
    return w


def fit(cells: DataFrame, targets: DataFrame, alpha: float, row: str = "doc_id", col: str = "pos", val: str = "cnt", y: str = "y", tol: float = 1e-10) -> SparseLasso:
    """Lasso of ``targets``.``y`` (one row per ``row``) on the cells; cells of rows without a target are ignored."""
    targets = targets.select(F.col(row).alias("r"), F.col(y).cast("double").alias("y")).filter(F.col("y").isNotNull())
    n, total = targets.agg(F.count("*"), F.sum("y")).first()
    if not n:
        return SparseLasso({}, 0.0, 0, 0)
    rows = _packed(cells.select(F.col(row).alias("r"), F.col(col).cast("long").alias("c"), F.col(val).cast("double").alias("v")), targets)
    ybar = total / n
    flat = rows.select("y", F.inline(F.arrays_zip("c", "v")))
    stats = flat.groupBy("c").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.sum(F.col("v") * F.col("y")).alias("xy"))
    stats = stats.orderBy("c").collect()  # one row per column: the size of the feature set
    cols = np.array([r["c"] for r in stats], np.int64)
    mean = np.array([r["s"] for r in stats]) / n
    var = np.array([r["q"] for r in stats]) - n * mean * mean
    corr = np.array([r["xy"] for r in stats]) - n * mean * ybar  # centred x'y
    lam_max = float(np.abs(corr).max()) / n if len(cols) else 0.0
    if lam_max <= alpha:
        return SparseLasso({}, ybar, 0, 0)
    first = sorted(_first_working(corr, var, n, alpha, lam_max), key=lambda j: (-abs(corr[j]), j))[:GROW]
    index, gram = np.array([], np.int64), np.zeros((0, 0))
    joining = np.array(first, np.int64)
    w = np.zeros(len(cols))
    rounds = 0
    while True:
        rounds += 1
        if len(index) + len(joining) > WORKING_LIMIT:
            raise ValueError(f"working set of {len(index) + len(joining)} columns exceeds {WORKING_LIMIT}")
        index, gram = _grown(rows, cols, mean, n, index, gram, joining)
        w[index] = descend(gram, corr[index], n * alpha, w[index], tol)
        grad = _gradients(rows, cols, mean, w, ybar, n)
        broken = np.flatnonzero((np.abs(grad) > alpha * (1 + 1e-9)) & (var > 1e-12) & (w == 0))
        broken = np.setdiff1d(broken, index)
        if not len(broken):
            break
        most = max(GROW, int(np.count_nonzero(w)))
        joining = broken[np.argsort(-np.abs(grad[broken]), kind="stable")[:most]]
    nonzero = np.flatnonzero(w)
    intercept = ybar - float(mean[nonzero] @ w[nonzero])
    return SparseLasso({int(cols[j]): float(w[j]) for j in nonzero}, intercept, rounds, len(index))


def _first_working(corr: np.ndarray, var: np.ndarray, n: int, alpha: float, lam_max: float) -> set[int]:
    """The strong rule from the largest penalty: columns that may be active at ``alpha``."""
    return set(np.flatnonzero((np.abs(corr) / n >= 2 * alpha - lam_max) & (var > 1e-12)).tolist())


def _packed(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """One record (y, c, v) per row that has cells, the columns ascending; written once, as every round reads it."""
    cells = cells.groupBy("r", "c").agg(F.sum("v").alias("v")).filter(F.col("c").isNotNull() & F.col("v").isNotNull())
    packed = cells.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("e"))
    return cut_lineage(packed.join(targets, "r").select("y", F.col("e.c").alias("c"), F.col("e.v").alias("v")))


def _arrays(batch: pa.RecordBatch, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's cells: the row in the batch, the place in ``cols`` (ascending; -1 if not among them), the value."""
    sizes = batch.column("c").value_lengths().to_numpy(zero_copy_only=False)
    c = batch.column("c").flatten().to_numpy(zero_copy_only=False)
    v = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(cols, c), len(cols) - 1)
    return np.repeat(np.arange(batch.num_rows), sizes), np.where(cols[at] == c, at, -1), v


def _grown(
    rows: DataFrame, cols: np.ndarray, mean: np.ndarray, n: int, index: np.ndarray, gram: np.ndarray, joining: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The working columns (ascending) and their centred Gram matrix after ``joining`` came in."""
    after = np.sort(np.concatenate([index, joining]))
    out = np.zeros((len(after), len(after)))
    old = np.searchsorted(after, index)
    out[np.ix_(old, old)] = gram
    new = np.sort(np.searchsorted(after, joining))
    for begin in range(0, len(new), GRAM_BLOCK):
        part = new[begin : begin + GRAM_BLOCK]
        sums = _products(rows, cols[after], part) - n * np.outer(mean[after[part]], mean[after])
        out[part] = sums
        out[:, part] = sums.T
    return after, out


def _products(rows: DataFrame, chosen: np.ndarray, part: np.ndarray) -> np.ndarray:
    """X_part'X over the chosen columns: every task adds up its rows, a bounded number of them unpacked at a time."""
    step = max(1, DENSE_CELLS // len(chosen))

    def partial(batches):
        acc = None
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                piece = batch.slice(begin, step)
                r, at, v = _arrays(piece, chosen)
                known = at >= 0
                dense = np.zeros((piece.num_rows, len(chosen)))
                dense[r[known], at[known]] = v[known]
                got = dense[:, part].T @ dense
                acc = got if acc is None else acc + got
        if acc is not None:
            for i, line in enumerate(acc):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(line), i)), pa.array(np.arange(len(line))), pa.array(line)], names=["i", "j", "g"])

    sums = rows.select("c", "v").mapInArrow(partial, "i bigint, j bigint, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    out = np.zeros((len(part), len(chosen)))
    out[sums.column("i").to_numpy(), sums.column("j").to_numpy()] = sums.column("g").to_numpy()
    return out


def _gradients(rows: DataFrame, cols: np.ndarray, mean: np.ndarray, w: np.ndarray, ybar: float, n: int) -> np.ndarray:
    """x~_j' r / n for every column, r the centred residual, made in the task that holds the row."""
    shift = float(mean @ w) - ybar

    def partial(batches):
        acc = np.zeros(len(cols))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            r, at, v = _arrays(batch, cols)  # every column of a cell is in ``cols``
            fitted = np.bincount(r, v * w[at], batch.num_rows)
            e = batch.column("y").to_numpy(zero_copy_only=False) + shift - fitted
            acc += np.bincount(at, v * e[r], len(cols))
        here = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(acc[here])], names=["j", "g"])

    sums = rows.mapInArrow(partial, "j bigint, g double").groupBy("j").agg(F.sum("g").alias("g")).toArrow()  # one row per column
    grad = np.zeros(len(cols))
    grad[sums.column("j").to_numpy()] = sums.column("g").to_numpy() / n  # the residual sums to zero, so the column mean adds nothing
    return grad
