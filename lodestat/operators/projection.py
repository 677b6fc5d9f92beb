"""Random projection of sparse word vectors, and the two-class regression built on it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_lists
from lodestat.operators import corpus as co
from lodestat.operators.moments import gram_matrices

PRIME = 2_147_483_647
FAMILIES = ("gaussian", "sign")


def sign_matrix(positions: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """+1/-1 entries (Achlioptas 2003) from integer arithmetic on (position, column, seed); the same
    arithmetic can be written in SQL, so this family is checked exactly."""
    base = positions.astype(np.int64)[:, None] * 7919 + np.arange(dim, dtype=np.int64)[None, :] * 104_729 + seed * 1_299_709
    x = (base + 12_345) % PRIME
    x = (x * x) % PRIME
    x = (x * x + base) % PRIME
    return np.where((x // 8) % 2 == 0, 1.0, -1.0)


def gaussian_matrix(positions: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """Standard normal rows, each seeded by its own position."""
    return np.array([np.random.default_rng((seed, int(p))).standard_normal(dim) for p in positions]).reshape(-1, dim)


def random_projection(
    values: DataFrame, doc: str, value: str, dim: int, seed: int, family: str = "gaussian"
) -> DataFrame:
    """(doc, pos, value) rows to one dense vector of length ``dim`` per document.

    The matrix is never shipped: a task makes the row of a dictionary position when it first meets
    that position. A document's own entries are bounded by the dictionary, so packing them is safe.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family}")
    keys = [doc]
    packed = values.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("pos").cast("long").alias("p"), F.col(value).cast("double").alias("v")))).alias("e")
    ).select(*keys, F.col("e.p").alias("_p"), F.col("e.v").alias("_v"))
    make = gaussian_matrix if family == "gaussian" else sign_matrix

    def project(batches):
        slot_of = np.full(1024, -1, dtype=np.int64)  # dictionary position -> row of ``matrix``
        matrix, used = np.zeros((1024, dim)), 0
        for batch in batches:
            p, v = batch.column(len(keys)), batch.column(len(keys) + 1)
            flat = p.flatten().to_numpy(zero_copy_only=False)
            weights = v.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and flat.max() >= len(slot_of):
                slot_of = np.concatenate([slot_of, np.full(flat.max() + 1, -1, dtype=np.int64)])
            present = np.unique(flat)
            unseen = present[slot_of[present] < 0]
            if len(unseen):
                if used + len(unseen) > len(matrix):
                    matrix = np.vstack([matrix, np.zeros((len(matrix) + len(unseen), dim))])
                matrix[used : used + len(unseen)] = make(unseen, dim, seed)
                slot_of[unseen] = np.arange(used, used + len(unseen))
                used += len(unseen)
            slots = slot_of[flat]
            lengths = p.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            out = np.zeros((batch.num_rows, dim))
            for r, (a, b) in enumerate(zip(ends - lengths, ends)):
                out[r] = weights[a:b] @ matrix[slots[a:b]]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keys))], as_lists(out)], names=[*keys, "vector"]
            )

    types = ", ".join(f"{k} {values.schema[k].dataType.simpleString()}" for k in keys)
    return packed.mapInArrow(project, f"{types}, vector array<double>")


@dataclass(frozen=True)
class TopicFit:
    weights: np.ndarray
    dim: int
    seed: int
    family: str


def topic_regression(
    values: DataFrame, doc: str, value: str, labels: DataFrame, label: str, positive: list[str], dim: int, seed: int,
    family: str = "gaussian",
) -> TopicFit:
    """Least squares on projected vectors against +1/-1 targets, without intercept: one Gram pass
    over [target, vector], one small solve (pseudo-inverse when the Gram matrix is singular).
    ``labels`` has one row (doc, label) per document."""
    vectors = random_projection(values, doc, value, dim, seed, family)
    targets = labels.select(doc, co.target(F.col(label), positive).alias("_target"))
    joined = vectors.join(targets, doc)
    (g,) = gram_matrices(joined, F.concat(F.array("_target"), F.col("vector"))).values()
    return TopicFit(np.linalg.pinv(g[1:, 1:], hermitian=True) @ g[1:, 0], dim, seed, family)


def predict_topic(queries: DataFrame, fit: TopicFit, query: str, yes: str, no: str) -> DataFrame:
    """Score and answer text of each query given as (query, pos, weight)."""
    vectors = random_projection(queries, query, "weight", fit.dim, fit.seed, fit.family)
    weights = F.array(*[F.lit(float(w)) for w in fit.weights])
    score = F.aggregate(F.zip_with("vector", weights, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return vectors.select(query, score.alias("score")).withColumn("answer", F.when(F.col("score") > 0, yes).otherwise(no))
