"""Preparation: encoding, imputation, scaling, expansion, splits and folds.

Every random choice is a hash of (seed, row key): see ``functions.hashing``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions import arrays as ar
from lodestat.functions import hashing as hs
from lodestat.operators import joins as jo
from lodestat.operators.rows import rank_within, split_where, with_row_id

MAX_CATEGORIES = 1_000  # one-hot makes one column per value


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a nominal column; refuses a column that is not nominal."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} values")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """One 0/1 column per value, named ``column=value``; ``drop_first`` leaves out the base value."""
    added = []
    for c in columns:
        for v in categories(df, c)[1 if drop_first else 0 :]:
            added.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}={v}"))
    return df.select("*", *added)


def one_hot_label(df: DataFrame, column: str, width: int, name: str) -> DataFrame:
    """Fixed-width 0/1 vector of an integer label."""
    places = F.sequence(F.lit(0), F.lit(width - 1))
    return df.withColumn(name, F.transform(places, lambda i: (i == F.col(column)).cast("int")))


def _mode(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.col("_n").desc(), column).limit(1).select(column)


def impute(df: DataFrame, numeric: Sequence[str] = (), nominal: Sequence[str] = (), strategy: str = "average") -> DataFrame:
    """``average``: mean for numeric and most frequent value for nominal columns (ties by order);
    ``drop``: remove rows with a missing value in any of the columns."""
    if strategy == "drop":
        return df.dropna(subset=[*numeric, *nominal])
    if strategy != "average":
        raise ValueError(f"unknown strategy {strategy}")
    filled = {c: F.coalesce(F.col(c).cast("double"), df.agg(F.avg(c)).scalar()) for c in numeric}
    filled |= {c: F.coalesce(F.col(c), _mode(df, c).scalar()) for c in nominal}
    return df.withColumns(filled)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    out = {}
    for c in columns:
        mean, std = df.agg(F.avg(c)).scalar(), df.agg(F.stddev_pop(c)).scalar()
        out[c] = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / F.nullif(std, F.lit(0.0)))
    return df.withColumns(out)


def rescale(df: DataFrame, column: str, divisor: float, name: str) -> DataFrame:
    """Vector divided by a constant."""
    return df.withColumn(name, F.transform(ar.doubles(F.col(column)), lambda x: x / divisor))


def poly_terms(columns: Sequence[str], degree: int) -> list[tuple[str, ...]]:
    return [t for d in range(1, degree + 1) for t in combinations_with_replacement(columns, d)]


def poly(df: DataFrame, columns: Sequence[str], degree: int, bias: bool = False) -> DataFrame:
    """All monomials up to ``degree`` as columns named ``x``, ``x*x``, ``x*y`` ..., optional constant."""
    added = {}
    for term in poly_terms(columns, degree):
        if len(term) > 1:
            product = F.col(term[0]).cast("double")
            for c in term[1:]:
                product = product * F.col(c)
            added["*".join(term)] = product
    if bias:
        added["bias"] = F.lit(1.0)
    return df.withColumns(added) if added else df


# --- splits and folds --------------------------------------------------------------------------


def with_split(df: DataFrame, key: str, test_frac: float, seed: int, name: str = "is_test") -> DataFrame:
    return df.withColumn(name, hs.hash_below(key, seed, test_frac))


def split(df: DataFrame, key: str, test_frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test); no shuffle, each row decides for itself."""
    test, train = split_where(df, hs.hash_below(key, seed, test_frac))
    return train, test


def sample(df: DataFrame, key: str, frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Exactly round(frac * n) rows without replacement, and the remainder."""
    placed = with_row_id(df, [hs.hash_hex(key, seed), F.col(key)], "_row")
    size = F.round(placed.agg(F.count("*")).scalar() * F.lit(frac))
    taken, rest = split_where(placed, F.col("_row") < size)
    return taken.drop("_row"), rest.drop("_row")


def even_part(row: Column, size: Column, n: int) -> Column:
    """Part 0..n-1 of a zero-based position when ``size`` rows are cut into n runs whose sizes
    differ by at most one, longer runs first."""
    small = F.floor(size / n)
    extra = size % n
    border = extra * (small + 1)
    tail = extra + F.floor((row - border) / F.greatest(small, F.lit(1)))
    return F.when(row < border, F.floor(row / (small + 1))).otherwise(tail).cast("bigint")


def folds(
    df: DataFrame, key: str, n: int, seed: int = 0, shuffle: bool = True, by: str | None = None, name: str = "fold"
) -> DataFrame:
    """Fold id 0..n-1 with sizes that differ by at most one: hashed order, key order when not
    shuffled, and evenly inside every label when ``by`` is given."""
    order = [hs.hash_hex(key, seed), F.col(key)] if shuffle else [F.col(key)]
    if by is not None:
        placed = rank_within(df, by, order, "_row")
        return placed.withColumn(name, even_part(F.col("_row"), F.col("_row_size"), n)).drop("_row", "_row_size")
    placed = with_row_id(df, order, "_row")
    size = placed.agg(F.count("*")).scalar()
    return placed.withColumn(name, even_part(F.col("_row"), size, n)).drop("_row")


def quick_folds(df: DataFrame, key: str, n: int, seed: int, name: str = "fold") -> DataFrame:
    """Fold id by hash alone: sizes are only near equal, but nothing is sorted or shuffled."""
    return df.withColumn(name, F.pmod(hs.hash_int(key, seed), F.lit(n)))


def fold_split(df: DataFrame, fold: str, i: int) -> tuple[DataFrame, DataFrame]:
    """(rest, fold i)."""
    hit, rest = split_where(df, F.col(fold) == i)
    return rest, hit


def split_by_group(df: DataFrame, column: str, cut: float) -> tuple[DataFrame, DataFrame]:
    """Whole entities on one side: (below the cut, from the cut on)."""
    return split_where(df, F.col(column) < cut)


def split_by_time(df: DataFrame, column: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """(up to the cut, after it)."""
    after, before = split_where(df, F.col(column) > F.lit(cut).cast(df.schema[column].dataType))
    return before, after


def split_half(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    placed = with_row_id(df, order, "_row")
    size = placed.agg(F.count("*")).scalar()
    first, second = split_where(placed, even_part(F.col("_row"), size, 2) == 0)
    return first.drop("_row"), second.drop("_row")


def rows_from_coo(df: DataFrame, i: str, j: str, v: str, width: int, name: str = "vector") -> DataFrame:
    """(row, column, value) triples to one ML sparse vector per row; repeated cells add up."""
    from lodestat.operators.corpus import sparse_vectors

    cells = df.groupBy(i, F.col(j).alias("pos")).agg(F.sum(v).alias("_value"))
    return sparse_vectors(cells, i, "_value", width).withColumnRenamed("vector", name)


def score_grid(df: DataFrame, x: str, y: str, pad: float, h: float) -> DataFrame:
    """Grid over the padded range of two columns with step h; the range is one aggregate, the grid
    is unfolded from that single row."""
    bounds = df.agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in (x, y) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    xs = ar.arange(F.col(f"{x}_lo") - pad, F.col(f"{x}_hi") + pad, h)
    ys = ar.arange(F.col(f"{y}_lo") - pad, F.col(f"{y}_hi") + pad, h)
    return jo.grid(bounds, xs, ys, x, y).select(x, y)
