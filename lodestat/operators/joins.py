"""Joins. Broadcasts happen only behind a size check; everything else is left to Catalyst and AQE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.session import broadcast_if_small


def lookup(words: DataFrame, dictionary: DataFrame, on: str = "word") -> DataFrame:
    """Keep the occurrences found in the dictionary, each once per occurrence."""
    return words.join(broadcast_if_small(dictionary), on, "inner")


def merge(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "inner")


def side_by_side(left: DataFrame, right: DataFrame, row: str) -> DataFrame:
    """Columns of both tables by row position; the shorter table is padded with nulls."""
    return left.join(right, row, "full")


def append_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All rows of ``left`` with the columns of ``right`` where the key is found."""
    return left.join(right, key, "left")


def matching_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "inner")


def keep_existing(df: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    return df.join(listing.select(key), key, "left_semi")


def keep_missing(df: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    return df.join(listing.select(key), key, "left_anti")


def grid(bounds: DataFrame, x: Column, y: Column, x_name: str, y_name: str) -> DataFrame:
    """Every combination of the values of two array expressions, by unfolding one row twice."""
    return bounds.select("*", F.explode(x).alias(x_name)).select("*", F.explode(y).alias(y_name))


def stacked_rows(*parts: DataFrame) -> DataFrame:
    """Append tables below each other by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def predictions(models: Mapping[str, object], test: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions of several fitted models side by side, one column per model, in one pass."""
    out = test
    scratch = ("rawPrediction", "probability", "prediction")
    for name, model in models.items():
        out = model.transform(out)
        out = out.withColumnRenamed("prediction", name).drop(*[c for c in scratch if c in out.columns])
    return out.select(*keep, *models)
