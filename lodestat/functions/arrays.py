"""Array, map and numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x / y)


def less(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x < y)


def scale(a: Column, factor: float | Column) -> Column:
    return F.transform(a, lambda x: x * factor)


def dot(a: Column, b: Column) -> Column:
    return total(multiply(a, b))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def argmax(a: Column) -> Column:
    """Zero-based position of the first largest element."""
    return F.array_position(a, F.array_max(a)) - 1


def drop_last(a: Column) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def polyval(coefficients: Column, x: Column) -> Column:
    """Sum of c[i] * x**i."""
    terms = F.transform(coefficients, lambda c, i: c * F.pow(x, i))
    return total(terms)


def linspace(start: Column, stop: Column, num: int) -> Column:
    """``num`` evenly spaced values with both ends."""
    steps = F.sequence(F.lit(0), F.lit(num - 1))
    return F.transform(steps, lambda i: start + i * ((stop - start) / (num - 1)))


def logspace(start: Column, stop: Column, num: int) -> Column:
    return F.transform(linspace(start, stop, num), lambda e: F.pow(F.lit(10.0), e))


def arange(start: Column, stop: Column, step: float) -> Column:
    """start, start + step, ... below stop."""
    count = F.ceil((stop - start) / step).cast("int")
    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: start + i * step)


def map_get(m: Column, key: Column | str, default) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def floor_div(a: Column, b: Column) -> Column:
    return F.floor(a / b)


def array_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
