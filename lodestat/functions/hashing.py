"""Seeded, engine-independent pseudo-random values derived from row keys.

``rand()`` depends on how rows are partitioned; a hash of (seed, key) does not, so every split,
fold and sample below gives the same rows after a retry or a repartition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    from _md5 import md5  # the interpreter's own: half the time of a short text under hashlib's OpenSSL context
except ImportError:
    from hashlib import md5

UNIT_RANGE = 2**32


def _key(key: str | Column) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def hash_hex(key: str | Column, seed: int) -> Column:
    """A 32-character hash text, usable as a random sort key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _key(key)))


def hash_int(key: str | Column, seed: int) -> Column:
    """Uniform integer in [0, 2**32)."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_unit(key: str | Column, seed: int) -> Column:
    """Uniform double in [0, 1)."""
    return hash_int(key, seed) / F.lit(float(UNIT_RANGE))


def hash_below(key: str | Column, seed: int, frac: float) -> Column:
    """``hash_unit(key, seed) < frac`` without turning the hash into a number: fixed-width hex text
    sorts like the number it spells."""
    if frac >= 1.0:
        return F.lit(True)
    return F.substring(hash_hex(key, seed), 1, 8) < F.lit(f"{math.ceil(frac * UNIT_RANGE):08x}")


def drawn_below(keys: Sequence[str | None], seeds: Sequence[int], frac: float) -> np.ndarray:
    """``hash_below`` of many keys (texts) under many seeds inside a task: a (keys, seeds) matrix. A null key is never drawn."""
    if frac >= 1.0:
        return np.ones((len(keys), len(seeds)), bool)
    starts = [f"{seed}:".encode() for seed in seeds]
    texts = [(key or "").encode() for key in keys]
    first = np.frombuffer(b"".join([md5(start + text).digest()[:4] for text in texts for start in starts]), ">u4")
    there = np.array([key is not None for key in keys], bool)
    return (first < math.ceil(frac * UNIT_RANGE)).reshape(len(keys), len(seeds)) & there[:, None]
