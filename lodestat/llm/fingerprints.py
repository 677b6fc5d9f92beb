"""Document fingerprints by locally consistent parsing.

The bytes of a text are parsed bottom-up. On each level runs of one symbol become one symbol, deterministic coin tossing
(the lowest bit in which neighbours differ, three times) gives small labels that differ between neighbours, and places whose
label is a local maximum begin a phrase. A phrase's name is a hash of its symbols, and names are the next level's symbols.
Whether a place begins a phrase depends on a bounded neighbourhood, so equal substrings get the same phrases inside,
wherever they stand. A fingerprint keeps, for each of ``SLOTS`` parts of the range of names, 16 bits of the smallest name
of all levels from ``FIRST`` on; the share of equal slots estimates the share of common phrases.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.llm.batches import mix, odd_constants, slabs, text_bytes

SLOTS = 128
FIRST = 3
MOST_RANGES = 20_000
RANGE_ROWS = 1_000


def _tosses(bits: int) -> np.ndarray:
    """Table (previous, own) to label, for symbols of ``bits`` bits."""
    a, b = np.meshgrid(np.arange(1 << bits), np.arange(1 << bits), indexing="ij")
    different = a ^ b
    low = np.bitwise_count((different & -different) - 1) % 64
    return (2 * low + ((b >> low) & 1)).astype(np.uint8).ravel()


_SECOND, _THIRD = _tosses(7), _tosses(4)
_POWERS = odd_constants(64, 3)


def _previous(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol before; before a text's first one, a symbol that differs from it in the lowest bit."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[starts] = x[starts] ^ x.dtype.type(1)
    return out


def _level(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level and where each text begins among them; no text is empty."""
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    fresh[starts] = True
    at = np.flatnonzero(fresh)
    if len(at) < len(x):
        run = np.diff(np.append(at, len(x))).astype(np.uint64)
        starts = np.searchsorted(at, starts)
        x = x[at]
        x = np.where(run > 1, mix(x + run * np.uint64(0xD6E8FEB86659FD93)), x)
    different = x ^ _previous(x, starts)
    low = np.bitwise_count((different & (~different + np.uint64(1))) - np.uint64(1)).astype(np.uint64) & np.uint64(63)
    label = ((low << np.uint64(1)) | ((x >> low) & np.uint64(1))).astype(np.uint8)
    label = _SECOND[(_previous(label, starts).astype(np.uint16) << 7) | label]
    label = _THIRD[(_previous(label, starts).astype(np.uint16) << 4) | label]
    begin = np.zeros(len(x), bool)
    begin[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begin[starts[1:] - 1] = False  # a text's last symbol
    begin[starts] = True
    phrase = np.flatnonzero(begin)
    length = np.diff(np.append(phrase, len(x)))
    place = np.arange(len(x)) - np.repeat(phrase, length)
    names = mix(np.add.reduceat(x * _POWERS[place & 63], phrase) + length.astype(np.uint64))
    return names, np.searchsorted(phrase, starts)


def sketch(column: pa.Array) -> list[str]:
    """Fingerprint text of each text: SLOTS times four hex digits, 0000 for a slot without a name."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), SLOTS), np.uint16)
    docs = np.flatnonzero(np.diff(offsets) > 0)
    names, owners = [], []
    x, starts, level = odd_constants(256, 5)[data], offsets[docs], 0
    while len(docs):
        x, starts = _level(x, starts)
        level += 1
        size = np.diff(np.append(starts, len(x)))
        if level < FIRST:
            continue
        names.append(x)
        owners.append(np.repeat(docs, size))
        more = size > 1
        x, docs, size = x[np.repeat(more, size)], docs[more], size[more]
        starts = np.cumsum(size) - size
    if names:
        name, owner = np.concatenate(names), np.concatenate(owners)
        cell = owner * SLOTS + (name >> np.uint64(57)).astype(np.int64)
        order = np.lexsort((name, cell))
        cell, name = cell[order], name[order]
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        out.ravel()[cell[first]] = np.maximum((name[first] & np.uint64(0xFFFF)).astype(np.uint16), 1)
    hexes, width = out.astype(">u2").tobytes().hex(), SLOTS * 4
    return [hexes[i * width : (i + 1) * width] for i in range(len(column))]


def _sketches(columns: dict[str, str], keep: list[str]):
    def run(batches):
        widest = next(iter(columns))
        for slab in slabs(batches, widest):
            found = [pa.array(sketch(slab.column(c)), pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*(slab.column(c) for c in keep), *found], names=[*keep, *columns.values()])

    return run


def fingerprint(docs: DataFrame, columns: dict[str, str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and, for each text column, its fingerprint under the given name. One row per input row.

    Equal texts have equal fingerprints; null and empty texts have no name in any slot.
    """
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"`{n}` string" for n in columns.values()]
    wanted = docs.select(*dict.fromkeys([*keep, *columns]))
    return wanted.mapInArrow(_sketches(columns, keep), ", ".join(kinds))


def _compare(pairs: list[tuple[str, str, str]], keep: list[str]):
    def slots(column: pa.Array) -> np.ndarray:
        data, _ = text_bytes(column)
        return data.reshape(len(column), SLOTS, 4).copy().view(np.uint32)[:, :, 0]

    def run(batches):
        empty = np.frombuffer(b"0000", np.uint32)[0]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = []
            for a, b, _ in pairs:
                x, y = slots(batch.column(a)), slots(batch.column(b))
                either = ((x != empty) | (y != empty)).sum(1)
                same = ((x == y) & (x != empty)).sum(1)
                out.append(pa.array(np.where(either > 0, same / np.maximum(either, 1), 1.0)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], names=[*keep, *(n for _, _, n in pairs)])

    return run


def likeness(rows: DataFrame, pairs: list[tuple[str, str, str]], keep: list[str]) -> DataFrame:
    """For each (fingerprint, fingerprint, name): share of equal slots among those that either fills, 0 to 1; 1 for two
    fingerprints without any name. No fingerprint may be null."""
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep] + [f"`{n}` double" for _, _, n in pairs]
    return rows.mapInArrow(_compare(pairs, keep), ", ".join(kinds))


def with_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> tuple[DataFrame, W]:
    """Rows in ranges of ascending ids, with a copy of the next range's first row at each end, and the window over a range.

    Columns: range, id, text, own (false for the copy). The texts are shuffled once; ranges are cut at quantiles of the id,
    so no range holds most rows. The last range ends with the table's first row. Rows of equal id are ordered by text; null
    ids come first.
    """
    ids = docs.select(F.col(doc).alias("id"))
    rows = ids.count()
    parts = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    cuts = sorted(set(ids.na.drop().approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    edges = np.array(cuts)

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.fillna(-np.inf).to_numpy(dtype=float), side="right").astype(np.int32), index=x.index)

    placed = docs.select(place(F.col(doc)).alias("range"), F.col(doc).alias("id"), F.col(text).alias("text"))
    # one row per range: bounded by MOST_RANGES
    firsts = ids.select(place(F.col("id")).alias("range"), "id").groupBy("range").agg(F.min("id").alias("id")).orderBy("range").collect()
    heads = [(firsts[i - 1]["range"], r["id"]) for i, r in enumerate(firsts)]
    known = docs.sparkSession.createDataFrame(heads, f"target int, head {docs.schema[doc].dataType.simpleString()}")
    copies = (
        placed.join(F.broadcast(known), F.col("id").eqNullSafe(F.col("head")))
        .groupBy("target", "id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select(F.col("target").alias("range"), "id", "text", F.lit(False).alias("own"))
    )
    joined = placed.withColumn("own", F.lit(True)).unionByName(copies).repartition("range")
    return joined, W.partitionBy("range").orderBy(F.col("own").desc(), F.col("id").asc_nulls_first(), "text")


def next_in_range(doc: str, text: str):
    """The window of ``with_next`` for later steps on the same rows."""
    return W.partitionBy("range").orderBy(F.col("own").desc(), F.col(doc).asc_nulls_first(), text)
