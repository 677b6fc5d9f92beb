"""Training order: every token sequence of a corpus gets a slot by a keyed permutation, and shards hold slots in order.

Sequences are numbered 0 .. N - 1; a balanced Feistel network over the next even power of two, walked until the value is
below N again, permutes the numbers. Slot s lies in shard s // shard_rows at byte (s % shard_rows) * stride, so a reader
can resume anywhere by arithmetic. The permutation needs nothing but the key and N.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.llm.batches import mix
from lodestat.llm.shared import written

LENGTH = 256  # tokens of a sequence
SHARD_ROWS = 8_192
ROUNDS = 4
PAD = 0xFFFF
SEQUENCE = "seq bigint, n_tokens bigint, record binary"


def slots(numbers: np.ndarray, total: int, key: int) -> np.ndarray:
    """The permutation of 0 .. total - 1, for an array of numbers."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = numbers.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> shift, x[todo] & low
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + np.uint64((key * ROUNDS + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & low)
        x[todo] = (left << shift) | right
        todo = todo[x[todo] >= total]
    return x.astype(np.int64)


def _cut(length: int):
    """Task function: ids of a text to fixed-stride records, little-endian 16-bit, the last one padded."""

    def run(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                ids = part.column("ids")
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and (flat.max() >= PAD or flat.min() < 0):
                    raise ValueError(f"token ids must be below {PAD}")
                count = np.diff(ids.offsets.to_numpy())
                records = -(-count // length)
                out = np.full(int(records.sum()) * length, PAD, "<u2")
                start = (np.cumsum(records) - records) * length
                before = np.cumsum(count) - count
                out[np.arange(len(flat)) + np.repeat(start - before, count)] = flat
                raw = out.tobytes()
                text = np.repeat(np.arange(len(count)), records)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(records) - records, records)
                size = np.minimum(count[text] - piece * length, length)
                width = 2 * length
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(text)), pa.array(piece, pa.int64()), pa.array(size, pa.int64()), pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())],
                    names=["id", "seq", "n_tokens", "record"],
                )

    return run


def cutting(length: int = LENGTH):
    """``then`` of ``byte_bpe.encode``: the worker that encodes a text also cuts its ids to records of ``length`` tokens."""
    return _cut(length), SEQUENCE


def materialise(encoded: DataFrame, key: int, doc: str = "doc_id", length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, ids) to (id, seq, n_tokens, slot, shard, offset, record), each shard whole in one partition, in slot order.

    ``encoded`` may have been cut to the same ``length`` already: (id, seq, n_tokens, record), see ``cutting``. ``record``
    has 2 * length bytes. A document without tokens (null or empty ids) has no sequence; a repeated row gives its sequences
    again. Slots are 0 .. N - 1, each used once. Numbers follow the written table of sequences, so a lost executor changes
    nothing; another key gives another order.
    """
    spark = encoded.sparkSession
    kind = encoded.schema[doc].dataType.simpleString()
    if "ids" in encoded.columns:
        rows = encoded.filter(F.size("ids") > 0).select(F.col(doc).alias("id"), "ids")
        sequences = rows.mapInArrow(_cut(length), f"id {kind}, {SEQUENCE}")
    else:
        sequences = encoded.select(F.col(doc).alias("id"), "seq", "n_tokens", "record")
    placed = written(
        sequences.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "sequences", texts=True,
    )
    # one row per task of the scan
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).collect()[0][0]

    @F.pandas_udf("bigint")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(slots(number.to_numpy(), total, key), index=number.index)

    numbered = placed.join(F.broadcast(starts), "part").select("id", "seq", "n_tokens", "record", slot(F.col("start") + F.col("place")).alias("slot"))
    shard = F.floor(F.col("slot") / shard_rows)
    shards = max(1, -(-total // shard_rows))
    return (
        numbered.withColumn("shard", shard).withColumn("offset", (F.col("slot") % shard_rows) * (2 * length))
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("slot")
        .select(F.col("id").alias(doc), "seq", "n_tokens", "slot", "shard", "offset", "record")
    )


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write one file ``shard-<number>.bin`` per shard into a shared folder; returns (shard, rows, bytes).

    A task writes under a name of its own and renames at the end, so a repeated task leaves the same whole file. Bytes of a
    shard are collected record by record, never whole.
    """

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        out, shard, rows, size = None, None, 0, 0

        def close():
            out.close()
            store.move(name, f"{base}/shard-{shard:08d}.bin")
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([rows]), pa.array([size])], names=["shard", "rows", "bytes"])

        import uuid

        for batch in batches:
            for own, record in zip(batch.column("shard").to_pylist(), batch.column("record").to_pylist()):
                if own != shard:
                    if out is not None:
                        yield close()
                    shard, rows, size, name = own, 0, 0, f"{base}/.part-{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                out.write(record)
                rows, size = rows + 1, size + len(record)
        if out is not None:
            yield close()

    return ordered.select("shard", "record").mapInArrow(run, "shard bigint, rows bigint, bytes bigint")
