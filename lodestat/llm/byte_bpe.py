"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that overlap by ``OVERLAP`` characters; each chunk is pre-tokenised on its own, in
parallel. Two neighbouring chunks agree from the first pre-token boundary on that both find in their overlap and that lies
between a visible character and white space: no match of the pattern goes over such a place, wherever the scan began. The
text between two such places is a piece; pieces are encoded on their own, and their ids put together again. Chunks whose
overlap has no such place are joined to one piece. A text of at most one chunk is one piece.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.llm.batches import slabs

CHUNK = 32_768
OVERLAP = 1_024


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def _texts_to_ids(ranks: str, pattern: str):
    """Task function: the column ``text`` gives way to ``ids``, a slab of texts at a time."""

    def run(batches):
        encoding = _encoding(ranks, pattern)
        for slab in slabs(batches, "text"):
            at = slab.schema.get_field_index("text")
            ids = [np.array(encoding.encode_ordinary(t), np.int32) for t in pc.fill_null(slab.column(at), "").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            kept = [slab.column(i) for i in range(slab.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, column], names=[n for n in slab.schema.names if n != "text"] + ["ids"])

    return run


def _chunks(pattern: str, chunk: int, overlap: int):
    """Task function: overlapping chunks of each text."""

    def run(batches):
        for slab in slabs(batches, "text"):
            texts, at = slab.column("text").to_pylist(), slab.schema.get_field_index("text")
            for row, text in enumerate(texts):
                starts = list(range(0, max(len(text), 1), chunk))
                for part in range(0, len(starts), 64):
                    own = starts[part : part + 64]
                    kept = [pa.repeat(slab.column(i)[row], len(own)) for i in range(slab.num_columns) if i != at]
                    cut = [text[s : s + chunk + overlap] for s in own]
                    core = [min(chunk, len(x)) for x in cut]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array(range(part, part + len(own)), pa.int32()), pa.array(own, pa.int64()), pa.array(core, pa.int64()), pa.array(cut, pa.string())],
                        names=[n for n in slab.schema.names if n != "text"] + ["no", "start", "core", "text"],
                    )

    return run


def _boundaries(pattern: str, overlap: int):
    """Task function: safe boundaries (character positions in the text) in both overlaps of each chunk."""
    import regex

    def run(batches):
        compiled = regex.compile(pattern)

        def safe(text: str, begin: int, low: int, high: int) -> list[int]:
            found = []
            for m in compiled.finditer(text, begin):
                p = m.end()
                if p > high or p >= len(text):
                    break
                if p >= low and text[p] in " \t\n\r" and not text[p - 1].isspace():
                    found.append(p)
            return found

        for slab in slabs(batches, "text"):
            heads, tails = [], []
            for text, start, core in zip(*(slab.column(c).to_pylist() for c in ("text", "start", "core"))):
                heads.append([start + p for p in safe(text, 0, 0, overlap)] if start else [0])
                tails.append([start + p for p in safe(text, max(0, core - overlap), core, len(text))])
            yield pa.RecordBatch.from_arrays(
                [*slab.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=[*slab.schema.names, "head", "tail"],
            )

    return run


def pieces(docs: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key columns, text) to (key columns, piece, text): the same text in pieces that end at pre-token boundaries."""
    keys = [c for c in docs.columns if c != "text"]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keys)
    docs = docs.select(*keys, "text")
    # the chunks of one text are dealt out evenly before the work on them begins
    chunks = docs.mapInArrow(_chunks(pattern, chunk, overlap), kinds + "no int, start bigint, core bigint, text string").repartition(*keys, "no")
    found = chunks.mapInArrow(_boundaries(pattern, overlap), kinds + "no int, start bigint, core bigint, text string, head array<bigint>, tail array<bigint>")
    order = W.partitionBy(*keys).orderBy("no")
    meet = F.when(F.col("no") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(order))))
    runs = found.withColumn("meet", meet).withColumn("run", F.count("meet").over(order.rowsBetween(W.unboundedPreceding, 0)))
    # all but the last chunk of a run give their own part only, the last one its overlap too
    last = F.coalesce(F.lead("run").over(order) != F.col("run"), F.lit(True))
    part = F.when(last, F.col("text")).otherwise(F.substring("text", F.lit(1), F.lit(chunk)))
    joined = (
        runs.withColumn("part", part)
        .groupBy(*keys, "run")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "part"))), lambda x: x["part"]), "").alias("all"), F.min("start").alias("from"), F.max("meet").alias("meet"))
    )
    end = F.lead("meet").over(W.partitionBy(*keys).orderBy("run"))
    skip = F.col("meet") - F.col("from")
    size = F.coalesce(end - F.col("meet"), F.length("all") - skip)
    return joined.withColumn("text", F.substring("all", (skip + 1).cast("int"), size.cast("int"))).select(*keys, F.col("run").alias("piece"), "text")


def encode(
    docs: DataFrame, ranks: str, pattern: str, doc: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
    then: tuple[Callable, str] | None = None,
) -> DataFrame:
    """(id, ids array<int>): token ids of each whole text, without special tokens.

    ``ranks`` is the path of a rank file that every worker can read. Null text is the empty text, which has no ids. One
    row per input row: repeated rows stay repeated (a long text that is repeated is encoded once). Special strings in a
    text are ordinary text.

    ``then``: a task function on batches of (id, ids), and the columns that it returns beside the id. It runs in the
    worker that encodes, so that a task has one Python worker and the ids of a short text don't leave it.
    """
    own = _texts_to_ids(ranks, pattern)
    step, columns = then or (None, "ids array<int>")
    rows = docs.select(F.col(doc).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[doc].dataType.simpleString()
    short = rows.filter(F.length("text") <= chunk).mapInArrow((lambda batches: step(own(batches))) if step else own, f"id {kind}, {columns}")
    long = rows.filter(F.length("text") > chunk).withColumn("key", F.xxhash64("text"))
    once = long.groupBy("id", "key").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    ids = (
        pieces(once, pattern, chunk, overlap)
        .mapInArrow(own, f"id {kind}, key bigint, copies bigint, piece bigint, ids array<int>")
        .groupBy("id", "key", "copies")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
        .select("id", "ids", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("id", "ids")
    )
    if step:
        ids = ids.mapInArrow(step, f"id {kind}, {columns}")
    return short.unionByName(ids).withColumnRenamed("id", doc)


def _ids_to_bytes(ranks: str, pattern: str):
    def run(batches):
        encoding = _encoding(ranks, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                at = part.schema.get_field_index("ids")
                ids = part.column(at).to_pylist()
                raw = [encoding.decode_bytes(x) if x is not None else b"" for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Adds ``decoded``: the raw bytes of all ids of a row put together, before anything is made of them. Null ids: no bytes."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_ids_to_bytes(ranks, pattern), f"{kinds}, decoded binary")


def _digest(ranks: str, pattern: str, keep: str):
    import hashlib

    def run(batches):
        encoding = _encoding(ranks, pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                ids = pc.fill_null(part.column("ids"), pa.scalar([], part.column("ids").type)) if part.column("ids").null_count else part.column("ids")
                texts = pc.binary_join(ids.cast(pa.list_(pa.string())), " ")
                raw = [encoding.decode_bytes(x) for x in ids.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(keep), pc.list_value_length(ids).cast(pa.int64()),
                        pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in texts], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    ],
                    names=[keep, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def digests(encoded: DataFrame, ranks: str, pattern: str, doc: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids in decimal, joined by spaces, and of the bytes that
    they decode to, without moving either."""
    kind = encoded.schema[doc].dataType.simpleString()
    return encoded.select(doc, "ids").mapInArrow(_digest(ranks, pattern, doc), f"`{doc}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
