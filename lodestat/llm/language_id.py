"""Language identification with a blended-spectrum string kernel.

Two texts are as similar as the byte n-grams (n = 1 to 4, hashed to ``BUCKETS`` places) that both hold, divided by the root
of the product of their numbers of n-grams. Ridge regression, one language against the rest, is done in the space that
landmark texts span (Nyström). All texts are scored by matrix products of 0/1 presence blocks with the landmarks' weights;
the landmark matrix and the regression weights are multiplied first, as they are the same for all texts.

The model is fitted on at most ``SAMPLE`` labelled rows, about equally many of each language, chosen by a hash of the id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.batches import slabs, text_bytes

BUCKETS = 1 << 16
LONGEST = 4
SAMPLE = 2_000
LANDMARKS = 256
RIDGE = 1e-2
BLOCK_ROWS = 32
SLAB = 256 << 10  # bytes of text whose n-grams a task hashes at once; temporary arrays are some tens of times as large
UNPACKED = 2_048  # columns of the sample's presence matrix that the driver unpacks at a time
UNKNOWN = "und"


def presence(column: pa.Array) -> np.ndarray:
    """(texts, BUCKETS) matrix of 0 and 1: which hashed n-grams each whole lower-case text holds."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.string())))
    out = np.zeros((len(column), BUCKETS), np.uint8)
    flat, owner = out.reshape(-1), np.repeat(np.arange(len(column), dtype=np.int64) * BUCKETS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = np.zeros(len(data), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(data) < n:
            break
        size = len(data) - n + 1
        code = (code[:size] << np.uint32(8)) | data[n - 1 :]
        bucket = ((code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(16)).astype(np.int64)
        if n == 1:
            flat[owner + bucket] = 1
        else:
            whole = left[:size] >= n
            flat[(owner[:size] + bucket)[whole]] = 1
    return out


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages)


def _packed(batches):
    """Task function: (label, presence bits) of sample rows."""
    for slab in slabs(batches, "text", SLAB):
        for row in range(0, slab.num_rows, BLOCK_ROWS):
            part = slab.slice(row, BLOCK_ROWS)
            bits = np.packbits(presence(part.column("text")), axis=1)
            yield pa.RecordBatch.from_arrays([part.column("order"), part.column("label"), pa.array([b.tobytes() for b in bits], pa.binary())], names=["order", "label", "bits"])


def fit(labelled: DataFrame, doc: str, text: str, label: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on rows with a label and a letter in the text; no such row gives a model without languages.

    What reaches the driver is ``sample`` rows of BUCKETS bits, whatever the size of table or texts.
    """
    usable = labelled.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.xxhash64(F.col(doc).cast("string")).alias("order"), F.col(label).cast("string").alias("label"), F.col(text).alias("text")
    )
    sizes = usable.groupBy("label").agg(F.count("*").alias("rows"))
    languages = sizes.count()
    # a language's share of the sample; the hash threshold takes a little more, the limit below brings it back
    share = sizes.select("label", F.least(F.lit(1.0), F.lit(sample / max(languages, 1)) / F.col("rows")).alias("share"))
    unit = F.pmod("order", F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    # one row a language: no text moves to meet it
    share = F.broadcast(share) if languages <= 100_000 else share
    chosen = usable.join(share, "label").filter(unit < F.col("share")).drop("share").orderBy("order", "label").limit(sample)
    rows = chosen.mapInArrow(_packed, "order bigint, label string, bits binary").orderBy("order", "label", "bits").collect()
    names = sorted({r["label"] for r in rows})
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    # the bits stay packed: the driver only ever holds UNPACKED columns of them as numbers
    bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1)
    labels = [r["label"] for r in rows]
    del rows
    by_language = [[i for i, own in enumerate(labels) if own == n] for n in names]
    turn = [own[k] for k in range(max(map(len, by_language))) for own in by_language if k < len(own)]
    marks = np.array(sorted(turn[:landmarks]))
    shared, held = np.zeros((len(labels), len(marks)), np.float64), np.zeros(len(labels), np.int64)
    for at in range(0, BUCKETS, UNPACKED):
        part = _unpacked(bits, at)
        held += part.sum(1, dtype=np.int64)
        shared += part @ part[marks].T
    norm = np.sqrt(np.maximum(held, 1)).astype(np.float32)
    kernel = shared / norm[:, None] / norm[marks][None, :]
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    truth = np.where(np.array([names.index(own) for own in labels])[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    solved = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]), features.T @ truth)
    per_mark = ((root @ solved) / norm[marks][:, None]).astype(np.float32)
    weights = np.concatenate([_unpacked(bits[marks], at).T @ per_mark for at in range(0, BUCKETS, UNPACKED)])
    return Model(names, weights.astype(np.float32))


def _unpacked(bits: np.ndarray, at: int) -> np.ndarray:
    """Columns ``at`` to ``at + UNPACKED`` of packed presence rows as 0.0 and 1.0."""
    return np.unpackbits(bits[:, at // 8 : (at + UNPACKED) // 8], axis=1).astype(np.float32)


def _scored(model: Model, text: pa.Array) -> pa.StructArray:
    """(lang_pred, score) of each text; a few texts at a time, so that their presence block stays small."""
    best, value = np.zeros(len(text), np.int64), np.zeros(len(text))
    # always as many rows: a text's score doesn't hang on how many texts come with it
    block, at = np.zeros((BLOCK_ROWS, BUCKETS), np.float32), 0
    for part in slabs([pa.RecordBatch.from_arrays([text], names=["text"])], "text", SLAB):
        for row in range(0, part.num_rows if model.languages else 0, BLOCK_ROWS):
            own = part.column("text").slice(row, BLOCK_ROWS)
            block[: len(own)] = presence(own)
            scores = (block @ model.weights / np.sqrt(np.maximum(block.sum(1), 1))[:, None])[: len(own)]
            to = slice(at + row, at + row + len(own))
            best[to] = scores.argmax(1)
            value[to] = np.clip((scores.max(1) + 1) / 2, 0, 1)
        at += part.num_rows
    known = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False) & bool(model.languages)
    names = pa.array([*model.languages, UNKNOWN], pa.string()).take(pa.array(np.where(known, best, len(model.languages))))
    return pa.StructArray.from_arrays([names, pa.array(np.where(known, value, 0.0))], names=["lang_pred", "score"])


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) with lang_pred and score. A text that is null or without a letter is ``und``, score 0;
    so is every text when nothing was there to learn from. Equal scores go to the first language by name.

    Python gets the text only and gives back the two results; the other columns stay where they are."""

    def verdict(column: pa.Array) -> pa.Array:
        return _scored(model, column)

    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    # not moved into a filter on its result, where it would run a second time
    found = F.arrow_udf(verdict, "lang_pred string, score double").asNondeterministic()
    return docs.select(*keep, found(F.col(text)).alias("lang_pred")).select(*keep, "lang_pred.lang_pred", "lang_pred.score")


def held_out(doc: str = "doc_id") -> Column:
    return F.crc32(F.col(doc).cast("string").cast("binary")) % 4 == 2
