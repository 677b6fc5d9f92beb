"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies that each of its documents should have. The whole part is
certain; the fractional part is a probability. Within a block of documents of one source two fractions at a time are
paired: mass (words) moves at random from one to the other, keeping both expectations and the sum of words, until one is 0
or 1. Each block leaves one document with a fraction at most; those are combined in the same way, ``FAN`` blocks at a
time, through a tree of distributed rounds, and a source's last fraction is drawn. So a source misses its target by less
than the words of one document.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.shared import written
from lodestat.operators.rows import with_row_id

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
CAP = 2.0
BLOCK = 4_096
FAN = 64
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rows) to (source, source_size, rows, target).

    Sources in ascending order, null last, get the weights in turn. A source stops at CAP times its size, and what it can't
    take is shared by the others by weight, until none is above. Each round of sharing is one aggregate over the sources.
    """
    order = ["_null", "source"]
    placed = with_row_id(sizes.withColumn("_null", F.col("source").isNull()), order, "_at").drop("_null")
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("_at") % len(WEIGHTS)).cast("int"))
    shared = placed.withColumn("weight", weight).withColumn("cap", CAP * F.col("source_size"))
    per_weight, before = 0.0, -1.0
    whole = TOTAL * float(shared.agg(F.sum("source_size")).collect()[0][0] or 0)
    while per_weight > before:
        full = F.col("cap") <= F.col("weight") * per_weight
        row = shared.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).collect()[0]
        before = per_weight
        per_weight = (whole - row[0]) / row[1] if row[1] else per_weight
    return shared.select("source", "source_size", "rows", F.least(F.col("cap"), F.col("weight") * per_weight).alias("target"))


def _pivot(mass: np.ndarray, share: np.ndarray, seed: int) -> None:
    """Pairwise rounding in place: afterwards at most one share lies strictly between 0 and 1."""
    draws = np.random.default_rng(seed).random(len(mass))
    held = -1
    for j in range(len(mass)):
        if not 0.0 < share[j] < 1.0:
            continue
        if mass[j] == 0:  # takes no words either way
            share[j] = float(draws[j] < share[j])
            continue
        if held < 0:
            held = j
            continue
        i = held
        up = min((1 - share[i]) * mass[i], share[j] * mass[j])  # words that could move from j to i
        down = min(share[i] * mass[i], (1 - share[j]) * mass[j])
        move = up if draws[j] < down / (up + down) else -down
        share[i] += move / mass[i]
        share[j] -= move / mass[j]
        for k in (i, j):
            if share[k] < 1e-9 or share[k] > 1 - 1e-9:
                share[k] = round(share[k])
        held = i if 0.0 < share[i] < 1.0 else j if 0.0 < share[j] < 1.0 else -1


def _round_block(seed: int, last: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["mass", "key", "order"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        name = f"{seed}:{block['source'].iloc[0]}:{block['block'].iloc[0]}:{block['level'].iloc[0]}"
        share = block["share"].to_numpy(dtype=float).copy()
        own = zlib.crc32(name.encode())
        _pivot(block["mass"].to_numpy(dtype=float), share, own)
        if last:
            drawn = np.random.default_rng(own + 1).random(len(share))
            share = np.where((share > 0) & (share < 1), drawn < share, share).astype(float)
        block["share"] = share
        return block

    return run


def mix(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """Columns id, key, source, size, source_size, target, copies, taken; one row per input row.

    size: words of the text (null: 0). taken: copies times size. Equal seeds give equal results. Rows that repeat id, text
    and source are rounded together and get the same number of copies. A source without words has target 0.
    """
    rows = docs.select(
        F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    # a row here is a few numbers; texts stay where they are
    units = written(rows.groupBy("id", "key", "source", "size").agg(F.count("*").alias("same")), "mix-sizes")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("same")).alias("source_size"), F.count("*").alias("rows"))
    aims = written(targets(sizes).withColumnRenamed("source", "of"), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a source of a third of all rows is many blocks: the salt is a hash of the document
    block = F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.ceil(F.col("rows") / BLOCK).cast("bigint"))
    small = aims.agg(F.count("*"), F.max("rows")).collect()[0]
    begun = (
        units.join(F.broadcast(aims) if small[0] <= 100_000 else aims, F.col("source").eqNullSafe(F.col("of")))
        .select(
            "id", "key", "source", "size", "same", "source_size", "target", F.floor(ratio).cast("bigint").alias("whole"),
            (ratio - F.floor(ratio)).alias("share"), (F.col("size") * F.col("same")).alias("mass"), block.alias("block"),
            F.lit(0).alias("level"), F.xxhash64("id").alias("order"),
        )
    )
    levels = 1 + (math.ceil(math.log(max(math.ceil((small[1] or 1) / BLOCK), 1), FAN)) if (small[1] or 0) > BLOCK else 0)
    done, todo = [], begun
    for level in range(levels):
        last = level == levels - 1
        step = todo.groupBy("source", "block").applyInPandas(_round_block(seed, last), todo.schema)
        if last:
            done.append(step)
            break
        step = written(step, f"mix-level{level}")
        open_ = (F.col("share") > 0) & (F.col("share") < 1)
        done.append(step.filter(~open_))
        todo = step.filter(open_).withColumn("block", F.floor(F.col("block") / FAN)).withColumn("level", F.lit(level + 1))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = F.col("whole") + F.col("share").cast("bigint")
    return (
        out.withColumn("_same", F.explode(F.sequence(F.lit(1), F.col("same"))))
        .select("id", "key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
        .withColumnRenamed("id", doc)
    )


def mixed(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """The mixed table itself: each row of ``docs`` as often as the mix takes it, with the columns of ``docs``."""
    plan = mix(docs, doc, text, source, seed)
    plan = plan.select(F.col(doc).alias("_id"), F.col("key").alias("_key"), F.col("source").alias("_source"), F.col("copies").alias("_copies")).filter("_copies > 0").distinct()
    rows = docs.withColumn("_textkey", F.xxhash64(F.col(text)))
    on = rows[doc].eqNullSafe(plan["_id"]) & (rows["_textkey"] == plan["_key"]) & rows[source].eqNullSafe(plan["_source"])
    return rows.join(plan, on).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
