"""Word tables of a text collection: tokens, dictionary, counts, TF, IDF, TF-IDF, co-occurrence.

Everything stays in long form (document, position, value). A dictionary of a given size is bounded
by construction, so joining it is a broadcast; document tables are only ever hash-distributed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.functions import text as tx
from lodestat.session import BROADCAST_ROWS, broadcast_if_small, settle

TILE = 2_048  # a co-occurrence task holds one TILE x TILE matrix of counts
LISTED = 100_000  # words that a task looks tokens up in by itself; a larger dictionary is joined
COUNTED = 200_000  # words that a task counts at a time, or one text's


def tokenize(df: DataFrame, doc: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """One row per clean word occurrence as ``word``; ``packed`` one row per text, its words in the array ``words``."""
    if packed:
        return df.select(doc, *carry, tx.clean_words(F.col(text)).alias("words"))
    return (
        df.select(doc, *carry, F.explode(tx.letter_runs(F.col(text))).alias("word"))
        .filter(F.col("word") != "")
        .withColumn("word", F.lower("word"))
    )


def word_count(df: DataFrame, text: str = "text", mode: str = "raw") -> DataFrame:
    """Word totals. ``raw`` splits on single spaces and keeps empty tokens; ``clean`` also drops
    one-character tokens and lowers the rest."""
    words = df.select(F.explode(tx.space_split(F.col(text))).alias("word"))
    if mode == "clean":
        words = words.filter(F.length("word") > 1).withColumn("word", F.lower("word"))
    elif mode != "raw":
        raise ValueError(f"unknown mode {mode}")
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


def dictionary(tokens: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent words with their rank from 0; equal counts go by alphabet."""
    totals = tokens.groupBy("word").agg(F.count("*").alias("cnt"))
    top = totals.orderBy(F.col("cnt").desc(), "word").limit(size)
    # at most ``size`` rows are ranked here
    rank = F.row_number().over(W.orderBy(F.col("cnt").desc(), "word"))
    return top.select("word", (rank - 1).cast("bigint").alias("pos"), "cnt")


def _dictionary_side(words: DataFrame, size: int | None) -> DataFrame:
    side = words.select("word", "pos")
    if size is not None and size <= BROADCAST_ROWS:
        return F.broadcast(side)
    return broadcast_if_small(side)


def bow(tokens: DataFrame, words: DataFrame, doc: str = "doc_id", size: int | None = None, settled: bool = False) -> DataFrame:
    """Bag of words (doc, pos, cnt). Documents without a dictionary word do not appear.

    Of ``packed`` tokens a task looks the words up in the bounded dictionary and lets one record of counts out for each text,
    not one row a token. The records of a document meet by ``doc`` and are added up there, which is also where its shares and
    its vector are made, so they are not shuffled again. ``settled`` writes the counts once, for those that use them twice.
    """
    if "words" not in tokens.columns:
        found = tokens.join(_dictionary_side(words, size), "word", "inner")
        counts = found.groupBy(doc, "pos").agg(F.count("*").alias("cnt"))
        return settle(counts) if settled else counts
    known = words.select("word", "pos").limit(LISTED + 1).toArrow()
    if known.num_rows > LISTED or known.column("pos").null_count or len(known.column("word").unique()) < known.num_rows:
        return bow(tokens.select(doc, F.explode("words").alias("word")), words, doc, size, settled)
    types = tokens.schema[doc].dataType.simpleString(), words.schema["pos"].dataType.simpleString()
    counted = tokens.select(F.col(doc).alias("_doc"), "words").mapInArrow(_count_words(known), f"_doc {types[0]}, pos array<{types[1]}>, cnt array<int>")
    if settled:
        counted = settle(counted)
    cells = counted.repartition("_doc").select(F.col("_doc").alias(doc), F.inline(F.arrays_zip("pos", "cnt")))
    return cells.groupBy(doc, "pos").agg(F.sum("cnt").alias("cnt"))


def _count_words(known: pa.Table):
    """Task function: (document, words) to (document, positions, counts), about COUNTED words at a time."""
    words, positions = known.column("word").combine_chunks(), known.column("pos").combine_chunks()

    def count(batch: pa.RecordBatch, sizes: np.ndarray) -> pa.RecordBatch:
        at = pc.fill_null(pc.index_in(batch.column(1).flatten(), value_set=words, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
        cells = (np.repeat(np.arange(len(sizes)), sizes) * len(words) + at)[at >= 0]
        cells, counts = np.unique(cells, return_counts=True)
        who, place = np.divmod(cells, max(len(words), 1))
        there, held = np.unique(who, return_counts=True)
        offsets = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, values) for values in (positions.take(pa.array(place)), pa.array(counts.astype(np.int32)))]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(there)), *lists], names=["_doc", "pos", "cnt"])

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, start = np.cumsum(sizes), 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + COUNTED, side="right")))
                yield count(batch.slice(start, stop - start), sizes[start:stop])
                start = stop

    return run


def tf(counts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Share of the document's dictionary words. One document's rows are bounded by the dictionary."""
    return counts.withColumn("tf", F.col("cnt") / F.sum("cnt").over(W.partitionBy(doc)))


def doc_freq(counts: DataFrame) -> DataFrame:
    """Documents per position; ``counts`` has one row per (doc, pos), so a count is a distinct count."""
    return counts.groupBy("pos").agg(F.count("*").alias("df"))


def idf(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """ln(N / df) without smoothing, N counted from the corpus table."""
    n = documents.agg(F.count("*").cast("double")).scalar()
    return doc_freq(counts).withColumn("idf", F.log(n / F.col("df")))


def tfidf(frequencies: DataFrame, weights: DataFrame, size: int | None = None) -> DataFrame:
    side = weights.select("pos", "idf")
    side = F.broadcast(side) if size is not None and size <= BROADCAST_ROWS else broadcast_if_small(side)
    return frequencies.join(side, "pos").withColumn("weight", F.col("tf") * F.col("idf"))


def vectorize_query(
    queries: DataFrame, words: DataFrame, weights: DataFrame | None, query: str, text: str, size: int | None = None
) -> DataFrame:
    """Ad-hoc texts as (query, pos, weight) with the corpus dictionary and IDF; TF when ``weights`` is None."""
    shares = tf(bow(tokenize(queries, query, text), words, query, size), query)
    if weights is None:
        return shares.select(query, "pos", F.col("tf").alias("weight"))
    return tfidf(shares, weights, size).select(query, "pos", "weight")


def label_from_path(df: DataFrame, column: str, name: str = "label") -> DataFrame:
    """First ``/.../`` piece of an id path."""
    return df.withColumn(name, tx.first_match(F.col(column), "/.*?/"))


def sparse_vectors(values: DataFrame, doc: str, value: str, size: int) -> DataFrame:
    """(doc, pos, value) rows to one ML sparse vector per document; size bounds each row's length."""
    from pyspark.ml.linalg import SparseVector, VectorUDT

    to_sparse = F.udf(lambda p, v: SparseVector(size, p, v), VectorUDT())
    packed = values.groupBy(doc).agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("p"), F.col(value).cast("double").alias("v")))).alias("e")
    )
    return packed.select(doc, to_sparse(F.col("e.p"), F.col("e.v")).alias("vector"))


def cooccurrence(documents: DataFrame, words: DataFrame, text: str = "text", size: int = 2_000) -> DataFrame:
    """Documents that hold both words, for every pair of dictionary words; the diagonal is the
    document frequency. Output (pos_a, pos_b, docs) with pos_a <= pos_b and docs > 0.

    No pair is ever built per document. Each task turns its documents into a 0/1 block over the
    dictionary and adds up block' * block; only the non-zero cells of that bounded matrix leave the
    task, already summed. A dictionary wider than one tile is done tile by tile.
    """
    if size > BROADCAST_ROWS:
        raise ValueError(f"a dictionary of at most {BROADCAST_ROWS} words is held by every task")
    listed = [r["word"] for r in words.filter(F.col("pos") < size).select("pos", "word").orderBy("pos").collect()]
    cells = documents.filter(F.col(text).isNotNull()).select(tx.clean_words(F.col(text)).alias("tokens"))
    starts = range(0, max(len(listed), 1), TILE)
    tiles = [
        cells.mapInArrow(_tile_counts(listed, a, b), "pos_a bigint, pos_b bigint, docs bigint")
        for a in starts for b in starts if a <= b
    ]
    sums = tiles[0]
    for t in tiles[1:]:
        sums = sums.unionByName(t)
    return sums.groupBy("pos_a", "pos_b").agg(F.sum("docs").alias("docs"))


def _tile_counts(listed: list[str], first: int, second: int):
    """Task function that counts the pairs (a, b) with a in one tile and b in another or the same."""
    sides = [listed[first : first + TILE]] + ([listed[second : second + TILE]] if second != first else [])

    def presence(batch, known: list[str]) -> np.ndarray:
        tokens = batch.column(0)
        rows = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
        at = pc.fill_null(pc.index_in(tokens.flatten(), value_set=pa.array(known, pa.string())), -1)
        at = at.to_numpy(zero_copy_only=False)
        block = np.zeros((len(tokens), len(known)), np.float32)
        block[rows[at >= 0], at[at >= 0]] = 1.0
        return block

    def partial(batches):
        acc = np.zeros((len(sides[0]), len(sides[-1])))
        for batch in batches:
            blocks = [presence(batch, side) for side in sides]
            acc += blocks[0].T @ blocks[-1]
        a, b = np.nonzero(np.triu(acc) if len(sides) == 1 else acc)
        for s in range(0, len(a), 65_536):
            i, j = a[s : s + 65_536], b[s : s + 65_536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i + first), pa.array(j + second), pa.array(acc[i, j].astype(np.int64))],
                names=["pos_a", "pos_b", "docs"],
            )

    return partial


def target(labels: Column, positive: list[str]) -> Column:
    """+1 for the listed labels, -1 for all others."""
    return F.when(labels.isin(*positive), 1.0).otherwise(-1.0)
