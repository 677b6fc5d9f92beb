"""Nearest neighbours: sparse text queries against a corpus, and dense vectors against vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestat.functions.blocks import as_matrix, smallest_k, squared_distances
from lodestat.operators.windows import top_k_per
from lodestat.session import BROADCAST_ROWS, cut_lineage, fits  # noqa: F401  (a test of the salted join sets ``fits`` here)

# Similarities are rounded before ranking: the order in which a sum is taken leaves noise in the
# last digits, and without this equal documents would be ranked by that noise.
RANK_DIGITS = 9
SALTS = 16
SCAN_DOCS = 256  # documents whose scores a task holds at a time
QUERY_CELLS = 16_000_000  # largest query matrix a task may hold
TEST_BLOCK = 1_024  # rows of the asking side per block
TRAIN_BLOCK = 8_192  # rows of the answering side per block
LSH_BLOCK = 16_384  # rows of either side per block of a hash bucket
LSH_ROWS = 512  # asking rows whose distances to a block are held at a time
LSH_PAIRS = 1_000_000  # pairs whose distances are added up exactly at a time
SLACK = 1e-9  # more than the noise of a squared distance made by a matrix product


def similarity(
    queries: DataFrame, corpus: DataFrame, query: str, doc: str, value: str = "weight",
    metric: str = "dot",
) -> DataFrame:
    """Similarity of every query to every document that shares a word with it.

    A small query batch becomes one bounded matrix that every task holds; a document, packed to one record, meets all
    queries at once, so no task keeps sums for all its (query, document) pairs. Larger batches join on the position with
    the corpus side salted, since a frequent word is a hot key.
    """
    if metric not in ("dot", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    batch = _query_matrix(queries, query, metric)
    if batch is not None:
        return _all_pairs(batch, queries, corpus, query, doc, value, metric)
    q = queries.select(F.col(query), "pos", F.col("weight").alias("_q"))
    c = corpus.select(F.col(doc), "pos", F.col(value).alias("_c"))
    if metric == "cosine":
        q = _unit(q, query, "_q")
        c = _unit(c, doc, "_c")
    salted = c.withColumn("_salt", F.pmod(F.xxhash64(doc), F.lit(SALTS)))
    spread_q = q.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    pairs = salted.join(spread_q, ["pos", "_salt"])
    return pairs.groupBy(query, doc).agg(
        F.round(F.sum(F.col("_q") * F.col("_c")), RANK_DIGITS).alias("similarity")
    )


def _unit(vectors: DataFrame, key: str, value: str) -> DataFrame:
    from pyspark.sql import Window as W

    length = F.sqrt(F.sum(F.col(value) * F.col(value)).over(W.partitionBy(key)))
    # a vector of zeros is as similar to everything as it can be: 0
    return vectors.withColumn(value, F.coalesce(F.col(value) / F.nullif(length, F.lit(0.0)), F.lit(0.0)))


def knn(similarities: DataFrame, query: str, doc: str, k: int) -> DataFrame:
    """The k most similar documents per query, ties by document key."""
    return top_k_per(similarities, query, [F.col("similarity").desc(), F.col(doc)], k)


def nearest_documents(
    queries: DataFrame, corpus: DataFrame, query: str, doc: str, k: int, value: str = "weight", metric: str = "dot"
) -> DataFrame:
    """The rows of ``knn(similarity(...))`` without building the (query, document) table.

    The query batch becomes one bounded matrix that every task holds; a document is packed to one
    record (its entries are bounded by the dictionary), scored against all queries at once, and a
    task lets only its own k best documents per query out. Larger batches take the declarative way.
    """
    batch = _query_matrix(queries, query, metric) if metric in ("dot", "cosine") else None
    if batch is None:
        return knn(similarity(queries, corpus, query, doc, value, metric), query, doc, k)
    names, packed = batch[0], _packed(corpus, doc, value)

    def scan(batches):
        best_s, best_d = np.zeros((len(names), 0)), None  # ids may be of any type that sorts
        for docs, scores in _scored(batches, *batch, metric):
            ids = docs.to_numpy(zero_copy_only=False)
            best_s = np.hstack([best_s, scores])
            spread_ids = np.broadcast_to(ids, scores.shape)
            best_d = spread_ids if best_d is None else np.hstack([best_d, spread_ids])
            place = np.unique(best_d, return_inverse=True)[1].reshape(best_d.shape)
            order = np.lexsort((place, -best_s), axis=1)[:, :k]
            best_s, best_d = np.take_along_axis(best_s, order, 1), np.take_along_axis(best_d, order, 1)
        if best_d is None:
            return
        rows, cols = np.nonzero(np.isfinite(best_s))
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(rows)), pa.array(best_d[rows, cols], id_type), pa.array(best_s[rows, cols])],
            names=[query, doc, "similarity"],
        )

    kinds, id_kind = queries.schema[query].dataType.simpleString(), corpus.schema[doc].dataType.simpleString()
    id_type = to_arrow_type(corpus.schema[doc].dataType)
    found = packed.mapInArrow(scan, f"{query} {kinds}, {doc} {id_kind}, similarity double")
    return top_k_per(found, query, [F.col("similarity").desc(), F.col(doc)], k)


def _query_matrix(queries: DataFrame, query: str, metric: str) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray] | None:
    """Query ids, ascending positions, weights and presence by (position, query); none if the batch is too large for a task."""
    asked = queries.select(F.col(query).alias("q"), "pos", F.col("weight").cast("double").alias("weight")).limit(BROADCAST_ROWS + 1).toArrow()
    asked = asked.filter(pc.is_valid(asked.column("pos")))
    names = asked.column("q").unique()
    places = np.unique(asked.column("pos").to_numpy())
    if asked.num_rows > BROADCAST_ROWS or len(names) * max(len(places), 1) > QUERY_CELLS:
        return None
    matrix = np.zeros((len(places), len(names)))
    shared = np.zeros((len(places), len(names)), bool)
    who = pc.index_in(asked.column("q"), names).to_numpy()
    at, weights = (np.searchsorted(places, asked.column("pos").to_numpy()), who), asked.column("weight").to_numpy()
    np.add.at(matrix, at, weights)
    shared[at] = True
    if metric == "cosine":
        lengths = np.sqrt(np.bincount(who, weights * weights, len(names)))
        matrix = matrix / np.where(lengths > 0, lengths, 1.0)
    return names, places, matrix, shared


def _packed(corpus: DataFrame, doc: str, value: str) -> DataFrame:
    """One record (d, positions p, weights v) per document."""
    return (
        corpus.groupBy(F.col(doc).alias("d"))
        .agg(F.collect_list(F.struct(F.col("pos").alias("p"), F.col(value).cast("double").alias("v"))).alias("e"))
        .select("d", F.col("e.p").alias("p"), F.col("e.v").alias("v"))
    )


def _scored(batches, names: pa.Array, places: np.ndarray, matrix: np.ndarray, shared: np.ndarray, metric: str):
    """(document ids, scores by query and document) of SCAN_DOCS documents at a time; -inf where no word is shared."""
    for whole in batches:
        for start in range(0, whole.num_rows if len(places) else 0, SCAN_DOCS):
            batch = whole.slice(start, SCAN_DOCS)
            flat = batch.column("p").flatten().to_numpy(zero_copy_only=False)
            weights = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column("p").value_lengths().to_numpy(zero_copy_only=False))
            slots = np.minimum(np.searchsorted(places, flat), len(places) - 1)
            known = places[slots] == flat
            scores = np.full((len(names), batch.num_rows), -np.inf)
            begin = 0
            for r, end in enumerate(ends):
                mine, w = slots[begin:end][known[begin:end]], weights[begin:end]
                if len(mine):
                    found = w[known[begin:end]] @ matrix[mine]
                    if metric == "cosine":
                        found = found / (np.sqrt((w * w).sum()) or 1.0)
                    scores[:, r] = np.where(shared[mine].any(0), np.round(found, RANK_DIGITS), -np.inf)
                begin = end
            yield batch.column("d"), scores


def _all_pairs(batch: tuple, queries: DataFrame, corpus: DataFrame, query: str, doc: str, value: str, metric: str) -> DataFrame:
    names = batch[0]

    def scan(batches):
        for docs, scores in _scored(batches, *batch, metric):
            cols, rows = np.nonzero(np.isfinite(scores.T))
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(rows)), docs.take(pa.array(cols)), pa.array(scores[rows, cols])], names=[query, doc, "similarity"]
            )

    kinds, id_kind = queries.schema[query].dataType.simpleString(), corpus.schema[doc].dataType.simpleString()
    return _packed(corpus, doc, value).mapInArrow(scan, f"{query} {kinds}, {doc} {id_kind}, similarity double")


def vote(neighbours: DataFrame, query: str, label: str) -> DataFrame:
    """Most frequent label among the neighbours with its number of votes, ties by label."""
    counts = neighbours.groupBy(query, label).agg(F.count("*").alias("votes"))
    won = counts.groupBy(query).agg(F.min(F.struct((-F.col("votes")).alias("neg"), F.col(label))).alias("b"))
    return won.select(query, F.col(f"b.{label}").alias(label), (-F.col("b.neg")).alias("votes"))


def knn_vote(similarities: DataFrame, labels: DataFrame, query: str, doc: str, label: str, k: int) -> DataFrame:
    """Vote of the k nearest documents; ``labels`` has one row (doc, label) per document and is only
    joined to the neighbours."""
    near = knn(similarities, query, doc, k).select(query, doc)
    return vote(labels.select(doc, label).join(near, doc), query, label)


# --- dense vectors -----------------------------------------------------------------------------

_FOUND = "test_id bigint, id bigint, label {label}, d2 double"


def dense_knn(
    train: DataFrame, test: DataFrame, k: int, id_col: str = "id", vec: str = "v", label: str = "label"
) -> DataFrame:
    """Exact k nearest training rows of each test row: (test_id, id, label, distance, rank).

    A small test side travels to the training partitions, which are read where they lie. Otherwise
    both sides are cut into bounded blocks, and every pair of blocks is one group. In both cases a
    block pair leaves at most k rows per test row, so pairs are never written out.
    """
    label_type = train.schema[label].dataType.simpleString()
    schema = _FOUND.format(label=label_type)
    t = train.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v"), F.col(label).alias("label"))
    q = test.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    asked = q.limit(TEST_BLOCK + 1).toArrow()
    if asked.num_rows <= TEST_BLOCK:
        found = t.mapInArrow(_scan_train(asked, k, t), schema)
    else:
        found = _block_knn(t, q, k, schema)
    ranked = top_k_per(found, "test_id", [F.col("d2"), F.col("id")], k)
    return ranked.select("test_id", "id", "label", F.sqrt("d2").alias("distance"), "rank")


def _scan_train(asked: pa.Table, k: int, train: DataFrame):
    ids = asked.column("id").to_numpy()
    vectors = as_matrix(asked.column("v"))

    def scan(batches):
        for batch in batches:
            if batch.num_rows == 0 or len(ids) == 0:
                continue
            d2 = np.round(squared_distances(vectors, as_matrix(batch.column("v"))), RANK_DIGITS)
            own = batch.column("id").to_numpy(zero_copy_only=False)
            at = smallest_k(d2, own, k)
            rows = np.repeat(np.arange(len(ids)), at.shape[1])
            cols = at.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(own[cols]), batch.column("label").take(pa.array(cols)), pa.array(d2[rows, cols])],
                names=["test_id", "id", "label", "d2"],
            )

    return scan


def _block_knn(t: DataFrame, q: DataFrame, k: int, schema: str) -> DataFrame:
    t_blocks = max(1, -(-t.count() // TRAIN_BLOCK))
    q_blocks = max(1, -(-q.count() // TEST_BLOCK))
    # the block is a hash of the row's key, so equal vectors or labels do not pile up in one block
    own_t = F.pmod(F.xxhash64("id"), F.lit(t_blocks)).alias("tb")
    own_q = F.pmod(F.xxhash64("id"), F.lit(q_blocks)).alias("qb")
    left = q.select("*", own_q, F.explode(F.sequence(F.lit(0), F.lit(t_blocks - 1)).cast("array<bigint>")).alias("tb"))
    right = t.select("*", own_t, F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<bigint>")).alias("qb"))

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"test_id": [], "id": [], "label": [], "d2": []})
        d2 = np.round(squared_distances(np.stack(a["v"]), np.stack(b["v"])), RANK_DIGITS)
        at = smallest_k(d2, b["id"].to_numpy(), k)
        rows = np.repeat(np.arange(len(a)), at.shape[1])
        cols = at.ravel()
        return pd.DataFrame(
            {
                "test_id": a["id"].to_numpy()[rows], "id": b["id"].to_numpy()[cols],
                "label": b["label"].to_numpy()[cols], "d2": d2[rows, cols],
            }
        )

    return left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInPandas(nearest, schema)


def knn_classify(neighbours: DataFrame, k: int | None = None) -> DataFrame:
    """Majority label and vote share per test row from a neighbour table."""
    near = neighbours if k is None else neighbours.filter(F.col("rank") <= k)
    counts = near.groupBy("test_id", "label").agg(F.count("*").alias("votes"))
    won = counts.groupBy("test_id").agg(
        F.min(F.struct((-F.col("votes")).alias("neg"), "label")).alias("b"), F.sum("votes").alias("k")
    )
    return won.select(
        "test_id", F.col("b.label").alias("prediction"), (-F.col("b.neg")).alias("votes"),
        (-F.col("b.neg") / F.col("k")).alias("share"),
    )


def knn_proba(neighbours: DataFrame) -> DataFrame:
    """Vote share of every label that occurs among the neighbours."""
    counts = neighbours.groupBy("test_id", "label").agg(F.count("*").alias("votes"))
    sizes = neighbours.groupBy("test_id").agg(F.count("*").alias("k"))
    return counts.join(sizes, "test_id").select("test_id", "label", (F.col("votes") / F.col("k")).alias("proba"))


def knn_error_curve(neighbours: DataFrame, truth: DataFrame, ks: Sequence[int], id_col: str, label: str) -> DataFrame:
    """Error for every k of a list, all from one neighbour table."""
    wanted = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))
    counts = (
        neighbours.select("test_id", "label", F.explode(wanted).alias("k"))
        .groupBy("test_id", "k", "label")
        .agg(F.count("*").alias("votes"))
    )
    won = counts.groupBy("test_id", "k").agg(F.min(F.struct((-F.col("votes")).alias("neg"), "label")).alias("b"))
    known = truth.select(F.col(id_col).alias("test_id"), F.col(label).alias("_truth"))
    return (
        won.join(known, "test_id")
        .groupBy("k")
        .agg(F.avg(F.when(F.col("b.label") == F.col("_truth"), 0.0).otherwise(1.0)).alias("error"))
    )


def knn_lsh(
    train: DataFrame, test: DataFrame, k: int, radius: float, id_col: str = "id", vec: str = "v",
    label: str = "label", bucket: float = 0.5, tables: int = 4, seed: int = 7,
) -> DataFrame:
    """Approximate neighbours within ``radius`` by random-projection hashing, for inputs too large
    for the exact operator."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def side(df: DataFrame, *more: str) -> DataFrame:
        return df.select(F.col(id_col).alias("id"), *more, array_to_vector(F.col(vec).cast("array<double>")).alias("f"))

    a = side(test)
    b = side(train, F.col(label).alias("label"))
    model = BucketedRandomProjectionLSH(
        inputCol="f", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed
    ).fit(b)

    def hashed(df: DataFrame, *more: str) -> DataFrame:
        codes = F.transform("h", lambda x: vector_to_array(x)[0])
        return model.transform(df).select("id", *more, vector_to_array("f").alias("v"), codes.alias("h")).distinct()

    near = _bucket_pairs(hashed(a), hashed(b, "label"), k, radius)
    return top_k_per(near, "test_id", [F.col("distance"), F.col("id")], k)


def _bucket_pairs(asked: DataFrame, known: DataFrame, k: int, radius: float) -> DataFrame:
    """(test_id, id, label, distance) of pairs that share a bucket in some table and are nearer than ``radius``; of every
    bucket at most k per asking row, which hold the k nearest of all.

    A bucket may hold most of the rows, so its pairs are never written out: both sides are cut into blocks of a bounded size
    by a hash of the row, and a pair of blocks lets only its best pairs out. A pair is looked at in the first table that
    brings it together, so it is found once.
    """
    def dealt(df: DataFrame, own: str, size: int) -> DataFrame:
        spread = F.pmod(F.xxhash64("id", "v"), F.lit(max(1, -(-df.count() // size)))).cast("int")
        return cut_lineage(df.withColumn(own, spread)).select("*", F.posexplode("h").alias("t", "bucket"))

    sides = dealt(asked, "qb", LSH_BLOCK), dealt(known, "tb", LSH_BLOCK)
    blocks = [df.select(*[F.col(c).alias(c) for c in ("t", "bucket", own)]).distinct() for df, own in zip(sides, ("qb", "tb"))]
    left = sides[0].join(blocks[1], ["t", "bucket"])  # one row per block of the other side that has the bucket
    right = sides[1].join(blocks[0], ["t", "bucket"])
    types = [asked.schema["id"].dataType, known.schema["id"].dataType, known.schema["label"].dataType]
    names = ["test_id", "id", "label", "distance"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [*(t.simpleString() for t in types), "double"]))
    kinds = [to_arrow_type(t) for t in types]

    def nearest(x: pa.Table, y: pa.Table) -> pa.Table:
        found = [[], [], []]
        if x.num_rows and y.num_rows:
            y = y.take(pc.sort_indices(y.column("id"), null_placement="at_start"))  # equal distances go by id
            vx, vy, hx, hy = (as_matrix(c) for c in (x.column("v"), y.column("v"), x.column("h"), y.column("h")))
            table = x.column("t")[0].as_py()
            for begin in range(0, len(vx), LSH_ROWS):
                rows = slice(begin, begin + LSH_ROWS)
                d2 = squared_distances(vx[rows], vy)
                for earlier in range(table):
                    d2[hx[rows, earlier][:, None] == hy[:, earlier][None, :]] = np.inf
                d2[d2 > radius * radius * (1 + 1e-9) + SLACK] = np.inf
                cut = np.partition(d2, min(k, len(vy)) - 1, axis=1)[:, min(k, len(vy)) - 1]
                r, c = np.nonzero(np.isfinite(d2) & (d2 <= cut[:, None] + SLACK))
                for start in range(0, len(r), LSH_PAIRS):
                    i, j = r[start : start + LSH_PAIRS] + begin, c[start : start + LSH_PAIRS]
                    total = np.zeros(len(i))
                    for m in range(vx.shape[1]):  # term by term, as the join by buckets adds them
                        total += (vx[i, m] - vy[j, m]) ** 2
                    for kept, part in zip(found, (i, j, np.sqrt(total))):
                        kept.append(part)
        i, j, d = (np.concatenate(part) if part else np.zeros(0) for part in found)
        inside = d < radius
        i, j, d = i[inside].astype(np.int64), j[inside].astype(np.int64), d[inside]
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, i)  # place of the row's nearest
        best = np.arange(len(i)) - first < k
        i, j, d = i[best], j[best], d[best]
        columns = [x.column("id").take(pa.array(i)).cast(kinds[0]), y.column("id").take(pa.array(j)).cast(kinds[1])]
        return pa.table([*columns, y.column("label").take(pa.array(j)).cast(kinds[2]), pa.array(d)], names=names)

    keys = ["t", "bucket", "qb", "tb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, schema)
