"""Near-duplicate groups by MinHash with tensored banding, verified on full shingle sets.

``COLLECTIONS`` small collections of ``HASHES`` minhashes are computed; every pair of collections forms the key of one
table. So 12 collections of 2 give 66 tables of 4 minhashes each from 24 minhashes instead of 264. Two documents meet in a
table when two collections agree. At a similarity s this fails with probability (1 - p) ** 12 + 12 p (1 - p) ** 11 for
p = s ** 2, that is under 7e-6 at 0.85 and under 3e-8 at 0.9, and a group usually has many links.

Documents with equal sets are one class from the start. In each bucket the class that meets most others is the pivot; each
class is first compared with its best pivot, then with its other pivots while they are in another component, and at last
the members of buckets that still hold several components are compared where a prefix filter, which loses nothing, lets two
of them meet. So large groups of copies are joined by about one comparison a member, and no link is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.batches import WORD_SLAB_BYTES, Words, lists, lowered, mix, odd_constants, slabs, space_words, text_bytes
from lodestat.llm.components import components
from lodestat.llm.shared import written
from lodestat.session import broadcast_if_small

WORDS = 5
COLLECTIONS = 12
HASHES = 2
PERCENT = 85


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within a text, and the n + 1 offsets of the texts.

    A text of 1 to 4 words has one shingle, all its words; a text without words has none.
    """
    data, offsets = text_bytes(column)
    words = Words(lowered(data), offsets, space_words())
    first, hashes = words.grams(WORDS)
    owner = words.doc[first]
    for size in range(1, WORDS):
        short = np.flatnonzero(words.count == size)
        total = np.zeros(len(short), np.uint64)
        for j, factor in enumerate(odd_constants(size, 101 + size)):
            total += mix(words.hash[words.first[short] + j] * factor + np.uint64(j))
        owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, mix(total)])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[fresh], hashes[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(column)))])


def _signatures(batches):
    """Task function: size and digest of the set, and its minhashes."""
    factors = odd_constants(COLLECTIONS * HASHES, 17)
    for slab in slabs(batches, "text", WORD_SLAB_BYTES):
        hashes, offsets = shingles(slab.column("text"))
        size = np.diff(offsets)
        some = np.flatnonzero(size)
        starts = offsets[some]
        sums = np.zeros((slab.num_rows, 2), np.uint64)
        least = np.zeros((slab.num_rows, len(factors)), np.uint64)
        if len(some):
            sums[some, 0] = np.add.reduceat(mix(hashes), starts)
            sums[some, 1] = np.bitwise_xor.reduceat(mix(hashes + np.uint64(1)), starts)
            for i, factor in enumerate(factors):
                least[some, i] = np.minimum.reduceat(hashes * factor, starts)
        counts = np.where(size > 0, len(factors), 0)
        yield pa.RecordBatch.from_arrays(
            [
                slab.column("id"), slab.column("key"), pa.array(size.astype(np.int64)), pa.array(sums[:, 0].copy().view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)),
                lists(least[some].ravel().view(np.int64), np.concatenate([[0], np.cumsum(counts)]), pa.int64()),
            ],
            names=["id", "key", "n", "sum", "xor", "least"],
        )


def _sets(batches):
    for slab in slabs(batches, "text", WORD_SLAB_BYTES):
        hashes, offsets = shingles(slab.column("text"))
        yield pa.RecordBatch.from_arrays([slab.column("rep"), slab.column("pivot"), lists(hashes.view(np.int64), offsets, pa.int64())], names=["rep", "pivot", "set"])


def _linked() -> F.Column:
    both = F.size(F.array_intersect("set", "other"))
    return 100 * both >= PERCENT * (F.size("set") + F.size("other") - both)


def _may_link(a: str, b: str) -> F.Column:
    """Sizes of two sets that can still be similar enough."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _prefix_pairs(rows: DataFrame) -> DataFrame:
    """(rep, component, set) to the pairs rep > pivot from different components that may be similar enough; none that is
    gets lost, and copies that each differ from all others in too many shingles of their own meet nobody.

    Shingles are put in one order, the rarest first. Of two similar sets the larger one has a shingle in common with the
    smaller one among its first n - ceil(t n) + 1, and that is among the smaller one's first n - ceil(2 t n / (1 + t)) + 1
    (prefix filter with a shorter prefix for the index side). The places of a common shingle also bound how many more can be.
    """
    cells = rows.select("rep", F.explode("set").alias("shingle"))
    counts = cells.groupBy("shingle").agg(F.count("*").alias("held")).filter("held > 1")
    # a shingle of one set only comes first in the order, but meets nothing: only its number matters
    ordered = (
        cells.join(counts, "shingle").groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order"))
        .join(rows.select("rep", "component", F.size("set").alias("n")), "rep")
        .withColumn("alone", F.col("n") - F.size("order"))
    )
    probe = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * PERCENT) / (100 + PERCENT)) + 1
    head = lambda size: F.posexplode(F.slice("order", F.lit(1), F.greatest(size - F.col("alone"), F.lit(0)).cast("int"))).alias("at", "s")
    rest = F.size("order") - 1 - F.col("at")
    columns = ["rep", "component", "n"]
    large = ordered.select(*columns, "order", head(probe)).select("s.shingle", *columns, "at", rest.alias("rest"))
    small = ordered.select(*columns, "order", head(index)).select("s.shingle", *(F.col(c).alias(f"{c}2") for c in columns), F.col("at").alias("at2"), rest.alias("rest2"))
    # most shingles that two sets with this one in common can share: those before it, itself, those behind it
    most = F.least("at", "at2") + 1 + F.least("rest", "rest2")
    larger = (F.col("n") > F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("rep") > F.col("rep2")))
    similar = _may_link("n", "n2") & ((100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("n2")))
    met = large.join(small, "shingle").filter((F.col("component") != F.col("component2")) & larger & similar)
    return met.select(F.greatest("rep", "rep2").alias("rep"), F.least("rep", "rep2").alias("pivot")).distinct()


def groups(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, n_shingles, component): component is the smallest id that verified links reach.

    Ids are integers. Null and empty texts, and texts without words, have no shingle and only reach themselves. Rows that
    repeat id and text are one document; ``key`` tells texts under one id apart.
    """
    kind = docs.schema[doc].dataType.simpleString()
    rows = docs.select(F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"))
    signed = written(
        rows.mapInArrow(_signatures, f"id {kind}, key bigint, n bigint, sum bigint, xor bigint, least array<bigint>"), "signatures", texts=True
    )
    same = ["n", "sum", "xor"]
    filled = signed.filter((F.col("n") > 0) & F.col("id").isNotNull())
    # equal sets are one class; the smallest id stands for it
    classes = written(filled.groupBy(*same).agg(F.min("id").alias("rep"), F.first("least").alias("least")), "classes")
    collection = [F.xxhash64(F.lit(i), *[F.get("least", F.lit(i * HASHES + h)) for h in range(HASHES)]) for i in range(COLLECTIONS)]
    cells = classes.select("rep", "n", F.explode(F.array(*collection)).alias("cell"))
    # a table's bucket can only hold two classes if both of its collections are shared, so other keys are never formed
    shared = cells.join(cells.groupBy("cell").agg(F.count("*").alias("held")).filter("held > 1").select("cell"), "cell")
    several = shared.groupBy("rep", "n").agg(F.sort_array(F.collect_list("cell")).alias("cells")).filter(F.size("cells") > 1)
    pairs = F.flatten(F.transform("cells", lambda a, i: F.transform(F.slice("cells", i + 2, F.size("cells")), lambda b: F.xxhash64(a, b))))
    keys = written(several.select("rep", "n", F.explode(pairs).alias("bucket")), "buckets")
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    members = written(keys.join(sizes, "bucket"), "members")
    degree = members.groupBy("rep").agg(F.sum("held").alias("degree"))
    weighed = members.join(degree, "rep")
    pivots = weighed.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("rep")).alias("order"), F.col("n").alias("pivot_n"))).alias("top"))
    stars = (
        members.join(pivots, "bucket")
        .select("rep", "n", (-F.col("top.order")).alias("pivot"), F.col("top.pivot_n").alias("pivot_n"), F.col("top.degree").alias("degree"))
        .filter((F.col("rep") != F.col("pivot")) & _may_link("n", "pivot_n"))
        .groupBy("rep", "pivot").agg(F.count("*").alias("met"), F.first("degree").alias("degree"))
    )
    stars = written(stars, "stars")
    best = stars.groupBy("rep").agg(F.max(F.struct("met", "degree", (-F.col("pivot")).alias("order"))).alias("top")).select("rep", (-F.col("top.order")).alias("pivot"))
    wanted = members.select("rep").distinct().join(best, "rep", "left")
    # sets of the classes that meet any other one, read off whole texts once more
    whole = rows.select(F.col("id").alias("rep"), "key", "text")
    first_text = filled.join(classes.select("rep"), filled["id"] == classes["rep"]).groupBy("rep").agg(F.min("key").alias("key"))
    wanted = written(wanted.join(first_text, "rep"), "wanted")
    sets = written(
        whole.join(broadcast_if_small(wanted), ["rep", "key"]).select("rep", "pivot", "text").mapInArrow(_sets, f"rep {kind}, pivot {kind}, set array<bigint>").dropDuplicates(["rep"]),
        "sets", texts=True,
    )
    own = sets.select("rep", "set")

    def verified(asked: DataFrame) -> DataFrame:
        """Those of the pairs (rep, pivot) that are linked. Of the second side only the sets that are asked for move."""
        left = asked.join(own, "rep")
        used = own.select(F.col("rep").alias("pivot"), F.col("set").alias("other")).join(asked.select("pivot").distinct(), "pivot", "left_semi")
        return left.join(used, "pivot").filter(_linked()).select(F.col("rep").alias("a"), F.col("pivot").alias("b"))

    starred = sets.filter(F.col("pivot").isNotNull())
    pivot_sets = own.select(F.col("rep").alias("pivot"), F.col("set").alias("other")).join(starred.select("pivot").distinct(), "pivot", "left_semi")
    links = written(starred.join(pivot_sets, "pivot").filter(_linked()).select(F.col("rep").alias("a"), F.col("pivot").alias("b")), "links")
    found = written(components(links), "components")

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose ends lie in different components so far."""
        a = found.select(F.col("node").alias("rep"), F.col("component").alias("ca"))
        b = found.select(F.col("node").alias("pivot"), F.col("component").alias("cb"))
        return pairs.join(a, "rep", "left").join(b, "pivot", "left").filter(F.coalesce("ca", "rep") != F.coalesce("cb", "pivot")).select("rep", "pivot")

    asked = written(apart(stars.select("rep", "pivot").join(best, ["rep", "pivot"], "left_anti")), "asked")
    more = written(verified(asked), "links")
    if more.limit(1).count():
        links = links.unionByName(more)
        found = written(components(links), "components")
    # classes in buckets that still hold several components: pairs by prefix filter, as their buckets may be very large
    placed = members.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    left = written(placed.join(mixed, "bucket").select("rep", "component").distinct(), "leftover")
    tried = stars.select(F.greatest("rep", "pivot").alias("rep"), F.least("rep", "pivot").alias("pivot"))
    open_ = _prefix_pairs(own.join(left, "rep")).join(tried, ["rep", "pivot"], "left_anti")
    last = written(verified(written(open_, "asked")), "links")
    if last.limit(1).count():
        found = written(components(links.unionByName(last)), "components")
    named = classes.select(*same, "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    return (
        signed.select("id", "key", *same).distinct().join(named, same, "left")
        .select("id", "key", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("id").isNotNull(), F.col("component")), "id").alias("component"))
    )


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns id, n_shingles, component_id, kept: one row per document, kept if it is the smallest id of its group."""
    return groups(docs, doc, text).select(F.col("id").alias(doc), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def deduplicated(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is kept; of rows that repeat id and text, one."""
    dropped = groups(docs, doc, text).filter(~F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("_id"), F.col("key").alias("_key"))
    dropped = written(dropped, "dropped")
    rows = docs.withColumn("_textkey", F.xxhash64(F.col(text)))
    left = rows.join(broadcast_if_small(dropped), (F.col(doc) == F.col("_id")) & (F.col("_textkey") == F.col("_key")), "left_anti")
    repeated = written(rows.groupBy(doc, "_textkey").agg(F.count("*").alias("n")).filter("n > 1").select(F.col(doc).alias("_id"), F.col("_textkey").alias("_key")), "repeated")
    if not repeated.limit(1).count():
        return left.drop("_textkey")
    here = broadcast_if_small(repeated)
    on = F.col(doc).eqNullSafe(F.col("_id")) & (F.col("_textkey") == F.col("_key"))
    once = left.join(here, on, "left_anti")
    again = left.join(here, on, "left_semi").dropDuplicates([doc, "_textkey"])
    return once.unionByName(again).drop("_textkey")
