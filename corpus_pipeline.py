"""A corpus pipeline: five stages over ``documents``, each written and read again by whoever runs it.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return the columns of
``documents``. A stage that gets no rows returns none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm import byte_bpe, language_id, mixing, near_dedup, passages
from lodestat.llm.shared import documents, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = "byte_bpe_50k.tiktoken"
REJECT_BELOW = 0.5  # no language speaks for the text more than against it


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts that no learned language claims. Learned on the rows that aren't held out."""
    model = language_id.fit(docs.filter(~language_id.held_out()), "doc_id", "text", "lang")
    found = language_id.predict(docs.select(*COLUMNS), model)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= REJECT_BELOW)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_dedup.deduplicated(docs.select(*COLUMNS))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; texts that nothing is left of go."""
    cut = passages.without_passages(docs.select(*COLUMNS))
    return cut.filter(F.col("text").rlike(r"[^ \t\n\x0B\f\r]")).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): token ids, and the text that they decode to."""
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    # written, so that a task has one Python worker, not one to encode and one to decode; both would stay for later tasks
    encoded = written(byte_bpe.encode(docs, ranks, pattern), "ids")
    return byte_bpe.decode(encoded, ranks, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("decoded")
    )


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None  # hashing, rounding and BPE can't be said in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage{number}")
    return docs
