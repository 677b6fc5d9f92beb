"""Token counts through a cache of content digests.

The cache is a table (version, digest, n_tokens): ``version`` is the digest of the tokenizer file, ``digest`` that of the
normalised content. Texts are joined to it; each distinct missing content is encoded once and appended. A count never
depends on the cache's state, only the work does.

Normalised content: runs of ASCII white space become one space. The tokenizer does the same before it looks at words and
never joins words over white space, so equal normalised contents have equal counts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.batches import slabs
from lodestat.llm.shared import new_folder

CACHE = "version string, digest string, n_tokens bigint"
MEMO_WORDS = 600_000  # word counts that a worker remembers; only speed depends on it

_memo: dict[str, dict[str, int]] = {}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _parts(word: str) -> tuple[str, str]:
    """A word and the full stops and commas behind its last ASCII letter or digit.

    The tokenizer always cuts between a letter or digit and such a sign, and it lowers A-Z itself; special strings hold "<".
    """
    core = word.rstrip(".,")
    tail = word[len(core) :]
    if tail and not (core and core[-1].isascii() and core[-1].isalnum()):
        core, tail = word, ""
    return (core.lower() if core.isascii() and "<" not in core else core), tail


def _encode(path: str):
    """Task function: counts of whole texts. A text's count is the sum over its words, so a word is encoded once."""

    def run(batches):
        tokenizer = _tokenizer(path)
        memo = _memo.setdefault(path, {"": 0})
        for slab in slabs(batches, "content"):
            split = pc.ascii_split_whitespace(slab.column("content"))
            coded = split.flatten().dictionary_encode()
            words = [_parts(w) for w in coded.dictionary.to_pylist()]
            fresh = list({p for pair in words for p in pair if p not in memo})
            if len(memo) + len(fresh) > MEMO_WORDS:
                memo.clear()
                memo[""] = 0
                fresh = list({p for pair in words for p in pair if p})
            for i in range(0, len(fresh), 4096):
                part = fresh[i : i + 4096]
                memo.update(zip(part, map(len, tokenizer.encode_batch_fast(part, add_special_tokens=False))))
            each = np.fromiter((memo[core] + memo[tail] for core, tail in words), np.int64, len(words))[coded.indices.to_numpy()]
            ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
            sums = np.concatenate([[0], np.cumsum(each)])
            counts = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
            yield pa.RecordBatch.from_arrays([slab.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


def version_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def count(
    docs: DataFrame, tokenizer: str, cache: str | None = None, doc: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """Columns id, n_bytes, n_tokens, over_limit; one row per input row, in any order.

    ``tokenizer`` is the path of a tokenizer file that every worker can read; ``cache`` the folder of the cache table
    (None: a new one below ``spark.checkpoint.dir``). Null text counts as the empty text, which has 0 tokens; repeated
    rows stay repeated. Two jobs that append at once may store a digest twice, with the same count; readers take one.
    """
    spark = docs.sparkSession
    cache = cache or new_folder(spark, "token-counts")
    version = version_of(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    content = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\x0B\f\r]+", " ")
    digest = F.sha2(content.cast("binary"), 256)
    stored = spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version).select("digest")
    # copies are reduced to one text before the shuffle, so a content that most rows share is no hot key
    distinct = docs.select(digest.alias("digest"), content.alias("content")).groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(stored, "digest", "left_anti")
    (
        misses.mapInArrow(_encode(tokenizer), "digest string, n_tokens bigint")
        .select(F.lit(version).alias("version"), "digest", "n_tokens")
        .write.mode("append").parquet(cache)
    )
    counts = (
        spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    rows = docs.select(F.col(doc).alias(doc), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), digest.alias("digest"))
    return rows.join(counts, "digest").select(doc, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
