"""Named queries of the operators in this folder, each over its whole table, and SQL twins where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm import (
    backtrack_bpe, byte_bpe, fingerprints, language_id, license_scan, mixing, near_dedup, passages, prefix_trie, quality_rules, spelling_variants,
    token_count, training_order,
)
from lodestat.llm.shared import documents

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(documents(spark, sf_dir))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(documents(spark, sf_dir), ranks, pattern)
    return byte_bpe.digests(encoded, ranks, pattern)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text and an edited one: its last quarter replaced by as much of the head of the next document."""
    rows, window = fingerprints.with_next(documents(spark, sf_dir))
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    edit = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("n_chars", n).withColumn("next", F.coalesce(F.lead("text").over(window), F.lit("")))
    edited = F.concat(F.substring(text, F.lit(1), F.col("n_chars") - edit), F.substring("next", F.lit(1), edit))
    rows = rows.select("range", F.col("id").alias("doc_id"), "own", F.col("n_chars").cast("bigint").alias("n_chars"), text.alias("text"), edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keep = ["range", "doc_id", "own", "n_chars", "edited_sha256"]
    drawn = fingerprints.fingerprint(rows, {"text": "fingerprint", "edited": "edited_fingerprint"}, keep)
    after = F.lead("fingerprint").over(fingerprints.next_in_range("doc_id", "fingerprint"))
    drawn = drawn.withColumn("next_fingerprint", after).filter("own")
    pairs = [("fingerprint", "edited_fingerprint", "near_edited"), ("fingerprint", "next_fingerprint", "near_next")]
    return fingerprints.likeness(drawn, pairs, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token sequence with its slot and its place in the shards; the record itself as a digest."""
    ranks, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(documents(spark, sf_dir), ranks, pattern, then=training_order.cutting())
    ordered = training_order.materialise(encoded, key=20_240_501)
    return ordered.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(~language_id.held_out()), "doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), model, "text", ["doc_id"])
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations, with members, children, leaves, saved words and ends."""
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_backtrack_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by backtracking over longest matches, decoded through the offset table, both as digests."""
    path = public_tokenizers.path(WORD_BPE)
    encoded = backtrack_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path, decoded="decoded")
    digested = backtrack_bpe.with_digests(encoded, "ids", "ids_sha256")
    return digested.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least 7 code points seen twice, with its near words, form and root."""
    return spelling_variants.variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_token_count, op3_repeated_passages, op4_mix_sources, op5_byte_bpe, op6_fingerprints,
    op7_quality_rules, op8_training_order, op9_near_duplicates, op10_language_id, op11_prefix_trie, op12_backtrack_bpe,
    op13_spelling_variants,
)}

SQL = {
    "op9_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
d AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT d.b, r.c FROM r JOIN d ON d.a = r.doc_id)
SELECT x.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, min(r.c) = x.doc_id AS kept
FROM documents x JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY x.doc_id, n.n
""",
}
