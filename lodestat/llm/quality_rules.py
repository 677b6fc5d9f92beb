"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes for (1) or against (-1) a document or abstains (0). Expectation-maximisation over the counts of vote
patterns estimates how often each rule votes so on good and on bad documents; the posterior probability of "good" then
decides. The patterns are at most 3 ** rules rows, whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.shared import written
from lodestat.session import cut_lineage

SPACE = r"[ \t\n\x0B\f\r]+"
SYMBOLS = "#*$%&|<>"
ROUNDS = 40
TOLERANCE = 1e-3
POS_BITS = 26  # words of a text: up to 67 million

# Frequent short words of English, German, French and Spanish.
COMMON = (
    "the of and to in is that it for was on with as be at by this are or from an "
    "der die und den von mit das des auf für ist im nicht ein eine als auch es sich dem zu "
    "le la les et des que qui dans pour par sur une un est au du de en pas il "
    "el los las y se con una por del al lo como más su que"
).split()


def _at(array: str, place: Column) -> Column:
    """Element or null outside the array."""
    return F.get(F.col(array), place)


def base_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts (id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_common) of each whole
    text, one row per input row. Null and empty texts have zeros.

    Repeated 3-word windows: a window's hash prefix and place share one 64-bit number, so sorting numbers brings equal
    windows together; those that may be repeated are then compared word by word, so no count rests on a hash.
    """
    low = (1 << POS_BITS) - 1
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc).alias("id"), whole.alias("text")).withColumn("words", F.filter(F.split("text", SPACE, -1), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    word = lambda i: F.get(F.col("words"), i)
    packed = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")),
    )
    prefix = lambda x: F.shiftright(x, POS_BITS)
    rows = (
        rows.withColumn("lines", lines)
        .withColumn("packed", F.when(F.size("words") >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
        .withColumn(
            "maybe",
            F.filter("packed", lambda x, i: (prefix(x) == prefix(_at("packed", i - 1))) | (prefix(x) == prefix(_at("packed", i + 1)))),
        )
        .withColumn("maybe", F.transform("maybe", lambda x: x.bitwiseAND(F.lit(low)).cast("int")))
        .withColumn("windows", F.sort_array(F.transform("maybe", lambda p: F.struct(F.array(word(p), word(p + 1), word(p + 2)).alias("w"), p.alias("p")))))
        .withColumn("repeats", F.filter("windows", lambda x, i: (x["w"] == _at("windows", i - 1)["w"]) | (x["w"] == _at("windows", i + 1)["w"])))
        .withColumn("places", F.sort_array(F.transform("repeats", lambda x: x["p"])))
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    common = F.array_intersect("words", F.array(*[F.lit(w) for w in dict.fromkeys(COMMON)]))
    count = lambda c: c.cast("bigint")
    return rows.select(
        "id",
        count(F.size("words")).alias("n_words"),
        count(F.length(F.array_join("words", ""))).alias("word_chars"),
        count(F.regexp_count("text", F.lit(f"[{SYMBOLS}]"))).alias("n_symbols"),
        count(F.size("lines")).alias("n_lines"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        count(covered).alias("n_repeat_words"),
        count(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_capitals"),
        count(F.size(common)).alias("n_common"),
    )


def votes() -> dict[str, Column]:
    """The rules: 1 speaks for the document, -1 against it, 0 abstains. Texts of under 20 words get abstentions only."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def by(value: Column, good: float, bad: float) -> Column:
        return F.when(F.col("n_words") < 20, 0).when(value <= good, 1).when(value > bad, -1).otherwise(0)

    mean = F.col("word_chars") / words
    return {
        "symbols": by(F.col("n_symbols") / words, 0.05, 0.1),
        "lines": by(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.1, 0.3),
        "repeats": by(F.col("n_repeat_words") / words, 0.1, 0.3),
        "capitals": by(F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)), 0.1, 0.3),
        "length": F.when(F.col("n_words") < 20, 0).when(mean.between(3, 10), 1).when(~mean.between(2, 15), -1).otherwise(0),
        "common": by(-F.col("n_common") / F.least(words, F.lit(200)), -0.03, -0.01),
    }


def posterior(patterns: DataFrame, rules: list[str]) -> Column:
    """Expectation-maximisation over (votes, rows); gives the posterior of "good" as a column over the votes.

    Start: good unless a rule speaks against. Each round is one aggregate with one row of sums; counts are smoothed by one.
    Without any row the posterior is 1/2 everywhere.
    """
    against = F.exists(F.array(*rules), lambda v: v == -1)
    good = F.when(against, 0.1).otherwise(0.9)
    last: list[float] = []
    for _ in range(ROUNDS):
        weight, rest = F.col("weight"), F.col("rest")
        cells = [F.sum(F.when(F.col(r) == v, w).otherwise(0.0)) for r in rules for v in (-1, 0, 1) for w in (weight, rest)]
        sums = [x or 0.0 for x in patterns.withColumn("weight", F.col("rows") * good).withColumn("rest", F.col("rows") - F.col("weight")).agg(F.sum(weight), F.sum(rest), *cells).collect()[0]]
        total, cell = sums[:2], iter(sums[2:])
        odds = F.lit(math.log((total[0] + 1) / (total[1] + 1)))
        found = [total[0], total[1]]
        for r in rules:
            ratio = {}
            for v in (-1, 0, 1):
                p, q = (next(cell) + 1) / (total[0] + 3), (next(cell) + 1) / (total[1] + 3)
                ratio[v] = math.log(p / q)
                found += [p, q]
            odds = odds + F.when(F.col(r) == -1, ratio[-1]).when(F.col(r) == 1, ratio[1]).otherwise(ratio[0])
        good = 1 / (1 + F.exp(-odds))
        if last and max(abs(a - b) / (1 + abs(a)) for a, b in zip(found, last)) < TOLERANCE:
            break
        last = found
    return good


def judge(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base_failed, votes, posterior quality and kept, one row per input row.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept: not base_failed and
    posterior of at least 1/2. Null and empty texts fail. The rules' accuracies are estimated over all rows.
    """
    rules = votes()
    counts = written(base_counts(docs, doc, text).withColumns({f"vote_{r}": v for r, v in rules.items()}), "quality-counts")
    names = [f"vote_{r}" for r in rules]
    patterns = cut_lineage(counts.groupBy(*names).agg(F.count("*").alias("rows")).coalesce(1))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counts.withColumn("quality", posterior(patterns, names))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= 0.5))
        .withColumnRenamed("id", doc)
    )
