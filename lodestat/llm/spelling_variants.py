"""Spelling variants by finite-state composition.

The vocabulary (distinct words and their counts) is cut into partitions by the first ``PREFIX`` code points: the states
that the vocabulary acceptor reaches from its initial state. Each partition builds the minimised acyclic acceptor of its
words' tails (incremental construction over sorted words, with a register of equivalent states) and composes it with a
one-edit transducer and the acceptor again: for each word, a walk of the acceptor along the word that may, once, skip a
symbol of the word (deletion), take another transition (substitution) or take a transition without reading (insertion),
and must end in a final state after the rest of the word. That enumerates every pair of vocabulary words one edit apart
whose edit lies behind the prefix. Edits inside the prefix change the partition; they are found by joins on the word with
that one position taken out (equal keys: a replacement at that position; a key equal to a word: a deletion), whose groups
hold at most one word per symbol of the alphabet.

Edge cases: null text has no runs; words shorter than ``MIN_LENGTH`` or seen once are no words; an empty table or one
without words gives no rows; ties of counts go to the word first in code-point order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.shared import written

# fixed values of the contract: runs, the letters lowered, the deletion rule, sizes and the form ratio
RUN = "[A-Za-z\u00C0-\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETE_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10

PREFIX = 2  # code points that name a partition of the acceptor; edits inside them are found by joins


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs lower-cased in A-Z, a code point deleted where the checksum says so, kept at 7 points and 2 uses."""
    runs = docs.select(F.col(doc_id).alias("d"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({RUN})"), F.lit(1))).alias("r"))
    low = F.translate("r", UPPER, LOWER)
    runs = runs.select(low.alias("w"), F.crc32(F.concat(F.col("d").cast("string"), F.lit(":"), low).cast("binary")).alias("h"))
    at = "cast(h % length(w) as int)"
    cut = F.expr(f"CASE WHEN h % {DELETE_EVERY} = 0 THEN concat(substring(w, 1, {at}), substring(w, {at} + 2)) ELSE w END")
    found = runs.select(cut.alias("word")).filter(F.length("word") >= MIN_LENGTH)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)


class Acceptor:
    """Minimised acyclic automaton of sorted strings: ``edges[s]`` maps a symbol to a state, ``final`` holds the ends."""

    def __init__(self, sorted_words: list[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        register: dict[tuple, int] = {}
        path: list[int] = [0]  # states along the last word added, not yet in the register
        last = ""
        for word in sorted_words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            self._shrink(path, last, common, register)
            state = path[common]
            for symbol in word[common:]:
                self.edges.append({})
                self.final.append(False)
                self.edges[state][symbol] = len(self.edges) - 1
                state = len(self.edges) - 1
                path.append(state)
            self.final[state] = True
            last = word
        self._shrink(path, last, 0, register)

    def _shrink(self, path: list[int], word: str, keep: int, register: dict) -> None:
        """Replace the states of ``path`` beyond ``keep`` by equivalent registered ones, deepest first."""
        while len(path) > keep + 1:
            child = path.pop()
            parent, symbol = path[-1], word[len(path) - 1]
            signature = (self.final[child], tuple(sorted(self.edges[child].items())))
            same = register.get(signature)
            if same is None:
                register[signature] = child
            else:
                self.edges[parent][symbol] = same

    def reads(self, state: int, rest: str) -> bool:
        edges = self.edges
        for symbol in rest:
            state = edges[state].get(symbol, -1)
            if state < 0:
                return False
        return self.final[state]

    def one_edit(self, word: str) -> set[str]:
        """All accepted strings one insertion, deletion or replacement away from ``word``: the composition, walked."""
        out: set[str] = set()
        state, edges = 0, self.edges
        for i in range(len(word) + 1):
            rest = word[i:]
            if rest and self.reads(state, rest[1:]):
                out.add(word[:i] + rest[1:])
            for symbol, after in edges[state].items():
                if self.reads(after, rest):
                    out.add(word[:i] + symbol + rest)
                if rest and symbol != rest[0] and self.reads(after, rest[1:]):
                    out.add(word[:i] + symbol + rest[1:])
            if i == len(word):
                break
            state = edges[state].get(word[i], -1)
            if state < 0:
                break
        out.discard(word)
        return out


def _composed(prefix: int):
    """Task function over partitions sorted by (part, word): pairs of each part's words one edit apart behind the prefix."""

    def pairs_of(part: list[str]):
        tails = [w[prefix:] for w in part]
        acceptor = Acceptor(tails)
        head = part[0][:prefix]
        for w, tail in zip(part, tails):
            for other in acceptor.one_edit(tail):
                yield w, head + other

    def run(batches):
        part, key = [], None
        for batch in batches:
            for k, w in zip(batch.column("part").to_pylist(), batch.column("word").to_pylist()):
                if k != key and part:
                    yield from _emit(pairs_of(part))
                    part = []
                key = k
                part.append(w)
        if part:
            yield from _emit(pairs_of(part))

    return run


def _emit(pairs, size: int = 65_536):
    a, b = [], []
    for x, y in pairs:
        a.append(x)
        b.append(y)
        if len(a) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["word", "near"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["word", "near"])


def near_pairs(vocabulary: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """Directed pairs (word, near) of vocabulary words one edit apart, each pair in both directions, once."""
    parts = vocabulary.select("word", F.substring("word", 1, prefix).alias("part"))
    parts = parts.repartition("part").sortWithinPartitions("part", "word")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("near", T.StringType())])
    behind = parts.mapInArrow(_composed(prefix), schema)
    # edits at a position j inside the prefix: the word with position j taken out
    keys = [
        vocabulary.select("word", F.lit(j).alias("j"), F.concat(F.substring("word", 1, j), F.expr(f"substring(word, {j + 2})")).alias("key"))
        for j in range(prefix)
    ]
    holes = keys[0]
    for more in keys[1:]:
        holes = holes.unionByName(more)
    holes = written(holes, "spelling-holes")
    a, b = holes.alias("a"), holes.alias("b")
    replaced = a.join(b, (F.col("a.j") == F.col("b.j")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.word") != F.col("b.word")))
    replaced = replaced.select(F.col("a.word").alias("word"), F.col("b.word").alias("near"))
    shorter = holes.join(vocabulary.select(F.col("word").alias("near")), F.col("key") == F.col("near")).select("word", "near")
    longer = shorter.select(F.col("near").alias("word"), F.col("word").alias("near"))
    return behind.unionByName(replaced).unionByName(shorter).unionByName(longer).distinct()


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """Per word: n, n_near, form (near word of largest n if at least ten times the word's), form_n, root (forms followed)."""
    vocabulary = written(words(docs, doc_id, text), "spelling-words")
    pairs = near_pairs(vocabulary, prefix)
    counted = pairs.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("best"))
    table = vocabulary.join(best, "word", "left")
    strong = -F.col("best.neg") >= FORM_RATIO * F.col("n")
    table = table.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.neg")).cast("bigint").alias("form_n"),
    )
    table = written(table, "spelling-forms")
    return _roots(table)


def _roots(table: DataFrame) -> DataFrame:
    """Follow forms to the end by pointer jumping; a form's count is ten times the word's, so chains are short and acyclic."""
    step = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        nxt = step.alias("s").join(step.alias("t"), F.col("s.root") == F.col("t.word"), "left")
        nxt = nxt.select(F.col("s.word").alias("word"), F.coalesce(F.col("t.root"), F.col("s.root")).alias("root"))
        nxt = written(nxt, "spelling-roots")
        moved = nxt.alias("a").join(step.alias("b"), "word").filter(F.col("a.root") != F.col("b.root")).limit(1).count()
        step = nxt
        if not moved:
            break
    return table.join(step, "word").select("word", "form", "root", "n", "n_near", "form_n")
