"""Conversation prefix trie, backtracking BPE and spelling variants against brute force and the tokenizers library."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestat.llm import backtrack_bpe, prefix_trie, registered, spelling_variants

from conftest import FOLDER

CONV = "conv_id bigint, turn bigint, role string, text string, key int, words string"


def brute_trie(rows):
    own = {}
    for c, t, r, x in rows:
        own.setdefault(c, []).append((t is not None, t if t is not None else 0, r or "", x or ""))
    seq = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {c: tuple(seq.get(c - c % 20, [])[: zlib.crc32(str(c).encode()) % 4]) + tuple(seq[c][zlib.crc32(str(c).encode()) % 4 :]) for c in seq}
    nodes, kids = {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))

    def sub(p):
        saved, leaves = (len(nodes[p]) - 1) * (words(p[-1][1]) if p else 0), 0 if kids.get(p) else 1
        for q in kids.get(p, []):
            a, b = sub(q)
            saved, leaves = saved + a, leaves + b
        return saved, leaves

    out = {}
    for p, m in nodes.items():
        saved, leaves = sub(p)
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out[(min(m), len(p))] = dict(
            conv_id=min(m), depth=len(p), parent_conv_id=min(nodes[p[:-1]]) if p else None, n_convs=len(m), n_children=len(kids.get(p, [])),
            n_leaves=leaves, saved_tokens=saved, ends_sha256=hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def conversation_rows():
    rows = []
    for c in range(0, 64):
        base = c % 7
        for t in range(base % 5 + 1):
            rows.append((c, t, ["user", "assistant", None][t % 3], ["hi", "hello there", None, "same answer", "x " * 50][(t + base) % 5], 1, "w"))
    rows += [(5, None, "user", "first by null", 1, "w"), (6, 2, "user", "tie b", 1, "w"), (6, 2, "user", "tie a", 1, "w"), (7, 1, "user", "hi", 1, "w"), (7, 1, "user", "hi", 1, "w")]
    rows += [(200 + i, 0, "user", "hot first turn", 1, "w") for i in range(30)] + [(200 + i, 1, "assistant", f"answer {i % 4}", 1, "w") for i in range(30)]
    rows += [(401, 5, None, None, None, None), (1000, 0, "", "", 1, "w")]
    return rows


@pytest.mark.parametrize("shard", [prefix_trie.SHARD_SEQUENCES, 1])
def test_prefix_trie(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_SEQUENCES", shard)
    for rows in (conversation_rows(), [tuple(r) + (1, "w") for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]):
        got = {(r["conv_id"], r["depth"]): r.asDict() for r in prefix_trie.trie(spark.createDataFrame(rows, CONV).repartition(3)).collect()}
        assert got == brute_trie([r[:4] for r in rows])


def test_prefix_trie_empty(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CONV)).count() == 0


def test_double_array_walks():
    import numpy as np

    seqs = [np.array(s, np.int64) for s in ([1, 2, 3], [1, 2], [2], [1, 3, 3, 1], [])]
    trie = prefix_trie.DoubleArray(seqs)
    states = {tuple(s.tolist()[:d]): trie.walk(s[:d])[-1] for s in seqs for d in range(len(s) + 1)}
    assert len(set(states.values())) == len(states)


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(registered.WORD_BPE))


def test_backtrack_bpe_equals_library(spark, table, edge, empty, word_tokenizer):
    path = public_tokenizers.path(registered.WORD_BPE)
    for rows in (table, edge, edge.unionByName(edge), empty, edge.withColumn("ids", edge["key"])):
        texts = [r["text"] for r in rows.select("text").collect()]
        got = backtrack_bpe.decode(backtrack_bpe.encode(rows, path), path)
        assert set(rows.columns) - {"text"} <= set(got.columns)
        both = backtrack_bpe.encode(rows, path, decoded="decoded").select("doc_id", "ids", "decoded").collect()
        got = got.select("doc_id", "ids", "decoded").collect()
        assert sorted(both, key=str) == sorted(got, key=str)
        assert len(got) == len(texts)
        want = sorted((word_tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts), key=str)
        assert sorted((r["ids"] for r in got), key=str) == want
        for r in got:
            assert r["decoded"] == word_tokenizer.decode(r["ids"], skip_special_tokens=False)


def test_backtrack_bpe_query(spark, word_tokenizer):
    import struct

    got = {r["doc_id"]: r for r in registered.op12_backtrack_bpe(spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = word_tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        row = got[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(word_tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_compatibility_is_symmetric_with_bpe(word_tokenizer):
    v = backtrack_bpe.vocabulary(public_tokenizers.path(registered.WORD_BPE))
    for word in ["internationalization", "aaaaaaaaaaaaaaaaaaaaa", "mississippi", "x", "ĠĠĠĠ", "ðŁĺĢ"]:
        assert [v.text[t] for t in v.encode_word(word)] == [t.value for t in word_tokenizer.model.tokenize(word)]



def test_word_memo_is_bounded_and_changes_no_ids(word_tokenizer):
    """A memo of two words a generation holds at most four and gives the same ids as a fresh encoding of every text."""
    v = backtrack_bpe.vocabulary(public_tokenizers.path(registered.WORD_BPE))
    texts = ["the cat sat on the mat", "", "mat cat the the the", "Σίσυφος and the hill", "cat " * 50]
    small = backtrack_bpe.WordMemo(2)
    for text in texts:
        assert backtrack_bpe.encode_text(v, text, small) == backtrack_bpe.encode_text(v, text, backtrack_bpe.WordMemo())
        assert len(small) <= 4
        assert backtrack_bpe.encode_text(v, text, small) == word_tokenizer.encode(text, add_special_tokens=False).ids

def brute_variants(rows):
    cnt = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{d}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                cnt[w] += 1
    vocab = {w: n for w, n in cnt.items() if n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = (a, b) if len(a) < len(b) else (b, a)
        i = 0
        while i < len(a) and a[i] == b[i]:
            i += 1
        return a[i:] == b[i + 1 :]

    out = {}
    for w, n in vocab.items():
        ns = [x for x in vocab if near(w, x)]
        best = min(ns, key=lambda x: (-vocab[x], x)) if ns else None
        form = best if best is not None and vocab[best] >= 10 * n else None
        out[w] = dict(word=w, n=n, n_near=len(ns), form=form, form_n=vocab[form] if form else None)
    for w in out:
        r = w
        while out[r]["form"] is not None:
            r = out[r]["form"]
        out[w]["root"] = r
    return out


def variant_rows():
    base = ["Spelling", "spelling", "speling", "spellling", "spekling", "Àpelling", "pelling", "aspelling"]
    rows = [(i, " ".join([base[0]] * 12 + [base[i % len(base)]] * 2 + ["Receive", "recieve", "receive"] * (1 + i % 3)), None, None) for i in range(40)]
    rows += [(100, None, "en", "a"), (101, "", "en", "a"), (102, "x" * 5000 + " " + "y" * 5000, "de", None), (102, "x" * 5000 + " " + "y" * 5000, "de", None)]
    return rows


def test_spelling_variants(spark, table, empty):
    for docs in (table, spark.createDataFrame(variant_rows(), "doc_id bigint, text string, lang string, words string")):
        got = {r["word"]: r.asDict() for r in spelling_variants.variants(docs).collect()}
        assert got == brute_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert spelling_variants.variants(empty).count() == 0


def test_acceptor_is_minimal_and_exact():
    words = sorted(["tapping", "taping", "topping", "tops", "taps", "tap", "top"])
    a = spelling_variants.Acceptor(words)
    assert all(a.reads(0, w) for w in words) and not a.reads(0, "ta") and not a.reads(0, "toppings")
    assert len(a.edges) < sum(map(len, words))
    assert a.one_edit("taping") == {"tapping"} and a.one_edit("tap") == {"top", "taps"}
