"""The operators against brute force, on the smallest table and on small awkward ones."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestat.llm import byte_bpe, fingerprints, language_id, license_scan, mixing, near_dedup, passages, quality_rules, registered, token_count, training_order

from conftest import FOLDER, SCHEMA

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ---------------------------------------------------------------- license scan


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), found


@pytest.mark.parametrize("which", ["table", "edge"])
def test_license_base(request, which):
    docs = request.getfixturevalue(which)
    got = by_id(license_scan.scan(docs))
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        n, found = license_base(r["text"])
        g, starts = got[r["doc_id"]], [i for i, _ in found]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"]) == (n, len(found), min(starts, default=None), max(starts, default=None))
        assert g["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, g["base_labels"].split(","))) <= set(g["labels"].split(",")) and 0 <= g["score"] <= 1


def test_license_fuzzy(spark, empty):
    notice = license_scan.NOTICES[1][0].split()
    changed = notice[:10] + ["really"] + notice[10:25] + notice[26:]
    docs = spark.createDataFrame([(1, "x y " + " ".join(changed)), (2, " ".join(notice[:12])), (3, " ".join(changed)), (3, " ".join(changed))], "doc_id long, text string")
    got = by_id(license_scan.scan(docs))
    assert (got[1]["labels"], got[1]["base_labels"], got[2]["labels"]) == ("mit", "", "")
    assert license_scan.COVER <= got[1]["score"] < 1 and license_scan.scan(docs).count() == 3
    assert license_scan.scan(empty).count() == 0


# ---------------------------------------------------------------- token count


def test_token_count(spark, table, edge, empty, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    cache = str(tmp_path / "cache")
    both = edge.select("doc_id", "text").unionByName(edge.select("doc_id", "text")).unionByName(table.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    got = token_count.count(both, path, cache).collect()
    assert len(got) == both.count()
    want = {r["doc_id"]: r["text"] or "" for r in both.collect()}
    for r in got:
        text = want[r["doc_id"]]
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048), r
    stored = spark.read.parquet(cache)
    norm = {re.sub(r"[ \t\n\x0b\f\r]+", " ", t) for t in want.values()}
    assert stored.count() == len(norm) == stored.select("digest").distinct().count()
    again = token_count.count(both, path, cache)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    assert spark.read.parquet(cache).count() == len(norm)  # all were hits
    # a stored count is used, not made again
    spark.createDataFrame([(token_count.version_of(path), hashlib.sha256(b"brand new").hexdigest(), 77)], token_count.CACHE).write.mode("append").parquet(cache)
    assert token_count.count(spark.createDataFrame([(1, "brand  new")], "doc_id long, text string"), path, cache).collect()[0]["n_tokens"] == 77
    assert token_count.count(empty, path).count() == 0


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(table, edge, empty, encoding):
    for docs in (table, edge, edge.unionByName(edge)):
        coded = byte_bpe.encode(docs, RANKS, PATTERN)
        got = byte_bpe.digests(coded, RANKS, PATTERN).collect()
        want = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
        assert len(got) == docs.count()
        for r in got:
            ids = encoding.encode_ordinary(want[r["doc_id"]])
            assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
        for r in byte_bpe.decode(coded, RANKS, PATTERN).select("doc_id", "decoded").collect():
            assert bytes(r["decoded"]).decode() == want[r["doc_id"]]
    assert byte_bpe.digests(byte_bpe.encode(empty, RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_byte_bpe_stitching(spark, encoding):
    rng = random.Random(4)
    alphabet = [" ", " ", "\n", "\t", "a", "b", "'", "s", "l", "1", "!", "é", " ", "\x1c", "r", "e"]
    texts = ["".join(rng.choice(alphabet[: rng.randint(2, len(alphabet))]) for _ in range(rng.randint(0, 400))) for _ in range(250)] + ["a" * 300, " " * 300, "a " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = by_id(byte_bpe.encode(docs, RANKS, PATTERN, chunk=24, overlap=8))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["ids"] == encoding.encode_ordinary(t), repr(t)


# ---------------------------------------------------------------- fingerprints


@pytest.mark.parametrize("which", ["table", "edge"])
def test_fingerprint_query(spark, request, which, tmp_path):
    docs = request.getfixturevalue(which)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = by_id(registered.op6_fingerprints(spark, folder))
    rows = sorted(docs.select("doc_id", "text").collect())
    assert len(got) == len(rows)
    prints = {}
    for r, after in zip(rows, rows[1:] + rows[:1]):
        text, follow = r["text"] or "", after["text"] or ""
        n = len(text) // 4
        g = got[r["doc_id"]]
        edited = text[: len(text) - n] + follow[:n]
        assert g["n_chars"] == len(text) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, g["fingerprint"]) == g["fingerprint"] and 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
        if edited == text:
            assert g["near_edited"] == 1 and g["fingerprint"] == g["edited_fingerprint"]
        if text == follow:
            assert g["near_next"] == 1
    long = [g for g in got.values() if g["n_chars"] > 2000]
    if which == "table":
        assert np.mean([g["near_edited"] > g["near_next"] for g in long]) > 0.95 and np.mean([g["near_edited"] for g in long]) > 0.45


def test_fingerprint_is_local():
    import pyarrow as pa

    rng = random.Random(1)
    body = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    a, b, c, d = fingerprints.sketch(pa.array([body, "some other head " + body, body[::-1], None]))
    share = lambda x, y: np.mean([x[i : i + 4] == y[i : i + 4] for i in range(0, len(x), 4)])
    assert share(a, b) > 0.9 and share(a, c) < 0.1 and set(d) == {"0"}
    one = [fingerprints.sketch(pa.array([t]))[0] for t in (body, body[:7], "x")]
    assert one == fingerprints.sketch(pa.array([body, body[:7], "x"]))  # neighbours in a batch don't matter


def test_fingerprint_ranges(spark):
    docs = spark.createDataFrame([(i * i, f"text number {i} " * 30) for i in range(3500)], "doc_id long, text string").repartition(5)
    rows, window = fingerprints.with_next(docs)
    got = {r["id"]: r["next"] for r in rows.withColumn("next", F.lead("text").over(window)).filter("own").collect()}
    assert len(got) == 3500 and all(got[i * i] == f"text number {(i + 1) % 3500} " * 30 for i in range(3500))


def test_fingerprint_empty(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert registered.op6_fingerprints(spark, str(tmp_path)).count() == 0


# ---------------------------------------------------------------- quality rules


def quality_base(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("which", ["table", "edge"])
def test_quality_rules(request, which):
    docs = request.getfixturevalue(which)
    got = by_id(quality_rules.judge(docs))
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        g, want = got[r["doc_id"]], quality_base(r["text"])
        assert tuple(g[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, r["doc_id"]
        assert g["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (g["base_failed"] and g["kept"])


def test_quality_posterior(spark, table, empty):
    labels = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/labels.parquet").withColumnRenamed("quality", "truth")
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    rows = quality_rules.judge(docs).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["truth"] == 1]
    bad = [r["kept"] for r in rows if r["truth"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.5
    assert quality_rules.judge(empty).count() == 0


# ---------------------------------------------------------------- mixing


def aims(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    free, left, out = set(sizes), 1.5 * sum(sizes.values()), {}
    while True:
        per = left / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if 2 * sizes[s] <= per * weight[s]}
        if not full:
            return out | {s: per * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        free -= full


def check_mix(docs, seed=1):
    rows = mixing.mix(docs, seed=seed).collect()
    want = docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(SPACE_WORD.findall(t or ""))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r["doc_id"], r["source"], size(r["text"])) for r in want)
    total = defaultdict(int)
    for r in want:
        total[r["source"]] += size(r["text"])
    target, taken, largest = aims(total), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in total:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
    return sorted(map(str, rows))


def test_mix(table, edge, empty):
    assert check_mix(table) == check_mix(table.repartition(7))
    check_mix(edge)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in mixing.mix(edge).collect()}
    got = Counter(r["doc_id"] for r in mixing.mixed(edge).collect())
    assert got == Counter({d: c for (d, _), c in copies.items() if c}) and mixing.mixed(edge).columns == edge.columns


def test_mix_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 10)
    monkeypatch.setattr(mixing, "FAN", 3)
    docs = spark.createDataFrame([(i, "w " * (i * 7919 % 90), "hot" if i % 3 else f"s{i % 5}") for i in range(900)], "doc_id long, text string, source string")
    check_mix(docs)
    check_mix(docs.unionByName(docs))  # all rows twice


def test_mix_expectation():
    kept = np.zeros(6)
    for seed in range(4000):
        share = np.array([0.2, 0.5, 0.9, 0.4, 0.7, 0.3])
        mixing._pivot(np.array([5.0, 3.0, 8.0, 2.0, 4.0, 6.0]), share, seed)
        kept += share
    assert np.allclose(kept / 4000, [0.2, 0.5, 0.9, 0.4, 0.7, 0.3], atol=0.03)


# ---------------------------------------------------------------- training order


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(total):
    x = training_order.slots(np.arange(total), total, 9)
    assert sorted(x.tolist()) == list(range(total))
    if total > 100:
        assert (x != training_order.slots(np.arange(total), total, 10)).any() and abs(np.corrcoef(np.arange(total), x)[0, 1]) < 0.2


def test_training_order(spark, table, edge, empty, encoding, tmp_path):
    docs = table.select("doc_id", "text").unionByName(edge.select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text"))
    ordered = training_order.materialise(byte_bpe.encode(docs, RANKS, PATTERN), key=3, length=64, shard_rows=50)
    rows = ordered.collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    ids = defaultdict(dict)
    for r in rows:
        assert (r["shard"], r["offset"], len(r["record"])) == (r["slot"] // 50, r["slot"] % 50 * 128, 128)
        record = np.frombuffer(r["record"], "<u2")
        assert (record[r["n_tokens"] :] == training_order.PAD).all()
        ids[r["doc_id"]][r["seq"]] = record[: r["n_tokens"]].tolist()
    for r in docs.collect():
        want = encoding.encode_ordinary(r["text"] or "")
        assert [t for s in sorted(ids[r["doc_id"]]) for t in ids[r["doc_id"]][s]] == want
    folder = f"file://{tmp_path}/shards"
    files = training_order.write_shards(ordered, folder).collect()
    assert sum(f["rows"] for f in files) == len(rows) and len(files) == -(-len(rows) // 50)
    for f in files:
        own = sorted((r for r in rows if r["shard"] == f["shard"]), key=lambda r: r["slot"])
        assert (tmp_path / "shards" / f"shard-{f['shard']:08d}.bin").read_bytes() == b"".join(bytes(r["record"]) for r in own)
    assert training_order.materialise(byte_bpe.encode(empty, RANKS, PATTERN), key=3).count() == 0


# ---------------------------------------------------------------- near duplicates


def brute_groups(rows):
    sets = {}
    for d, text in rows:
        w = SPACE_WORD.findall(lower(text))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    both = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                both[max(a, b), min(a, b)] += 1
    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def check_groups(docs):
    rows = docs.select("doc_id", "text").distinct().collect()
    want = brute_groups([(r["doc_id"], r["text"]) for r in rows])
    got = by_id(near_dedup.near_duplicates(docs))
    assert {d: (g["n_shingles"], g["component_id"]) for d, g in got.items()} == want
    assert all(g["kept"] == (d == g["component_id"]) for d, g in got.items())
    return want


def test_near_duplicates(spark, table, edge, empty):
    check_groups(table)
    check_groups(edge.unionByName(edge))
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.deduplicated(empty).count() == 0
    kept = near_dedup.deduplicated(edge.unionByName(edge))
    assert kept.columns == edge.columns and kept.count() == near_dedup.near_duplicates(edge).filter("kept").count()


def test_near_duplicates_hub_and_chain(spark):
    """Copies that are close to one base text only, and texts that drift: links exist only through others."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for at in rng.sample(range(300), 4):
            own[at] = f"z{i}_{at}"
        rows.append((1000 + i, " ".join(own)))
    drift = [f"d{i}" for i in range(300)]
    for i in range(20):
        drift = drift[:i * 8] + [f"q{i}_{j}" for j in range(8)] + drift[i * 8 + 8:]
        rows.append((500 + i, " ".join(drift)))
    want = check_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len({c for _, c in want.values()}) < 30


# ---------------------------------------------------------------- passages


def test_passages_planted(spark, edge, empty):
    rng = random.Random(3)
    fresh = lambda n, tag: [f"{tag}{rng.randrange(10**6)}" for _ in range(n)]
    p, q = fresh(60, "p"), fresh(90, "q")
    fuzzy = q[:30] + ["new"] + q[30:60] + q[61:]
    rows = [
        (1, fresh(40, "a") + p + fresh(20, "b")), (2, fresh(13, "c") + p), (3, p + fresh(200, "d") + q), (4, fresh(5, "e") + fuzzy + fresh(9, "f")),
        (5, fresh(300, "g")), (6, p[:30] + fresh(100, "h")), (7, q), (7, q),
    ]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["first_doc_id"]): r for r in passages.passages(docs).collect()}
    assert set(got) == {(2, 1), (3, 1), (4, 3), (7, 3)}
    assert (got[2, 1]["start_word"], got[2, 1]["end_word"], got[2, 1]["first_start"], got[2, 1]["identity"]) == (13, 73, 40, 1.0)
    assert (got[4, 3]["start_word"], got[4, 3]["end_word"], got[4, 3]["matched"]) == (5, 95, 89)
    left = {r["doc_id"]: r["text"].split() for r in passages.without_passages(docs.dropDuplicates()).collect()}
    words = dict(rows)
    assert left[1] == words[1] and left[5] == words[5] and left[6] == words[6]
    assert left[2] == words[2][:13] and left[3] == words[3][60:] and left[4] == words[4][:5] + words[4][-9:] and left[7] == []
    assert {(r["doc_id"], r["first_doc_id"]) for r in passages.passages(edge).collect()} == {(7, 6), (8, 6)}
    assert passages.passages(empty).count() == 0 and passages.without_passages(empty).count() == 0
    assert passages.without_passages(edge).columns == edge.columns and passages.without_passages(edge).count() == edge.count()


def test_passages_find_every_long_repeat(table, texts):
    """Each run of 51 words that a smaller id holds too is covered, and each row's words are really shared."""
    words = {d: lower(t).split() if (t or "").isascii() else SPACE_WORD.findall(lower(t)) for d, t in texts.items()}
    rows = passages.passages(table).collect()
    covered = defaultdict(set)
    for r in rows:
        covered[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
        a, b = words[r["doc_id"]][r["start_word"] : r["end_word"]], words[r["first_doc_id"]][r["first_start"] : r["first_end"]]
        assert sum((Counter(a) & Counter(b)).values()) >= 0.8 * len(a) and r["first_doc_id"] < r["doc_id"]
    seen = {}
    for d in sorted(words):
        w, own = words[d], {}
        for i in range(len(w) - 50):
            run = tuple(w[i : i + 51])
            if run in seen:
                assert len(set(range(i, i + 51)) - covered[d]) <= 5, (d, i, seen[run])
            own.setdefault(run, d)
        for run in own:
            seen.setdefault(run, d)


@pytest.mark.parametrize("apart", [30, 35, 45, 60])
def test_passages_apart(spark, apart):
    """Two exact passages with foreign words between them on one side are two rows, on either side."""
    rng = random.Random(apart)
    fresh = lambda n, tag: [f"{tag}{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c, d = fresh(55, "a"), fresh(55, "b"), fresh(55, "c"), fresh(55, "d")
    rows = [(1, fresh(9, "e") + a + b), (2, a + fresh(apart, "f") + b), (3, c + fresh(apart, "g") + d), (4, c + fresh(apart, "h") + d + fresh(7, "i"))]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = sorted((r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"], r["first_start"], r["matched"]) for r in passages.passages(docs).collect())
    far = 55 + apart
    assert got == [(2, 0, 55, 1, 9, 55), (2, far, far + 55, 1, 64, 55), (4, 0, 55, 3, 0, 55), (4, far, far + 55, 3, far, 55)]
    left = {r["doc_id"]: r["text"].split() for r in passages.without_passages(docs).collect()}
    assert left[2] == rows[1][1][55:far] and left[4] == rows[3][1][55:far] + rows[3][1][-7:]


@pytest.mark.parametrize("size", [60, 120])
def test_passages_with_parts_in_other_documents(spark, size):
    """Both halves of a passage lie in two smaller ids; the next two documents hold it whole."""
    rng = random.Random(size)
    fresh = lambda n, tag: [f"{tag}{rng.randrange(10**6)}" for _ in range(n)]
    docs, want = [], set()
    for n in range(12):
        p, part = fresh(size, "p"), [30, 40][n % 2]
        cuts = [p[i : i + part] for i in range(0, size, part)]
        at = 10 * n
        docs += [(at + i, fresh(8, "a") + c + fresh(8, "b")) for i, c in enumerate(cuts)]
        docs += [(at + 8, fresh(11, "c") + p + fresh(5, "d")), (at + 9, fresh(17, "e") + p)]
        want.add((at + 9, 17, 17 + size, at + 8, 11, 11 + size))
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    got = passages.passages(rows).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"], r["first_start"], r["first_end"]) for r in got} == want


def test_segments_match_brute_force():
    """The longest good part is found or is one of the parts without its poor ends; parts are good and apart."""
    rng = random.Random(8)
    for _ in range(200):
        runs, x, y = [], 0, 0
        for _ in range(rng.randint(1, 7)):
            n = rng.randint(1, 60)
            runs.append((x, y, n))
            x, y = x + n + rng.randint(0, 30), y + n + rng.randint(1, 30)
        runs = np.array(runs)
        every = [(a, b) for a in range(len(runs)) for b in range(a, len(runs))]
        size = lambda a, b: (int(runs[b, 0] + runs[b, 2] - runs[a, 0]), int(runs[b, 1] + runs[b, 2] - runs[a, 1]), int(runs[a : b + 1, 2].sum()))
        good = [(a, b) for a, b in every if size(a, b)[0] >= 50 and size(a, b)[2] >= 0.8 * max(size(a, b)[:2])]
        got = passages.segments(runs, 50, 0.8)
        assert bool(got) == bool(good)
        assert all(e - s >= 50 and m >= 0.8 * max(e - s, fe - fs) for s, e, fs, fe, m in got)
        assert all(p[1] <= q[0] and p[3] <= q[2] for p, q in zip(got, got[1:]))
        for a, b in good:  # no good part is left without a found one in it or over it
            assert any(s < runs[b, 0] + runs[b, 2] and e > runs[a, 0] for s, e, *_ in got)


def test_chains_match_quadratic():
    rng = random.Random(5)
    for _ in range(60):
        points = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randint(1, 40))})
        x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
        score = []
        for i, (a, b) in enumerate(points):
            best = max((score[j] - passages.GAP_COST * (a - points[j][0] + b - points[j][1]) for j in range(i) if points[j][0] < a and points[j][1] < b), default=0)
            score.append(passages.K + max(0, best))
        chain = passages.best_chains(x, y)[0]
        own = passages.K * len(chain) - passages.GAP_COST * float(np.diff(x[chain]).sum() + np.diff(y[chain]).sum())
        assert own == pytest.approx(max(score)) and (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()


# ---------------------------------------------------------------- language ID


def test_language(spark, edge, empty):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    got = registered.op10_language_id(spark, FOLDER.replace("0.001", "0.01")).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    model = language_id.fit(docs, "doc_id", "text", "lang", sample=200, landmarks=40)
    rows = by_id(language_id.predict(edge, model))
    assert rows[100]["lang_pred"] == "und" and rows[0]["lang_pred"] == "und" and rows[1]["score"] == 0 and rows[5]["lang_pred"] == "fr"
    assert len(rows) == edge.count() and language_id.predict(edge, model).columns == [*edge.columns, "lang_pred", "score"]
    none = language_id.fit(empty, "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language_id.predict(edge, none).collect()} == {"und"} and language_id.predict(empty, model).count() == 0
    one = language_id.fit(docs.filter("lang = 'de'"), "doc_id", "text", "lang", sample=20, landmarks=5)
    assert by_id(language_id.predict(edge, one))[5]["lang_pred"] == "de"


def test_schema_covers_all_columns():
    assert SCHEMA.count(",") == 9
