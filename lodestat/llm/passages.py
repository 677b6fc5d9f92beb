"""Repeated passages by collinear chaining of shared k-mer seeds.

Seeds are runs of ``K`` words, chosen by winnowing: of ``WINDOW`` runs that follow one another the one with the smallest
hash is a seed, so any two texts that share K + WINDOW - 1 words share a seed. Every occurrence of a seed is joined to its
first one (smallest id, then place), so a passage of very many documents makes one row an occurrence, never pairs. The first
document with a seed need not be one with the passage around it, so the same is done for the longer runs, of ``SPANS``
words, that begin at each seed: a passage whose parts lie in several earlier documents still meets one that has it whole. The
seeds that a document shares with an earlier one are chained in order: a Fenwick tree finds the best chain before each seed
under a cost for the gap. Chains are then aligned word by word, and stretched at both ends, to fuzzy passages. An aligned
chain that is not alike enough as a whole is cut at its gaps, and each part that is long and alike enough is a passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.batches import WORD_SLAB_BYTES, Words, lists, lowered, mix, odd_constants, slabs, space_words, text_bytes
from lodestat.llm.shared import written
from lodestat.session import broadcast_if_small

K = 8
WINDOW = 16
SPANS = (24, 50)  # words of the longer runs that are joined, each from a seed on
MIN_WORDS = 50
IDENTITY = 0.8
GAP_COST = 0.1
LONGEST_GAP = 64  # words between two seeds of one passage
MARGIN = 2 * (K + WINDOW)  # words around a chain that the alignment may stretch into


def _words(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    return Words(lowered(data), offsets, space_words())


def _seeds(batches):
    """Task function: (id, seeds<pos, hash, long0, long1>) of each whole text; long<i> is of SPANS[i] words, null beyond the end."""
    for slab in slabs(batches, "text", WORD_SLAB_BYTES):
        words = _words(slab.column("text"))
        first, hashes = words.grams(K)
        chosen = np.zeros(len(first), bool)
        n = len(first) - WINDOW + 1
        if n > 0:
            low, span = hashes, 1
            while span < WINDOW:
                low = np.minimum(low[: len(low) - span], low[span:])
                span *= 2
            whole = words.doc[first[:n]] == words.doc[first[WINDOW - 1 :]]
            for j in range(WINDOW):
                chosen[j : j + n] |= whole & (hashes[j : j + n] == low[:n])
        owner = words.doc[first]
        few = np.bincount(owner, minlength=words.docs) < WINDOW  # shorter than a window: all seeds
        chosen |= few[owner]
        first, hashes, owner = first[chosen], hashes[chosen], owner[chosen]
        longer = [_runs_from(words, first, size) for size in SPANS]
        seeds = pa.StructArray.from_arrays(
            [pa.array(words.position()[first], pa.int32()), pa.array(hashes.view(np.int64)), *longer], names=["pos", "hash", *(f"long{i}" for i in range(len(SPANS)))]
        )
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words.docs))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([slab.column("id"), pa.ListArray.from_arrays(pa.array(offsets), seeds)], names=["id", "seeds"])


def _runs_from(words: Words, first: np.ndarray, size: int) -> pa.Array:
    """32-bit hashes of the ``size`` words from each given one on, null where the text ends before. Used beside a seed's hash."""
    whole = words.position()[first] + size <= words.count[words.doc[first]]
    total = np.zeros(int(whole.sum()), np.uint64)
    for j, factor in enumerate(odd_constants(size, 1001 + size)):
        total += mix(words.hash[first[whole] + j] * factor + np.uint64(j))
    out = np.zeros(len(first), np.int32)
    out[whole] = (mix(total) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return pa.array(out, mask=~whole)


def best_chains(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Chains of seeds (x ascending), as positions: both coordinates grow along a chain, and no seed is in two chains.

    score(i) = K + max(0, max score(j) - GAP_COST * ((x_i - x_j) + (y_i - y_j))) over j before i in both coordinates. The
    cost splits into a part of i and one of j, so a Fenwick tree of prefix maxima over y gives the best j.
    """
    n = len(x)
    ranks = np.searchsorted(np.unique(y), y) + 1
    size = int(ranks.max())
    best, best_at = [-1e300] * (size + 1), [-1] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and x[j] == x[i]:  # seeds at one x can't follow each other: ask first, then enter
            r, top, at = int(ranks[j]) - 1, -1e300, -1
            while r > 0:
                if best[r] > top:
                    top, at = best[r], best_at[r]
                r -= r & -r
            gain = top - GAP_COST * float(x[j] + y[j])
            score[j], before[j] = (K + gain, at) if at >= 0 and gain > 0 else (float(K), -1)
            j += 1
        for m in range(i, j):
            value, r = score[m] + GAP_COST * float(x[m] + y[m]), int(ranks[m])
            while r <= size:
                if value > best[r]:
                    best[r], best_at[r] = value, m
                r += r & -r
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: (-score[m], m)):
        chain, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append(m)
            m = before[m]
        if chain:
            out.append(np.array(chain[::-1]))
    return out


def _chains(min_words: int):
    """Task function over rows sorted by (id, first, pos): chains long enough to become a passage."""
    need = min_words - 2 * (WINDOW - 1)

    def of_pair(own, first, x, y):
        if x.max() - x.min() + K < need:
            return
        for chain in best_chains(x, y):
            cx, cy = x[chain], y[chain]
            cuts = np.flatnonzero((np.diff(cx) > LONGEST_GAP) | (np.diff(cy) > LONGEST_GAP)) + 1
            for part in np.split(np.arange(len(chain)), cuts):
                if cx[part[-1]] + K - cx[part[0]] >= need:
                    yield own, first, cx[part].tolist(), cy[part].tolist()

    def flush(table: pa.Table):
        ids, first = table.column("id").to_numpy(), table.column("first").to_numpy()
        x, y = table.column("pos").to_numpy().astype(np.int64), table.column("first_pos").to_numpy().astype(np.int64)
        edges = np.flatnonzero((np.diff(ids) != 0) | (np.diff(first) != 0)) + 1
        rows = [r for a, b in zip([0, *edges], [*edges, len(ids)]) for r in of_pair(int(ids[a]), int(first[a]), x[a:b], y[a:b])]
        for i in range(0, len(rows), 1024):
            own, other, xs, ys = zip(*rows[i : i + 1024])
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array(other, pa.int64()), pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32()))],
                names=["id", "first", "xs", "ys"],
            )

    def run(batches):
        held: list[pa.RecordBatch] = []  # rows of a document that the next batch may go on with
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column("id").to_numpy()
            begin = int(np.searchsorted(ids, ids[-1])) if ids[0] != ids[-1] else 0
            if held and (begin > 0 or held[-1].column("id")[0].as_py() != ids[0]):
                yield from flush(pa.Table.from_batches([*held, batch.slice(0, begin)]))
                held = []
            elif begin > 0:
                yield from flush(pa.Table.from_batches([batch.slice(0, begin)]))
            held.append(batch.slice(begin))
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def _cut_words(batches):
    """Task function: hashes of the words low <= place < high of a text, and how many words it has."""
    for slab in slabs(batches, "text", WORD_SLAB_BYTES):
        words = _words(slab.column("text"))
        low, high = (slab.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        begin = words.first[:-1] + np.minimum(low, words.count)
        end = words.first[:-1] + np.minimum(high, words.count)
        at = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)]) if len(begin) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [slab.column("id"), slab.column("low"), slab.column("high"), lists(words.hash[at].view(np.int64), np.concatenate([[0], np.cumsum(end - begin)]), pa.int64())],
            names=["id", "low", "high", "words"],
        )


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that an alignment of two short gaps matches (longest common subsequence)."""
    if len(a) == 0 or len(b) == 0:
        return 0
    row = np.zeros(len(b) + 1, np.int32)
    for w in a:
        diagonal = row[:-1] + (b == w)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], diagonal))
    return int(row[-1])


def _stretch(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two word rows that begin together go on together: (words, matches), a mismatch costs two matches."""
    n = min(len(a), len(b))
    if n == 0:
        return 0, 0
    equal = a[:n] == b[:n]
    total = np.cumsum(np.where(equal, 1, -2))
    far = int(total.argmax())
    return (far + 1, int(equal[: far + 1].sum())) if total[far] > 0 else (0, 0)


def align(xs: np.ndarray, ys: np.ndarray, a: np.ndarray, b: np.ndarray, a0: int, b0: int) -> tuple[int, int, int, int, int]:
    """(start, end, first start, first end, matched words) of a chain on the words ``a`` (from place a0) and ``b`` (from b0)."""
    x, y = xs - a0, ys - b0
    matched, px, py = 0, int(x[0]), int(y[0])  # aligned so far up to px, py
    for sx, sy in zip(x.tolist(), y.tolist()):
        if sx < px or sy < py:  # overlaps the seed before: only what is new on both sides
            more = max(px - sx, py - sy)
            sx, sy = sx + more, sy + more
            length = K - more
        else:
            length = K
        if length <= 0:
            continue
        gap_a, gap_b = a[px:sx], b[py:sy]
        matched += int(len(gap_a)) if len(gap_a) == len(gap_b) and np.array_equal(gap_a, gap_b) else _common(gap_a, gap_b)
        matched += int((a[sx : sx + length] == b[sy : sy + length]).sum())
        px, py = sx + length, sy + length
    left, left_matched = _stretch(a[: int(x[0])][::-1], b[: int(y[0])][::-1])
    right, right_matched = _stretch(a[px:], b[py:])
    return int(x[0]) - left + a0, px + right + a0, int(y[0]) - left + b0, py + right + b0, matched + left_matched + right_matched


def _lcs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, what is equal at the two ends first."""
    n = min(len(a), len(b))
    if n == 0:
        return []
    head, tail = a[:n] == b[:n], a[::-1][:n] == b[::-1][:n]
    front = n if head.all() else int(head.argmin())
    back = min(n - front, n if tail.all() else int(tail.argmin()))
    u, v = a[front : len(a) - back], b[front : len(b) - back]
    table = np.zeros((len(u) + 1, len(v) + 1), np.int32)
    for i, w in enumerate(u):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + (v == w)))
    i, j, middle = len(u), len(v), []
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            middle.append((front + i, front + j))
    return [(i, i) for i in range(front)] + middle[::-1] + [(len(a) - back + i, len(b) - back + i) for i in range(back)]


def _runs(xs: np.ndarray, ys: np.ndarray, a: np.ndarray, b: np.ndarray, a0: int, b0: int) -> np.ndarray:
    """Runs (place in a, place in b, words) of equal words of the same alignment as ``align`` makes, in order."""
    x, y = (xs - a0).tolist(), (ys - b0).tolist()
    px, py, places = x[0], y[0], []
    for sx, sy in zip(x, y):
        more = max(px - sx, py - sy, 0)
        sx, sy, length = sx + more, sy + more, K - more
        if length <= 0:
            continue
        places += [(px + i, py + j) for i, j in _lcs(a[px:sx], b[py:sy])]
        places += [(sx + i, sy + i) for i in np.flatnonzero(a[sx : sx + length] == b[sy : sy + length]).tolist()]
        px, py = sx + length, sy + length
    left, right = _stretch(a[: x[0]][::-1], b[: y[0]][::-1])[0], _stretch(a[px:], b[py:])[0]
    before = [(x[0] - i, y[0] - i) for i in range(left, 0, -1) if a[x[0] - i] == b[y[0] - i]]
    behind = [(px + i, py + i) for i in range(right) if a[px + i] == b[py + i]]
    at = np.array(before + places + behind, np.int64).reshape(-1, 2)
    edges = np.flatnonzero((np.diff(at, axis=0) != 1).any(axis=1)) + 1
    starts = np.concatenate([[0], edges]).astype(np.int64)
    return np.column_stack([at[starts], np.diff(np.append(starts, len(at)))])


def segments(runs: np.ndarray, min_words: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """Parts (start, end, first start, first end, matched) of an alignment, from a run to a run, that are long and alike enough.

    The longest part comes first, then those to its left and right. Ends that the rest of a part does not carry (a match is
    worth 1, a word beside it costs 2, as in ``_stretch``) are left off, unless the part would get too short by that.
    """
    out, todo = [], [(0, len(runs))]
    x, y, n = runs.T
    total = np.concatenate([[0], np.cumsum(n)])

    def fits(i, j):  # runs i to j, both included; j may be an array
        matched, own, other = total[j + 1] - total[i], x[j] + n[j] - x[i], y[j] + n[j] - y[i]
        return (own >= min_words) & (matched >= identity * np.maximum(own, other)), own

    while todo:
        low, high = todo.pop()
        best = (0, -1, -1)
        for i in range(low, high):
            if x[high - 1] + n[high - 1] - x[i] <= best[0]:
                break
            good, own = fits(i, np.arange(i, high))
            at = np.flatnonzero(good)
            if len(at) and own[at[-1]] > best[0]:
                best = (int(own[at[-1]]), i, i + int(at[-1]))
        if best[1] < 0:
            continue
        i, j = best[1:]
        # the best part within under match 1, mismatch -2
        gap = np.maximum(x[i + 1 : j + 1] - (x[i:j] + n[i:j]), y[i + 1 : j + 1] - (y[i:j] + n[i:j]))
        score, begin, top = 0, i, (-1, i, j)
        for r in range(i, j + 1):
            score -= 2 * int(gap[r - i - 1]) if r > i else 0
            if score <= 0:
                score, begin = 0, r
            score += int(n[r])
            if score > top[0]:
                top = (score, begin, r)
        if fits(top[1], np.array(top[2]))[0]:
            i, j = top[1:]
        out.append((int(x[i]), int(x[j] + n[j]), int(y[i]), int(y[j] + n[j]), int(total[j + 1] - total[i])))
        todo += [(low, i), (j + 1, high)]
    return sorted(out)


def _aligned(min_words: int, identity: float):
    def run(batches):
        names = ["id", "start_word", "end_word", "first", "first_start", "first_end", "matched", "identity"]
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                own, first, xs, ys, low, flow = (batch.column(c)[r].as_py() for c in ("id", "first", "xs", "ys", "low", "flow"))
                a, b = (batch.column(c)[r].values.to_numpy() for c in ("words", "fwords"))
                s, e, fs, fe, matched = align(np.array(xs), np.array(ys), a, b, low, flow)
                share = matched / max(e - s, fe - fs, 1)
                if e - s >= min_words and share >= identity:
                    rows.append((own, s, e, first, fs, fe, matched, share))
                elif e - s >= min_words:
                    for s, e, fs, fe, matched in segments(_runs(np.array(xs), np.array(ys), a, b, low, flow), min_words, identity):
                        rows.append((own, s + low, e + low, first, fs + flow, fe + flow, matched, matched / max(e - s, fe - fs)))
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 7 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def passages(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, identity: float = IDENTITY) -> DataFrame:
    """One row per passage of at least ``min_words`` words that repeats one of a document with a smaller id.

    Columns: id, start_word, end_word (without), first_<id>, first_start, first_end, matched, identity. Words lie between
    ASCII white space, lower-case for A-Z. ``identity``: matched words over the longer side. The smallest id that holds a
    passage has no row for it. Ids are unique integers; rows without id or text, and texts of fewer than K words, give no
    row; rows that repeat id and text count once.
    """
    rows = docs.filter(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).cast("bigint").alias("id"), F.col(text).alias("text"))
    seeds = (
        rows.mapInArrow(_seeds, "id bigint, seeds array<struct<pos:int,hash:bigint,long0:int,long1:int>>")
        .select("id", F.explode("seeds").alias("s")).select("id", "s.*")
    )
    seeds = written(seeds, "seeds", texts=True)
    firsts = (
        seeds.groupBy("hash").agg(F.min(F.struct("id", "pos")).alias("f"), F.max("id").alias("last"))
        .filter(F.col("f.id") < F.col("last")).select("hash", F.col("f.id").alias("first"), F.col("f.pos").alias("first_pos"))
    )
    shared = written(seeds.join(firsts, "hash"), "shared")
    matches = shared.filter("id > first").select("id", "first", "pos", "first_pos")
    for i, size in enumerate(SPANS):
        # only where the longer run is first held at another place than its seed is; that place is new
        key = ["hash", f"long{i}"]
        held = (
            shared.filter(F.col(f"long{i}").isNotNull()).groupBy(*key)
            .agg(F.min(F.struct("id", "pos")).alias("f"), F.max("id").alias("last"), F.min(F.struct("first", "first_pos")).alias("seed"))
            .filter((F.col("f.id") < F.col("last")) & ((F.col("f.id") != F.col("seed.first")) | (F.col("f.pos") != F.col("seed.first_pos"))))
            .select(*key, F.col("f.id").alias("holder"), F.col("f.pos").alias("holder_pos"))
        )
        step = F.explode(F.array(F.lit(0), F.lit(size - K))).alias("step")  # a longer run is the pair of seeds at its two ends
        more = shared.select("id", "pos", *key).join(broadcast_if_small(written(held, "held")), key).filter("id > holder").select("id", "holder", "pos", "holder_pos", step)
        matches = matches.unionByName(
            more.select("id", F.col("holder").alias("first"), (F.col("pos") + F.col("step")).alias("pos"), (F.col("holder_pos") + F.col("step")).alias("first_pos"))
        )
    # one document's seeds in one task; a first document that very many others share is no key here
    sorted_ = matches.repartition("id").distinct().sortWithinPartitions("id", "first", "pos", "first_pos")
    chains = written(sorted_.mapInArrow(_chains(min_words), "id bigint, first bigint, xs array<int>, ys array<int>"), "chains")
    around = lambda c: (F.greatest(F.get(c, F.lit(0)) - MARGIN, F.lit(0)), F.element_at(c, -1) + K + MARGIN)
    low, high = around("xs")
    flow, fhigh = around("ys")
    chains = chains.select("id", "first", "xs", "ys", low.alias("low"), high.alias("high"), flow.alias("flow"), fhigh.alias("fhigh"))
    asked = chains.select("id", "low", "high").unionByName(chains.select(F.col("first").alias("id"), F.col("flow").alias("low"), F.col("fhigh").alias("high"))).distinct()
    asked = written(asked, "asked")
    parts = rows.join(broadcast_if_small(asked), "id").mapInArrow(_cut_words, "id bigint, low int, high int, words array<bigint>")
    parts = written(parts.dropDuplicates(["id", "low", "high"]), "parts", texts=True)
    firsts_of = parts.select(F.col("id").alias("first"), F.col("low").alias("flow"), F.col("high").alias("fhigh"), F.col("words").alias("fwords"))
    both = chains.join(parts, ["id", "low", "high"]).join(firsts_of, ["first", "flow", "fhigh"])
    found = both.select("id", "first", "xs", "ys", "low", "flow", "words", "fwords").mapInArrow(
        _aligned(min_words, identity), "id bigint, start_word bigint, end_word bigint, first bigint, first_start bigint, first_end bigint, matched bigint, identity double"
    )
    return found.withColumnRenamed("id", doc).withColumnRenamed("first", f"first_{doc}")


def _without(columns: list[str], text: str):
    def run(batches):
        for slab in slabs(batches, text, WORD_SLAB_BYTES):
            at = slab.schema.get_field_index(text)
            data, offsets = text_bytes(slab.column(at))
            words = Words(lowered(data), offsets, space_words())
            raw, out = data.tobytes(), []
            for r, spans in enumerate(slab.column("_spans").to_pylist()):
                begin, end = int(offsets[r]), int(offsets[r + 1])
                left, here, count = [], begin, int(words.count[r])
                for s in sorted(spans or [], key=lambda s: s["start_word"]):
                    a = int(words.start[words.first[r] + s["start_word"]])
                    b = int(words.start[words.first[r] + s["end_word"]]) if s["end_word"] < count else end
                    if b > here:
                        left.append(raw[here : max(a, here)])
                        here = b
                out.append((b"".join(left) + raw[here:end]).decode("utf-8"))
            new = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([new if c == text else slab.column(c) for c in columns], names=columns)

    return run


def without_passages(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut out of its text; the first occurrence stays. All rows stay."""
    spans = written(passages(docs, doc, text).select(F.col(doc).alias("_id"), "start_word", "end_word"), "passages")
    each = written(spans.groupBy("_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("_spans")), "spans")
    rows = docs.join(broadcast_if_small(each), docs[doc] == each["_id"], "left")
    touched = rows.filter(F.col("_spans").isNotNull()).select(*docs.columns, "_spans")
    return rows.filter(F.col("_spans").isNull()).select(*docs.columns).unionByName(touched.mapInArrow(_without(docs.columns, text), docs.schema))
