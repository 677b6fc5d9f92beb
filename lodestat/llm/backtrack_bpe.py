"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The BPE encoding of a word is the one token sequence whose neighbouring pairs are all *compatible*: BPE, run on the two
tokens' text alone, gives back exactly those two tokens. So a word is encoded left to right: take the longest vocabulary
token that starts here (from an Aho-Corasick automaton over all token texts); if it is not compatible with the token before,
try the next shorter token that is a prefix of it; with none left, take back the token before and mark that place as no
boundary. Compatibility is decided on the tokens' merge trees, by undoing merges from the larger rank down, and remembered
in a table. Each word costs about its length in steps, and a word is encoded once per task (a memo of bounded size).

The vocabulary file is a ``tokenizers`` BPE file with word ends (``end_of_word_suffix``). Its normaliser, pre-tokeniser and
special strings are the file's own (the library applies them); only the merges are done here. Decoding joins the token texts
by the offset table, as the file's (absent) decoder does: tokens joined by one space.

Edge cases: null text is the empty text (no tokens, decoded ""); special strings inside a text become their special ids, as
the library does by default; repeated rows are encoded each; empty tables give empty results.
"""

from __future__ import annotations

import json
import os
from array import array
from itertools import chain
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.batches import slabs

MEMO_WORDS = 100_000  # encoded words in each of the two generations a worker remembers; only speed depends on it
MEMO_PAIRS = 200_000  # compatibility verdicts a worker remembers before it starts afresh
SLAB = 512 << 10  # text bytes encoded at once in a task
END_MARK = 0x10000  # a word's last symbol, with the word-end suffix, is written as this code point plus the symbol's


class Vocabulary:
    """Merge trees, compatibility table, token automaton and the offset table of one BPE file."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        size = max(vocab.values()) + 1
        # rank: a token made by merge r has rank base + r; tokens no merge makes come first, in id order
        made = {vocab[a + b]: r for r, (a, b) in enumerate(merges)}
        base = sorted(i for i in vocab.values() if i not in made)
        self.rank = np.full(size, -1, np.int64)
        self.rank[base] = np.arange(len(base))
        for token, r in made.items():
            self.rank[token] = len(base) + r
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            t = vocab[a + b]
            if (vocab[a], vocab[b]) not in self.pair:
                self.pair[(vocab[a], vocab[b])] = t
            if self.left[t] == t:
                self.left[t], self.right[t] = vocab[a], vocab[b]
        self.text = {i: t for t, i in vocab.items()}
        self.units = {i: self._units(t, suffix) for t, i in vocab.items()}
        self.automaton = ahocorasick.Automaton()
        for token, units in self.units.items():
            if units:
                self.automaton.add_word(units, (token, len(units) - 1))
        self.automaton.make_automaton()
        by_units = {u: t for t, u in self.units.items() if u}
        self.shorter = {t: next((by_units[u[:k]] for k in range(len(u) - 1, 0, -1) if u[:k] in by_units), -1) for t, u in self.units.items()}
        self.length = {t: len(u) for t, u in self.units.items()}
        # plain lists: the loops below read single entries, which a NumPy array gives several times slower
        self._rank, self._left, self._right = self.rank.tolist(), self.left.tolist(), self.right.tolist()
        self._length, self._shorter = ([of.get(t, -1) for t in range(size)] for of in (self.length, self.shorter))
        self.compatible: dict[tuple[int, int], bool] = {}
        # offset table of the decoder: token texts one after another, each at offsets[id] .. offsets[id + 1]
        added = {a["id"]: a["content"] for a in spec.get("added_tokens", [])}
        texts = [(added.get(i) if i in added else self.text.get(i, "")).encode("utf-8") for i in range(max(size, *added, 0) + 1 if added else size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.blob = b"".join(texts)
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = suffix
        self.split, self.to_bytes = _fast_split(spec.get("pre_tokenizer"))
        self.normalise = _fast_normaliser(spec.get("normalizer"))
        self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    @staticmethod
    def _units(token: str, suffix: str) -> str:
        if suffix and token.endswith(suffix) and len(token) > len(suffix):
            core = token[: -len(suffix)]
            return core[:-1] + chr(END_MARK + ord(core[-1]))
        return token

    def word_units(self, word: str) -> str:
        return word[:-1] + chr(END_MARK + ord(word[-1])) if self.suffix and word else word

    def is_compatible(self, a: int, b: int) -> bool:
        """Whether BPE on the text of ``a`` then ``b`` ends with exactly these two tokens."""
        key = (a, b)
        known = self.compatible.get(key)
        if known is not None:
            return known
        rank, left, right, pair = self._rank, self._left, self._right, self.pair
        x, y, limit, verdict = a, b, None, True
        while True:
            joined = pair.get((x, y))
            if joined is not None and (limit is None or rank[joined] < limit):
                verdict = False  # BPE would merge across the boundary before it made one of the two
                break
            if rank[x] > rank[y]:  # undo the later merge first
                limit, nx = rank[x], right[x]
                if nx != x:
                    x = nx
                    continue
                limit, ny = rank[y] + 1, left[y]
                if ny == y:
                    break
                y = ny
            else:
                limit, ny = rank[y] + 1, left[y]
                if ny != y:
                    y = ny
                    continue
                limit, nx = rank[x], right[x]
                if nx == x:
                    break
                x = nx
        if len(self.compatible) >= MEMO_PAIRS:
            self.compatible.clear()
        self.compatible[key] = verdict
        return verdict

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token (its byte-level text) by backtracking over longest matches."""
        text = self.word_units(word)
        n = len(text)
        longest = [-1] * n
        for end, (token, back) in self.automaton.iter(text):
            longest[end - back] = token  # ends ascend, so a later match from the same start is longer
        length, shorter, compatible = self._length, self._shorter, self.compatible
        open_ = bytearray(b"\x01") * (n + 1)  # places not yet shown to be no token boundary
        tokens: list[int] = []
        pos, nxt, last = 0, (longest[0] if n else -1), -1
        while nxt >= 0:
            token = nxt
            while token >= 0:
                end = pos + length[token]
                if open_[end]:
                    fits = last < 0 or compatible.get((last, token))
                    if fits is None:
                        fits = self.is_compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                pos, nxt, last = end, (longest[end] if end < n else -1), token
            else:
                open_[pos] = 0
                tokens.pop()
                pos, nxt = pos - length[last], last
                last = tokens[-1] if tokens else -1
        return tokens

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of many id lists (``offsets`` into ``ids``) by one gather over the offset table."""
        rows = len(offsets) - 1
        if len(ids) == 0:
            return pa.array([""] * rows, pa.string())
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        last = np.zeros(len(ids), bool)
        counts = np.diff(offsets)
        last[(offsets[1:] - 1)[counts > 0]] = True
        width = lengths + (~last)  # a space after every token but a list's last
        ends = np.cumsum(width)
        place = np.arange(int(ends[-1])) - np.repeat(ends - width, width)
        source = np.repeat(self.offsets[ids], width) + place
        out = np.frombuffer(self.blob, np.uint8)[np.minimum(source, len(self.blob) - 1)].copy()
        out[(ends - 1)[~last]] = 0x20
        bounds = np.concatenate([[0], ends])[offsets].astype(np.int64)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(out)])
        texts = [b.decode("utf-8", "replace") for b in raw.to_pylist()] if not _valid_utf8(out) else None
        if texts is not None:
            return pa.array(texts, pa.string())
        return raw.cast(pa.large_string()).cast(pa.string())

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by one space, gathered through the offset table at once."""
        if len(ids) == 0:
            return b""
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        width = lengths + 1  # each text and the space after it
        ends = np.cumsum(width)
        place = np.arange(int(ends[-1])) - np.repeat(ends - width, width)
        source = np.repeat(starts, width) + place
        out = np.frombuffer(self.blob, np.uint8)[np.minimum(source, len(self.blob) - 1)].copy()
        out[ends - 1] = 0x20
        return out[:-1].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Vocabulary(path)


class WordMemo:
    """Ids of words seen lately, in two generations of at most ``MEMO_WORDS`` each: when the young one is full it becomes
    the old one and the former old one is dropped; a word found in the old one moves back to the young one. So frequent
    words stay while memory stays bounded, and only speed depends on it."""

    def __init__(self, size: int = MEMO_WORDS):
        self.size, self.young, self.old = size, {}, {}

    def get(self, word: str):
        return self.young.get(word)

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def fetch(self, v: "Vocabulary", word: str) -> list[int]:
        got = self.old.get(word)
        if got is None:
            got = v.encode_word(v.to_bytes(word))
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[word] = got
        return got


_memo: dict[str, WordMemo] = {}


def encode_text(v: Vocabulary, text: str, memo: WordMemo) -> list[int]:
    """Special strings split out as the library does; each other part normalised, pre-tokenised and encoded by words."""
    tok = v.tokenizer
    ids: list[int] = []
    for part, special in _split_special(v.specials, text):
        if special is not None:
            ids.append(special)
            continue
        if v.normalise is not None:
            normal = v.normalise(part)
        else:
            normal = tok.normalizer.normalize_str(part) if tok.normalizer else part
        if v.split is not None:
            words = v.split(normal)  # as in the text; mapped to byte-level symbols only when not remembered
        else:
            words = [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(normal)] if tok.pre_tokenizer else [normal]
        found = list(map(memo.young.get, words))  # hits looked up in one pass; misses filled below
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    found[i] = memo.fetch(v, words[i])
        ids.extend(chain.from_iterable(found))
    return ids


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in byte order."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 0
    for b in range(256):
        if b in keep:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def _fast_split(spec: dict | None):
    """The file's pre-tokeniser when it is a kept-matches split followed by a byte-level map without its own pattern:
    matches of the pattern (white space as the Unicode property, as the library's regex engine reads it), each mapped
    byte by byte. Any other pre-tokeniser is left to the library."""
    parts = (spec or {}).get("pretokenizers") if (spec or {}).get("type") == "Sequence" else None
    if not parts or len(parts) != 2:
        return None, _same
    split, level = parts
    if split.get("type") != "Split" or not split.get("invert") or split.get("behavior") != "Removed" or "Regex" not in split.get("pattern", {}):
        return None, _same
    if level.get("type") != "ByteLevel" or level.get("use_regex") or level.get("add_prefix_space"):
        return None, _same
    import regex

    pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
    table = str.maketrans({chr(b): c for b, c in _byte_chars().items()})

    def to_bytes(word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(table)

    return pattern.findall, to_bytes


def _fast_normaliser(spec: dict | None):
    """The file's normaliser when it is NFC, white-space runs to one space, lower case: the same steps in one pass of the
    standard library. Capital sigma is lowered first, since the library's lower case has no final form; any other
    normaliser is left to the library."""
    steps = (spec or {}).get("normalizers") if (spec or {}).get("type") == "Sequence" else None
    kinds = [s.get("type") for s in steps or []]
    if kinds != ["NFC", "Replace", "Lowercase"]:
        return None
    replace = steps[1]
    if replace.get("pattern", {}).get("Regex") != r"\s+" or replace.get("content") != " ":
        return None
    import unicodedata

    import regex

    space = regex.compile(r"\p{White_Space}+")

    def run(text: str) -> str:
        return space.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()

    return run


def _valid_utf8(data: np.ndarray) -> bool:
    try:
        data.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _same(word: str) -> str:
    return word


def _split_special(specials: dict[str, int], text: str):
    if not specials or not any(s in text for s in specials):
        yield text, None
        return
    import re

    pattern = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))
    at = 0
    for m in pattern.finditer(text):
        if m.start() > at:
            yield text[at : m.start()], None
        yield m.group(0), specials[m.group(0)]
        at = m.end()
    if at < len(text):
        yield text[at:], None


def _encoder(path: str, column: str, out: str, decoded: str | None):
    def run(batches):
        v = vocabulary(path)
        memo = _memo.setdefault(path, WordMemo())
        for slab in slabs(batches, column, SLAB):
            texts = pc.fill_null(slab.column(column).cast(pa.string()), "").to_pylist()
            flat, lengths = array("i"), np.zeros(len(texts), np.int64)
            for i, t in enumerate(texts):
                ids = encode_text(v, t, memo)
                flat.extend(ids)
                lengths[i] = len(ids)
            values = np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            done = slab.drop_columns([column]).append_column(out, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            if decoded is not None:
                done = done.append_column(decoded, v.decode_many(values.astype(np.int64), offsets))
            yield done

    return run


def _decoder(path: str, column: str, out: str):
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            ids = batch.column(column)
            flat = pc.fill_null(pc.list_flatten(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = ids.offsets.to_numpy()
            texts = [v.decode(flat[offsets[i] : offsets[i + 1]]).decode("utf-8", "replace") if ids[i].is_valid else None for i in range(len(ids))]
            yield batch.append_column(out, pa.array(texts, pa.string()))

    return run


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``text`` replaced by ``out``, the token ids (array<int>), and with ``decoded``, the text of those ids, if
    named: decoding in the same task reuses the loaded vocabulary. Other columns pass through; ones named ``out`` or
    ``decoded`` are replaced."""
    for name in (out, decoded):
        if name is not None and name in df.columns and name != text:
            df = df.drop(name)
    hidden = _free(df, "_bpe_text")
    rows = df.withColumnRenamed(text, hidden) if hidden != text else df
    fields = [f for f in rows.schema.fields if f.name != hidden] + [T.StructField(out, T.ArrayType(T.IntegerType()))]
    if decoded is not None:
        fields.append(T.StructField(decoded, T.StringType()))
    return rows.mapInArrow(_encoder(path, hidden, out, decoded), T.StructType(fields))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of the ids (null ids: null); a column named ``out`` is replaced."""
    if out in df.columns and out != ids:
        df = df.drop(out)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])
    return df.mapInArrow(_decoder(path, ids, out), schema)


def with_digests(df: DataFrame, ids: str = "ids", out: str = "ids_sha256") -> DataFrame:
    """``df`` with ``out``: SHA-256 (hex) of the ids as little-endian unsigned 32-bit integers (null ids: null)."""
    import hashlib

    def run(batches):
        for batch in batches:
            column = batch.column(ids)
            flat = pc.fill_null(pc.list_flatten(column), 0).to_numpy(zero_copy_only=False).astype("<u4")
            offsets = column.offsets.to_numpy()
            digests = [hashlib.sha256(flat[offsets[i] : offsets[i + 1]].tobytes()).hexdigest() if column[i].is_valid else None for i in range(len(column))]
            yield batch.append_column(out, pa.array(digests, pa.string()))

    return df.mapInArrow(run, T.StructType(df.schema.fields + [T.StructField(out, T.StringType())]))
