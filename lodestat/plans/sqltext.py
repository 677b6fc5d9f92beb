"""Pieces of SQL shared by the check queries."""

TOK = """tok AS (SELECT doc_id, lang, source, lower(w) AS word FROM (
  SELECT doc_id, lang, source, unnest(regexp_split_to_array(text, '[^a-zA-Z]+')) AS w FROM documents) WHERE w <> '')"""


def dict_cte(size: int) -> str:
    return f"""dict AS (SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS pos FROM (
  SELECT word, count(*) AS cnt FROM tok GROUP BY word ORDER BY cnt DESC, word LIMIT {size}))"""


BOW = "bow AS (SELECT doc_id, lang, source, pos, count(*) AS cnt FROM tok JOIN dict USING (word) GROUP BY ALL)"
TF = "tf AS (SELECT *, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM bow)"
IDF = """idf AS (SELECT pos, count(*) AS df, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM bow GROUP BY pos)"""
TFIDF = "tfidf AS (SELECT doc_id, lang, source, pos, tf * idf AS weight FROM tf JOIN idf USING (pos))"


def corpus_ctes(size: int, last: str = "tfidf") -> str:
    """WITH clause text up to the named table."""
    parts = {"tok": TOK, "dict": dict_cte(size), "bow": BOW, "tf": TF, "idf": IDF, "tfidf": TFIDF}
    names = list(parts)
    return "WITH " + ",\n".join(parts[n] for n in names[: names.index(last) + 1])


def query_ctes(weighted: bool = True) -> str:
    """Query vectors of the benchmark texts, to follow ``corpus_ctes``."""
    base = """qtok AS (SELECT item_id, lower(w) AS word FROM (
  SELECT item_id, unnest(regexp_split_to_array(text, '[^a-zA-Z]+')) AS w FROM benchmark) WHERE w <> ''),
qbow AS (SELECT item_id, pos, count(*) AS cnt FROM qtok JOIN dict USING (word) GROUP BY ALL),
qtf AS (SELECT item_id, pos, cnt / sum(cnt) OVER (PARTITION BY item_id) AS tf FROM qbow)"""
    if weighted:
        return base + ",\nq AS (SELECT item_id, pos, tf * idf AS weight FROM qtf JOIN idf USING (pos))"
    return base


def hash_int(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


def hash_unit(key: str, seed: int) -> str:
    return f"({hash_int(key, seed)} / 4294967296.0)"


# long form of the embeddings with zero-based positions
EMB_LONG = """el AS (SELECT vec_id, label, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""
EMB = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
