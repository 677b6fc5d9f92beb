"""Named queries on text: word statistics, document vectors, neighbour vote."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.functions import text as tx
from lodestat.operators import aggregates as ag
from lodestat.operators import corpus as co
from lodestat.operators import joins as jo
from lodestat.operators import neighbours as nn
from lodestat.operators import windows as wi
from lodestat.plans import sqltext as q
from lodestat.plans.registry import query
from lodestat.session import broadcast_if_small, cut_lineage
from lodestat.sources import readers as rd

WORDS = 20_000  # dictionary size of the text family
PAIR_WORDS = 2_000  # dictionary size of the co-occurrence query
K = 30


def _docs(spark, folder):
    return rd.read_dataset(spark, folder, "documents", spread_by="doc_id")


def _tokens(spark, folder):
    return co.tokenize(_docs(spark, folder), carry=("lang", "source"))


def _bow(spark, folder, settled=False):
    tokens = co.tokenize(_docs(spark, folder))
    # written once: the dictionary is used by every step behind it
    words = cut_lineage(co.dictionary(tokens, WORDS))
    return words, co.bow(co.tokenize(_docs(spark, folder), packed=True), words, size=WORDS, settled=settled)


def _tfidf(spark, folder):
    words, counts = _bow(spark, folder, settled=True)  # read for the document frequencies and for the weights
    weights = cut_lineage(co.idf(counts, _docs(spark, folder)))
    return words, weights, co.tfidf(co.tf(counts), weights, WORDS)


# --- words -------------------------------------------------------------------------------------

_RAW = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


@query("agg1_word_count_raw", f"SELECT word, count(*) AS cnt FROM ({_RAW}) GROUP BY word")
def word_count_raw(spark, folder):
    return co.word_count(_docs(spark, folder), mode="raw")


@query(
    "agg1_word_count_clean",
    f"SELECT lower(word) AS word, count(*) AS cnt FROM ({_RAW}) WHERE length(word) > 1 GROUP BY lower(word)",
)
def word_count_clean(spark, folder):
    return co.word_count(_docs(spark, folder), mode="clean")


@query(
    "top1_top_200_words",
    f"SELECT word, count(*) AS cnt FROM ({_RAW}) GROUP BY word ORDER BY cnt DESC, word LIMIT 200",
)
def top_words(spark, folder):
    return wi.top_k(co.word_count(_docs(spark, folder)), [F.col("cnt").desc(), F.col("word")], 200)


@query(
    "top3_top_records_natural_order",
    f"WITH {q.TOK} SELECT word, source, count(*) AS n FROM tok GROUP BY ALL ORDER BY word DESC, source DESC, n DESC LIMIT 50",
)
def top_records(spark, folder):
    counts = ag.value_counts(_tokens(spark, folder), "word", "source")
    return wi.top_k(counts, [F.col("word").desc(), F.col("source").desc(), F.col("n").desc()], 50)


@query("txt1_tokenize", f"WITH {q.TOK} SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct FROM tok GROUP BY doc_id")
def tokenize(spark, folder):
    return (
        co.tokenize(_docs(spark, folder))
        .groupBy("doc_id")
        .agg(F.count("*").alias("n_words"), F.countDistinct("word").alias("n_distinct"))
    )


@query("arr4_explode_occurrences", f"WITH {q.TOK} SELECT word, doc_id, count(*) AS n FROM tok GROUP BY ALL")
def explode_occurrences(spark, folder):
    return ag.value_counts(co.tokenize(_docs(spark, folder)), "word", "doc_id")


@query("txt2_dictionary", q.corpus_ctes(WORDS, "dict") + " SELECT word, pos, cnt FROM dict")
def dictionary(spark, folder):
    return co.dictionary(_tokens(spark, folder), WORDS)


@query("win1_dictionary_rank", q.corpus_ctes(1000, "dict") + " SELECT word, pos FROM dict")
def dictionary_rank(spark, folder):
    return co.dictionary(_tokens(spark, folder), 1000).select("word", "pos")


@query(
    "joi1_dictionary_lookup",
    q.corpus_ctes(WORDS, "dict") + " SELECT doc_id, pos, count(*) AS n FROM tok JOIN dict USING (word) GROUP BY ALL",
)
def dictionary_lookup(spark, folder):
    tokens = _tokens(spark, folder)
    found = jo.lookup(tokens, co.dictionary(tokens, WORDS).select("word", "pos"))
    return ag.value_counts(found, "doc_id", "pos")


@query(
    "agg3_collect_positions",
    q.corpus_ctes(WORDS, "dict")
    + " SELECT doc_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions FROM tok JOIN dict USING (word) GROUP BY doc_id",
)
def collect_positions(spark, folder):
    tokens = _tokens(spark, folder)
    found = jo.lookup(tokens, co.dictionary(tokens, WORDS).select("word", "pos"))
    return ag.collect_values(found, "doc_id", "pos", "positions").withColumn(
        "positions", F.array_join(F.transform("positions", lambda p: p.cast("string")), ",")
    )


@query("txt4_bag_of_words", q.corpus_ctes(WORDS, "bow") + " SELECT doc_id, pos, cnt FROM bow")
def bag_of_words(spark, folder):
    return _bow(spark, folder)[1].select("doc_id", "pos", "cnt")


@query(
    "arr5_count_vectors",
    q.corpus_ctes(WORDS, "bow") + " SELECT doc_id, count(*) AS nonzero, CAST(sum(cnt) AS BIGINT) AS total, CAST(sum(pos * cnt) AS BIGINT) AS weighted FROM bow GROUP BY doc_id",
)
def count_vectors(spark, folder):
    return (
        _bow(spark, folder)[1]
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("nonzero"), F.sum("cnt").alias("total"),
            F.sum(F.col("pos") * F.col("cnt")).alias("weighted"),
        )
    )


@query("txt5_term_frequency", q.corpus_ctes(WORDS, "tf") + " SELECT doc_id, pos, round(tf, 9) AS tf FROM tf")
def term_frequency(spark, folder):
    return co.tf(_bow(spark, folder)[1]).select("doc_id", "pos", F.round("tf", 9).alias("tf"))


@query("agg5_document_frequency", q.corpus_ctes(WORDS, "bow") + " SELECT pos, count(DISTINCT doc_id) AS df FROM bow GROUP BY pos")
def document_frequency(spark, folder):
    return co.doc_freq(_bow(spark, folder)[1])


@query("mth2_clip_presence", q.corpus_ctes(WORDS, "bow") + " SELECT pos, CAST(sum(least(greatest(cnt, 0), 1)) AS BIGINT) AS docs, CAST(sum(cnt) AS BIGINT) AS total FROM bow GROUP BY pos")
def clip_presence(spark, folder):
    one = F.least(F.greatest(F.col("cnt"), F.lit(0)), F.lit(1))
    return _bow(spark, folder)[1].groupBy("pos").agg(F.sum(one).alias("docs"), F.sum("cnt").alias("total"))


@query("txt6_inverse_document_frequency", q.corpus_ctes(WORDS, "idf") + " SELECT pos, df, round(idf, 9) AS idf FROM idf")
def inverse_document_frequency(spark, folder):
    _, counts = _bow(spark, folder)
    return co.idf(counts, _docs(spark, folder)).select("pos", "df", F.round("idf", 9).alias("idf"))


@query("txt7_tfidf", q.corpus_ctes(WORDS) + " SELECT doc_id, pos, round(weight, 9) AS weight FROM tfidf")
def tfidf(spark, folder):
    return _tfidf(spark, folder)[2].select("doc_id", "pos", F.round("weight", 9).alias("weight"))


def _bench_items(spark, folder):
    return rd.read_dataset(spark, folder, "benchmark")


@query(
    "txt8_vectorize_query",
    q.corpus_ctes(WORDS) + ",\n" + q.query_ctes() + " SELECT item_id, pos, round(weight, 9) AS weight FROM q",
)
def vectorize_query(spark, folder):
    words, weights, _ = _tfidf(spark, folder)
    out = co.vectorize_query(_bench_items(spark, folder), words, weights, "item_id", "text", WORDS)
    return out.withColumn("weight", F.round("weight", 9))


# --- neighbours --------------------------------------------------------------------------------


def _vectors(spark, folder, scheme="tfidf"):
    """(query vectors, document vectors) under one weighting."""
    items = _bench_items(spark, folder)
    if scheme == "tfidf":
        words, weights, docs = _tfidf(spark, folder)
        return co.vectorize_query(items, words, weights, "item_id", "text", WORDS), docs
    words, counts = _bow(spark, folder)
    if scheme == "tf":
        return co.vectorize_query(items, words, None, "item_id", "text", WORDS), co.tf(counts).withColumn("weight", F.col("tf"))
    asked = co.bow(co.tokenize(items, "item_id"), words, "item_id", WORDS)
    weight = F.col("cnt").cast("double")
    return asked.select("item_id", "pos", weight.alias("weight")), counts.withColumn("weight", weight)


def _similarities(spark, folder, metric="dot", scheme="tfidf"):
    return nn.similarity(*_vectors(spark, folder, scheme), "item_id", "doc_id", metric=metric)


def _nearest(spark, folder, metric="dot", scheme="tfidf"):
    return nn.nearest_documents(*_vectors(spark, folder, scheme), "item_id", "doc_id", K, metric=metric)


def _labelled(near, spark, folder, label):
    """Labels are looked up for the k neighbours only; no label travels through the vector steps."""
    labels = rd.read_dataset(spark, folder, "documents").select("doc_id", label)
    return labels.join(broadcast_if_small(near.select("item_id", "doc_id")), "doc_id")


def _vote(spark, folder, label, **how):
    near = _nearest(spark, folder, **how)
    return nn.vote(_labelled(cut_lineage(near), spark, folder, label), "item_id", label)


_SIM = """sim AS (SELECT item_id, doc_id, lang, source, round(sum(q.weight * d.weight), 9) AS similarity
  FROM q JOIN tfidf d USING (pos) GROUP BY ALL)"""
_COS = """qn AS (SELECT item_id, pos, weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY item_id)), 0) AS weight FROM q),
dn AS (SELECT doc_id, lang, source, pos, weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0) AS weight FROM tfidf),
sim AS (SELECT item_id, doc_id, lang, source, round(sum(qn.weight * dn.weight), 9) AS similarity
  FROM qn JOIN dn USING (pos) GROUP BY ALL)"""
_NEAR = f"""near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM sim)
  WHERE rank <= {K})"""


def _vote_sql(label):
    return f"""votes AS (SELECT item_id, {label}, count(*) AS votes FROM near GROUP BY ALL)
SELECT item_id, {label}, votes FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY votes DESC, {label}) AS r FROM votes) WHERE r = 1"""


_HEAD = q.corpus_ctes(WORDS) + ",\n" + q.query_ctes()


@query("knn1_similarity_dot", f"{_HEAD},\n{_SIM} SELECT item_id, doc_id, similarity FROM sim")
def similarity_dot(spark, folder):
    return _similarities(spark, folder).select("item_id", "doc_id", "similarity")


@query("knn1_similarity_cosine", f"{_HEAD},\n{_COS} SELECT item_id, doc_id, similarity FROM sim")
def similarity_cosine(spark, folder):
    return _similarities(spark, folder, "cosine").select("item_id", "doc_id", "similarity")


@query(
    "knn2_nearest_documents",
    f"{_HEAD},\n{_SIM},\n{_NEAR} SELECT item_id, doc_id, similarity, rank FROM near",
)
def nearest_documents(spark, folder):
    near = _nearest(spark, folder)
    return near.select("item_id", "doc_id", "similarity", F.col("rank").cast("bigint").alias("rank"))


@query("knn3_vote_language_tfidf", f"{_HEAD},\n{_SIM},\n{_NEAR},\n{_vote_sql('lang')}")
def vote_language(spark, folder):
    return _vote(spark, folder, "lang")


@query("knn3_vote_source_cosine", f"{_HEAD},\n{_COS},\n{_NEAR},\n{_vote_sql('source')}")
def vote_source(spark, folder):
    return _vote(spark, folder, "source", metric="cosine")


_PLAIN = q.corpus_ctes(WORDS, "tf") + ",\n" + q.query_ctes(False)


@query(
    "knn3_vote_language_tf",
    f"""{_PLAIN}, sim AS (SELECT item_id, doc_id, lang, round(sum(q.tf * d.tf), 9) AS similarity
  FROM qtf q JOIN tf d USING (pos) GROUP BY ALL),\n{_NEAR},\n{_vote_sql('lang')}""",
)
def vote_language_tf(spark, folder):
    return _vote(spark, folder, "lang", scheme="tf")


@query(
    "knn3_vote_language_counts",
    f"""{_PLAIN}, sim AS (SELECT item_id, doc_id, lang, CAST(sum(q.cnt * d.cnt) AS DOUBLE) AS similarity
  FROM qbow q JOIN bow d USING (pos) GROUP BY ALL),\n{_NEAR},\n{_vote_sql('lang')}""",
)
def vote_language_counts(spark, folder):
    return _vote(spark, folder, "lang", scheme="counts")


@query(
    "agg2_vote_counts",
    f"{_HEAD},\n{_SIM},\n{_NEAR} SELECT item_id, source, count(*) AS n FROM near GROUP BY ALL",
)
def vote_counts(spark, folder):
    near = cut_lineage(_nearest(spark, folder))
    return ag.value_counts(_labelled(near, spark, folder, "source"), "item_id", "source")


# --- co-occurrence and the count cube ----------------------------------------------------------


@query(
    "agg15_cooccurrence",
    q.corpus_ctes(PAIR_WORDS, "dict")
    + """, pres AS (SELECT DISTINCT doc_id, pos FROM tok JOIN dict USING (word))
SELECT a.pos AS pos_a, b.pos AS pos_b, count(*) AS docs FROM pres a JOIN pres b ON a.doc_id = b.doc_id AND a.pos <= b.pos GROUP BY ALL""",
)
def cooccurrence(spark, folder):
    docs = _docs(spark, folder)
    words = cut_lineage(co.dictionary(co.tokenize(docs), PAIR_WORDS))
    return co.cooccurrence(docs, words, size=PAIR_WORDS)


@query(
    "joi7_word_pairs_by_name",
    q.corpus_ctes(PAIR_WORDS, "dict")
    + """, pres AS (SELECT DISTINCT doc_id, pos, word FROM tok JOIN dict USING (word))
SELECT a.word AS word_a, b.word AS word_b, count(*) AS docs FROM pres a JOIN pres b ON a.doc_id = b.doc_id AND a.pos < b.pos GROUP BY ALL""",
)
def word_pairs(spark, folder):
    docs = _docs(spark, folder)
    words = cut_lineage(co.dictionary(co.tokenize(docs), PAIR_WORDS))
    names = F.broadcast(words.select("pos", "word"))
    return (
        co.cooccurrence(docs, words, size=PAIR_WORDS)
        .filter(F.col("pos_a") < F.col("pos_b"))
        .join(names.select(F.col("pos").alias("pos_a"), F.col("word").alias("word_a")), "pos_a")
        .join(names.select(F.col("pos").alias("pos_b"), F.col("word").alias("word_b")), "pos_b")
        .select("word_a", "word_b", "docs")
    )


# the cube: document x topic (the source number) x word
_CUBE = f"WITH {q.TOK}, cube AS (SELECT doc_id, CAST(substr(source, 4) AS INT) AS topic, word, count(*) AS cnt FROM tok GROUP BY ALL)"


def _cube(spark, folder):
    return (
        _tokens(spark, folder)
        .withColumn("topic", F.substring("source", 4, 10).cast("int"))
        .groupBy("doc_id", "topic", "word")
        .agg(F.count("*").alias("cnt"))
    )


def _total(df):
    return df.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total"))


@query("agg10_margin_topic", f"{_CUBE} SELECT topic, CAST(sum(cnt) AS BIGINT) AS total FROM cube GROUP BY topic")
def margin_topic(spark, folder):
    return ag.marginal(_cube(spark, folder), ["topic"])


@query(
    "agg10_all_margins",
    f"""{_CUBE}, c2 AS (SELECT topic, length(word) AS wlen, cnt FROM cube)
SELECT topic, wlen, CAST(sum(cnt) AS BIGINT) AS total, CAST(grouping(topic, wlen) AS BIGINT) AS level FROM c2 GROUP BY CUBE (topic, wlen)""",
)
def all_margins(spark, folder):
    c2 = _cube(spark, folder).withColumn("wlen", F.length("word").cast("bigint"))
    return ag.all_marginals(c2, ["topic", "wlen"]).withColumn("level", F.col("level").cast("bigint"))


@query(
    "agg11_cube_slices",
    f"""{_CUBE} SELECT 'all' AS slice, CAST(sum(cnt) AS BIGINT) AS total FROM cube
UNION ALL SELECT 'topic 17', CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM cube WHERE topic = 17
UNION ALL SELECT 'topics 3 to 11', CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM cube WHERE topic BETWEEN 3 AND 11
UNION ALL SELECT 'topics 7 and 13', CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM cube WHERE topic IN (7, 13)
UNION ALL SELECT 'even topics', CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM cube WHERE topic % 2 = 0
UNION ALL SELECT 'odd topics', CAST(coalesce(sum(cnt), 0) AS BIGINT) FROM cube WHERE topic % 2 = 1""",
)
def cube_slices(spark, folder):
    t = F.col("topic")
    slices = {
        "all": F.lit(True),
        "topic 17": t == 17,
        "topics 3 to 11": t.between(3, 11),
        "topics 7 and 13": t.isin(7, 13),
        "even topics": t % 2 == 0,
        "odd topics": t % 2 == 1,
    }
    # one pass: every slice is a conditional sum of the same scan
    one = _cube(spark, folder).agg(
        *[F.coalesce(F.sum(F.when(c, F.col("cnt"))), F.lit(0)).alias(n) for n, c in slices.items()]
    )
    return one.unpivot([], list(slices), "slice", "total")


@query(
    "agg11_cube_cells",
    f"{_CUBE} SELECT doc_id, topic, CAST(sum(cnt) AS BIGINT) AS total FROM cube GROUP BY doc_id, topic",
)
def cube_cells(spark, folder):
    return ag.marginal(_cube(spark, folder), ["doc_id", "topic"])


@query(
    "agg12_words_of_topic",
    f"{_CUBE} SELECT word, CAST(sum(cnt) AS BIGINT) AS total FROM cube WHERE topic = 15 GROUP BY word",
)
def words_of_topic(spark, folder):
    return ag.marginal(_cube(spark, folder).filter(F.col("topic") == 15), ["word"])


@query(
    "agg13_argmax_topic_of_word",
    f"""{_CUBE}, t AS (SELECT word, topic, sum(cnt) AS total FROM cube GROUP BY ALL)
SELECT word, topic, CAST(total AS BIGINT) AS total FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY total DESC, topic) AS r FROM t) WHERE r = 1""",
)
def argmax_topic(spark, folder):
    return ag.argmax_by(_cube(spark, folder), "word", "topic")


@query(
    "agg14_max_word_of_topic",
    f"""{_CUBE}, t AS (SELECT topic, word, sum(cnt) AS total FROM cube GROUP BY ALL)
SELECT topic, CAST(max(total) AS BIGINT) AS total FROM t GROUP BY topic""",
)
def max_word(spark, folder):
    return ag.max_marginal(_cube(spark, folder), "topic", "word")


# --- string functions --------------------------------------------------------------------------


@query(
    "str1_clean_words",
    r"""SELECT doc_id, array_to_string([w FOR w IN string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +') IF w <> ''], ' ') AS words FROM documents""",
)
def clean_words(spark, folder):
    return _docs(spark, folder).select("doc_id", F.array_join(tx.clean_words(F.col("text")), " ").alias("words"))


@query(
    "str2_space_split",
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_tokens, CAST(len([w FOR w IN string_split(text, ' ') IF w = '']) AS BIGINT) AS n_empty FROM documents",
)
def space_split(spark, folder):
    parts = tx.space_split(F.col("text"))
    return _docs(spark, folder).select(
        "doc_id", F.size(parts).cast("bigint").alias("n_tokens"),
        F.size(F.filter(parts, lambda w: w == "")).cast("bigint").alias("n_empty"),
    )


@query("str3_lower", "SELECT item_id, lower(text) AS text FROM benchmark")
def lower(spark, folder):
    return _bench_items(spark, folder).select("item_id", F.lower("text").alias("text"))


@query("str4_first_match", "SELECT page_id, regexp_extract(url, '(/.*?/)', 1) AS hit FROM pages")
def first_match(spark, folder):
    pages = rd.read_dataset(spark, folder, "pages")
    return pages.select("page_id", tx.first_match(F.col("url"), "/.*?/").alias("hit"))


@query(
    "txt3_label_from_path",
    "SELECT label, count(*) AS n FROM (SELECT regexp_extract('pages/' || split_part(url, '/', 3) || '/' || page_id, '(/.*?/)', 1) AS label FROM pages) GROUP BY label",
)
def label_from_path(spark, folder):
    pages = rd.read_dataset(spark, folder, "pages")
    path = tx.build_path("pages/", F.get(F.split("url", "/"), F.lit(2)), "/", F.col("page_id").cast("string"))
    return ag.value_counts(co.label_from_path(pages.withColumn("path", path), "path"), "label")


@query(
    "str5_between_markers",
    """SELECT page_id, substr(html, strpos(html, '<title>') + 7, strpos(html, '</title>') - strpos(html, '<title>') - 7) AS title
FROM pages WHERE strpos(html, '<title>') > 0 AND strpos(html, '</title>') >= strpos(html, '<title>') + 7""",
)
def between_markers(spark, folder):
    pages = rd.read_dataset(spark, folder, "pages")
    title = tx.between(F.col("html"), "<title>", "</title>")
    return pages.select("page_id", title.alias("title")).filter(F.col("title").isNotNull())


@query(
    "str6_concat_repeat",
    "SELECT c_custkey, c_name || '-' || c_mktsegment AS joined, repeat(c_mktsegment, 3) AS three FROM customer",
)
def concat_repeat(spark, folder):
    c = rd.read_dataset(spark, folder, "customer")
    return c.select(
        "c_custkey", F.concat("c_name", F.lit("-"), "c_mktsegment").alias("joined"),
        tx.repeat_text(F.col("c_mktsegment"), 3).alias("three"),
    )


@query(
    "str7_parse_floats",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(list_sum([CAST(x AS DOUBLE) FOR x IN string_split(rtrim(l_quantity || ',' || l_discount || ',' || l_tax || '  '), ',')]), 6) AS total FROM lineitem""",
)
def parse_floats(spark, folder):
    li = rd.read_dataset(spark, folder, "lineitem")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ("l_quantity", "l_discount", "l_tax")])
    nums = tx.parse_floats(F.concat(line, F.lit("  ")))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.aggregate(nums, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


@query(
    "str8_build_path_format",
    "SELECT page_id, 'img/' || page_id || '.jpg' AS path, printf('%.3f', page_id / 7.0) AS shown FROM pages",
)
def build_path(spark, folder):
    pages = rd.read_dataset(spark, folder, "pages")
    return pages.select(
        "page_id", tx.build_path("img/", F.col("page_id").cast("string"), ".jpg").alias("path"),
        tx.format_number("%.3f", F.col("page_id") / F.lit(7.0)).alias("shown"),
    )


@query("flt1_substring", "SELECT doc_id, lang FROM documents WHERE contains(text, 'ion')")
def substring_filter(spark, folder):
    return _docs(spark, folder).filter(F.col("text").contains("ion")).select("doc_id", "lang")


@query("flt2_length", f"SELECT word, count(*) AS n FROM ({_RAW}) WHERE length(word) > 1 GROUP BY word")
def length_filter(spark, folder):
    words = _docs(spark, folder).select(F.explode(tx.space_split(F.col("text"))).alias("word"))
    return ag.value_counts(words.filter(F.length("word") > 1), "word")


@query(
    "src6_parse_doc_lines",
    """SELECT 'pages/' || split_part(url, '/', 3) || '/' || page_id AS doc_id, md5(html) AS text_hash FROM pages""",
)
def parse_doc_lines(spark, folder):
    pages = rd.read_dataset(spark, folder, "pages")
    # lines of the marked form, written by Spark from the page table; the parser reads them back
    line = F.concat(
        F.lit('<doc id="pages/'), F.get(F.split("url", "/"), F.lit(2)), F.lit("/"), F.col("page_id").cast("string"),
        F.lit('" url="'), F.col("url"), F.lit('">'), F.col("html"),
    )
    parsed = rd.parse_doc_lines(pages.select(line.alias("value")))
    return parsed.select("doc_id", F.md5("text").alias("text_hash"))
