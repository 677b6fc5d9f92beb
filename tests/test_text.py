import numpy as np
import pytest
from lodestat.operators import aggregates as ag
from lodestat.operators import corpus as co
from lodestat.operators import neighbours as nn
from lodestat.operators import projection as rp
from lodestat.sources import readers as rd
from pyspark.sql import functions as F


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_tokenize_drops_non_letters_and_lowers(tiny_docs):
    words = [r.word for r in co.tokenize(tiny_docs).filter("doc_id = 'g/space/1'").collect()]
    assert sorted(words) == ["and", "moon", "moon", "stars", "the", "the", "the"]
    assert co.tokenize(tiny_docs).filter("doc_id = 'g/none/6'").count() == 0


def test_word_count_modes(spark):
    df = spark.createDataFrame([("a  Bb bb",)], "text string")
    assert pairs(co.word_count(df)) == {("a", 1), ("", 1), ("Bb", 1), ("bb", 1)}
    assert pairs(co.word_count(df, mode="clean")) == {("bb", 2)}


def test_count_vector_of_positions(spark):
    tokens = spark.createDataFrame([(1, f"w{i}") for i in (3, 4, 1, 1, 2)], "doc_id bigint, word string")
    words = spark.createDataFrame([(f"w{i}", i) for i in range(5)], "word string, pos bigint")
    tf = co.tf(co.bow(tokens, words)).select("pos", "cnt", "tf")
    assert pairs(tf) == {(1, 2, 0.4), (2, 1, 0.2), (3, 1, 0.2), (4, 1, 0.2)}


def test_documents_without_dictionary_words_vanish_and_idf_counts_all(tiny_docs):
    tokens = co.tokenize(tiny_docs)
    words = co.dictionary(tokens, 100)
    counts = co.bow(tokens, words, size=100)
    assert counts.select("doc_id").distinct().count() == 5
    idf = {r.word: r.idf for r in co.idf(counts, tiny_docs).join(words, "pos").collect()}
    assert idf["bread"] == pytest.approx(np.log(6 / 3))


def test_dictionary_ties_go_by_alphabet(tiny_docs):
    words = [r.word for r in co.dictionary(co.tokenize(tiny_docs), 4).orderBy("pos").collect()]
    assert words == ["the", "bread", "moon", "and"]


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_packed_scan_equals_declarative_knn(spark, tiny_docs, metric):
    docs = tiny_docs.withColumn("doc_id", F.regexp_extract("doc_id", r"(\d+)$", 1).cast("bigint"))
    tokens = co.tokenize(docs)
    words = co.dictionary(tokens, 100)
    counts = co.bow(tokens, words, size=100)
    weights = co.idf(counts, docs)
    corpus = co.tfidf(co.tf(counts), weights)
    asked = spark.createDataFrame([(1, "moon bread"), (2, "jam and butter"), (3, "zzz")], "q bigint, text string")
    q = co.vectorize_query(asked, words, weights, "q", "text")
    slow = nn.knn(nn.similarity(q, corpus, "q", "doc_id", metric=metric), "q", "doc_id", 2)
    fast = nn.nearest_documents(q, corpus, "q", "doc_id", 2, metric=metric)
    cols = ["q", "doc_id", "similarity", "rank"]
    assert pairs(slow.select(cols)) == pairs(fast.select(cols))
    assert {r.q for r in fast.collect()} == {1, 2}


def test_large_query_batches_join_with_salt(spark, monkeypatch):
    corpus = spark.createDataFrame([(d, p, float(d + p)) for d in range(6) for p in range(3)], "doc bigint, pos bigint, weight double")
    q = spark.createDataFrame([(7, 0, 1.0), (7, 2, 0.5), (8, 1, 2.0)], "q bigint, pos bigint, weight double")
    small = pairs(nn.similarity(q, corpus, "q", "doc"))
    monkeypatch.setattr(nn, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(nn, "fits", lambda df, n: False)
    assert pairs(nn.similarity(q, corpus, "q", "doc")) == small
    near = {tuple(r) for r in nn.nearest_documents(q, corpus, "q", "doc", 2).select("q", "doc").collect()}
    assert near == {(7, 5), (7, 4), (8, 5), (8, 4)}


@pytest.mark.parametrize("tile", [2048, 4])
def test_cooccurrence_equals_matrix_product(spark, tiny_docs, monkeypatch, tile):
    monkeypatch.setattr(co, "TILE", tile)
    words = co.dictionary(co.tokenize(tiny_docs), 6)
    listed = [r.word for r in words.orderBy("pos").collect()]
    rows = {}
    for r in co.tokenize(tiny_docs).collect():
        rows.setdefault(r.doc_id, set()).add(r.word)
    b = np.array([[w in s for w in listed] for s in rows.values()], dtype=int)
    want = b.T @ b
    got = co.cooccurrence(tiny_docs.repartition(3), words, size=6).collect()
    assert {(r.pos_a, r.pos_b): r.docs for r in got} == {
        (i, j): want[i, j] for i in range(6) for j in range(i, 6) if want[i, j]
    }


def test_cube_forms_agree(tiny_cube):
    a = np.zeros((3, 3, 4), dtype=int)
    for r in tiny_cube.collect():
        a[r.doc, r.topic, r.word] = r.cnt
    assert dict(pairs(ag.marginal(tiny_cube, ["topic"]))) == dict(enumerate(a.sum((0, 2))))
    best = {r.word: r.topic for r in ag.argmax_by(tiny_cube, "word", "topic").collect()}
    assert best == dict(enumerate(a.sum(0).argmax(0)))
    tops = {r.topic: r.total for r in ag.max_marginal(tiny_cube, "topic", "word").collect()}
    assert tops == dict(enumerate(a.sum(0).max(1)))
    assert sum(r.total for r in ag.marginal(tiny_cube, ["word"]).collect()) == a.sum()


def test_projection_is_a_matrix_product_and_keeps_distances(spark):
    rng = np.random.default_rng(0)
    dense = rng.random((8, 40)) * (rng.random((8, 40)) < 0.4)
    rows = [(d, p, float(dense[d, p])) for d in range(8) for p in range(40) if dense[d, p]]
    df = spark.createDataFrame(rows, "doc bigint, pos bigint, weight double")
    for family, make in (("gaussian", rp.gaussian_matrix), ("sign", rp.sign_matrix)):
        got = {r.doc: np.array(r.vector) for r in rp.random_projection(df, "doc", "weight", 512, 5, family).collect()}
        r = make(np.arange(40), 512, 5)
        assert np.allclose([got[d] for d in range(8)], dense @ r)
        near = np.linalg.norm(got[0] - got[1]) / np.sqrt(512)
        assert near == pytest.approx(np.linalg.norm(dense[0] - dense[1]), rel=0.15)


def test_topic_regression_matches_normal_equations(spark):
    rng = np.random.default_rng(1)
    dense = rng.random((30, 12))
    df = spark.createDataFrame([(d, p, float(dense[d, p])) for d in range(30) for p in range(12)], "doc bigint, pos bigint, weight double")
    labels = spark.createDataFrame([(d, "a" if d % 3 == 0 else "b") for d in range(30)], "doc bigint, label string")
    fit = rp.topic_regression(df, "doc", "weight", labels, "label", ["a"], 5, 2)
    x = dense @ rp.gaussian_matrix(np.arange(12), 5, 2)
    y = np.where(np.arange(30) % 3 == 0, 1.0, -1.0)
    want = np.linalg.solve(x.T @ x, x.T @ y)
    assert np.allclose(fit.weights, want)
    asked = spark.createDataFrame([(9, 0, 1.0), (9, 3, 2.0)], "q bigint, pos bigint, weight double")
    row = rp.predict_topic(asked, fit, "q", "yes", "no").first()
    v = rp.gaussian_matrix(np.array([0, 3]), 5, 2)
    assert row.score == pytest.approx(float((v[0] + 2 * v[1]) @ want))
    assert row.answer == ("yes" if row.score > 0 else "no")


def test_parse_doc_lines(spark):
    lines = spark.createDataFrame([('<doc id="a/b/1" url="x">some text',), ("no marks",), ("an id but no marks",)], "value string")
    assert pairs(rd.parse_doc_lines(lines)) == {("a/b/1", "some text")}


def test_label_from_path(tiny_docs):
    assert {r.label for r in co.label_from_path(tiny_docs, "doc_id").collect()} == {"/space/", "/food/", "/none/"}


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_neighbours_with_text_ids_and_zero_vectors(spark, metric):
    """Small and large query batches agree on text ids and on a document whose weights are all zero."""
    corpus = spark.createDataFrame(
        [("g/a", 0, 1.0), ("g/a", 1, 2.0), ("g/b", 0, 3.0), ("g/c", 1, 0.0), ("g/d", 0, 1.0), ("g/d", 1, 2.0)], "doc string, pos long, weight double"
    )
    q = spark.createDataFrame([("x", 0, 1.0), ("x", 1, 1.0)], "q string, pos long, weight double")
    fast = nn.nearest_documents(q, corpus, "q", "doc", 4, metric=metric)
    slow = nn.knn(nn.similarity(q, corpus, "q", "doc", "weight", metric), "q", "doc", 4)
    assert sorted((r["doc"], r["similarity"]) for r in fast.collect()) == sorted((r["doc"], r["similarity"]) for r in slow.collect())
    assert {r["doc"]: r["similarity"] for r in fast.collect()}["g/c"] == 0.0
