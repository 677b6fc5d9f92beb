"""Findings of round 3 on the training-data operators (answered in round 4)."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestat.llm import backtrack_bpe, byte_bpe, language_id, near_dedup, passages, registered, shared, training_order


def test_pipeline_driver_holds_the_sample_packed(spark):
    """Fitting never unpacks the whole sample (BUCKETS bytes a row) on the driver."""
    rows = [(i, f"{'der die das' if i % 2 else 'the of and'} {i * 7919 % 1009} {'x' * (i % 9)}", "de" if i % 2 else "en") for i in range(1_500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.fit(df, "doc_id", "text", "lang", sample=20, landmarks=5)
    tracemalloc.start()
    model = language_id.fit(df, "doc_id", "text", "lang")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights.shape == (language_id.BUCKETS, 2)
    assert peak < len(rows) * language_id.BUCKETS * 0.8, peak


def test_pipeline_unpacked_columns_are_the_presence():
    x = np.random.default_rng(1).integers(0, 2, (5, language_id.BUCKETS), np.uint8)
    bits = np.packbits(x, axis=1)
    parts = [language_id._unpacked(bits, at) for at in range(0, language_id.BUCKETS, language_id.UNPACKED)]
    assert (np.concatenate(parts, axis=1) == x).all()


def test_op12_word_loop_reads_plain_lists():
    """Merge trees are walked as Python numbers: a NumPy scalar for each step was what the CPU time went to."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    v = backtrack_bpe.vocabulary(public_tokenizers.path(registered.WORD_BPE))
    assert all(type(t) is list for t in (v._rank, v._left, v._right, v._length, v._shorter))
    for word in ("enerstkeit", "thwhhere", "ionionionion", "q", "äßñ", "aaaaaaaaaaaaaaaaaaaa"):
        normal = v.normalise(word)
        want = v.tokenizer.encode(normal, add_special_tokens=False).ids
        assert backtrack_bpe.encode_text(v, normal, backtrack_bpe.WordMemo()) == want


def _language_model() -> language_id.Model:
    weights = np.random.default_rng(2).standard_normal((language_id.BUCKETS, 2)).astype(np.float32) / 100
    return language_id.Model(["de", "en"], weights)


def test_pipeline_language_id_sends_python_the_text_only(spark):
    """Only the text goes to a Python worker, once, and only the verdict comes back; a filter on it runs no second pass."""
    rows = [(i, ["the of and", None, "12 34", ""][i % 4], "en", "a", 1) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = language_id.predict(df, _language_model()).filter("lang_pred <> 'und'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.split("\n") if "ArrowEvalPython" in line or "MapInArrow" in line]
    assert len(nodes) == 1 and "ArrowEvalPython" in nodes[0], plan
    call = nodes[0].split("[", 1)[1].split("]")[0]
    assert call.count("text#") == 1 and "source#" not in call and "n_chars#" not in call, plan
    assert sorted(tuple(r)[:5] for r in found.collect()) == [rows[0], rows[4]] and found.columns == [*df.columns, "lang_pred", "score"]


def test_pipeline_language_id_score_needs_little_memory_and_no_company():
    """A worker's arrays stay small beside a batch of many texts; a text scores the same in any batch."""
    model = _language_model()
    texts = [f"{i * 7919 % 1009} " * (1 + i % 400) for i in range(1_500)] + [None, "", "x" * 300_000]
    column = pa.array(texts, pa.string())
    language_id._scored(model, column.slice(0, 40))
    tracemalloc.start()
    whole = language_id._scored(model, column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20, peak
    for i in (0, 7, 399, 1_499, 1_500, 1_501, 1_502):
        assert language_id._scored(model, column.slice(i, 1))[0] == whole[i]
    assert whole[1_500].as_py() == {"lang_pred": "und", "score": 0.0}
    assert len(language_id._scored(model, column.slice(0, 0))) == 0


@pytest.mark.parametrize("step", ["signatures", "seeds"])
def test_pipeline_whole_texts_meet_python_in_small_batches(spark, step):
    """Near-dedup and passages hand Python at most TEXT_ROWS texts at once; results and the session's setting stay."""
    rows = [(i, " ".join(f"w{i % 1_200}x{j}" for j in range(81))) for i in range(2_400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(shared.ARROW_ROWS)
    assert max(r["n"] for r in shared.written(df.mapInArrow(sizes, "n long"), step, texts=True).collect()) <= shared.TEXT_ROWS
    assert spark.conf.get(shared.ARROW_ROWS) == before
    seen = []
    own = shared.at_most
    try:
        shared.at_most = lambda session, n: seen.append(n) or own(session, n)
        if step == "signatures":
            got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()}
            assert got == {i: i % 1_200 for i in range(2_400)}
        else:
            assert passages.passages(df).filter("doc_id >= 1200 AND start_word = 0 AND end_word = 81").count() == 1_200
    finally:
        shared.at_most = own
    assert len(seen) == 2 and set(seen) == {shared.TEXT_ROWS} and spark.conf.get(shared.ARROW_ROWS) == before
    with pytest.raises(ValueError), shared.at_most(spark, 5):
        assert spark.conf.get(shared.ARROW_ROWS) == "5"
        raise ValueError
    assert spark.conf.get(shared.ARROW_ROWS) == before


def test_pipeline_encoding_and_decoding_share_no_task(spark):
    """A task that encodes and decodes at once keeps two Python workers, each with the ranks; results as before."""
    rows = [(0, "One two  three été", "en", "a", 18), (1, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 9_000, "en", "a", 45_000), (0, "One two  three été", "en", "a", 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.encode(spark, docs, "")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    found = sorted((r["doc_id"], r["decoded"], r["n_tokens"] == len(r["ids"])) for r in got.collect())
    assert found == sorted((r[0], r[1] or "", True) for r in rows)


def _python_steps_in_a_task(node, above=0):
    """The most Python steps that a task of the plan runs at once."""
    if node.nodeName() in ("Aggregate", "Window", "RepartitionByExpression"):
        above = 0  # dealt anew: other tasks below
    above += node.nodeName() == "MapInArrow"
    return max([above, *(_python_steps_in_a_task(node.children().apply(i), above) for i in range(node.children().size()))])


def test_op8_a_task_has_one_python_worker(spark, tmp_path, monkeypatch):
    """Encoding and cutting share a worker, which gets few whole texts at once; each task kept two, both with the libraries."""
    rows = [(0, "One two  three été"), (1, None), (2, ""), (3, "word " * 9_000), (0, "One two  three été"), (None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plans, sizes, own = [], [], shared.at_most
    monkeypatch.setattr(shared, "at_most", lambda session, n: sizes.append(n) or own(session, n))

    def written(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan())
        return shared.written(df, *args, **options)

    monkeypatch.setattr(training_order, "written", written)
    found = registered.op8_training_order(spark, str(tmp_path)).collect()
    assert [_python_steps_in_a_task(p) for p in plans] == [1] and sizes == [shared.TEXT_ROWS]
    assert sorted(r["slot"] for r in found) == list(range(len(found))) and {r["doc_id"] for r in found} == {0, 3, None}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_op8_records_cut_by_the_encoder(spark, kind):
    """The same records, each with a slot of its own, whether the encoder's workers cut the ids or ``materialise`` does."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    ranks, pattern = public_tokenizers.path(registered.BYTE_RANKS), public_tokenizers.PATTERN
    texts = ["One two  three été", None, "", "word " * 9_000, "One two  three été", "x" * 40_000, "日本語 🙂 " * 70, "a b c d e f g h " * 8, "word " * 9_000]
    rows = [(i % 7, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (20, "word " * 9_000), (20, "word " * 9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind)).coalesce(2)
    plain = training_order.materialise(byte_bpe.encode(docs, ranks, pattern), key=3, length=64, shard_rows=50)
    cut = training_order.materialise(byte_bpe.encode(docs, ranks, pattern, then=training_order.cutting(64)), key=3, length=64, shard_rows=50)
    assert cut.schema == plain.schema
    got, want = cut.collect(), plain.collect()
    assert len(got) > 600 and sorted(r["slot"] for r in got) == list(range(len(got)))
    assert all((r["shard"], r["offset"]) == (r["slot"] // 50, r["slot"] % 50 * 128) for r in got)
    parts = lambda rows: Counter((r["doc_id"], r["seq"], r["n_tokens"], bytes(r["record"])) for r in rows)
    assert parts(got) == parts(want)
    nothing = byte_bpe.encode(docs.filter("doc_id = 1 AND text IS NULL"), ranks, pattern, then=training_order.cutting())
    assert training_order.materialise(nothing, key=3).count() == 0
