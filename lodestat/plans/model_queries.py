"""Named queries on preparation, models, evaluation, clustering and reduction."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lodestat.functions import arrays as ar
from lodestat.functions import hashing as hs
from lodestat.operators import aggregates as ag
from lodestat.operators import joins as jo
from lodestat.operators import prep as pr
from lodestat.operators import metrics as me
from lodestat.plans import sqltext as q
from lodestat.plans.registry import query
from lodestat.sources import readers as rd

SEED = 42


def _t(spark, folder, name):
    return rd.read_dataset(spark, folder, name)


def _emb(spark, folder):
    e = rd.read_dataset(spark, folder, "embeddings", spread_by="vec_id")
    return e.withColumn("embedding", ar.doubles(F.col("embedding")))


def _long(c):
    return F.col(c).cast("bigint").alias(c)


# --- preparation -------------------------------------------------------------------------------

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _one_hot_sql(values):
    return "SELECT c_custkey, " + ", ".join(
        f"CAST(c_mktsegment = '{v}' AS INT) AS \"c_mktsegment={v}\"" for v in values
    ) + " FROM customer"


@query("pre1_one_hot", _one_hot_sql(_SEGMENTS))
def one_hot(spark, folder):
    c = _t(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return pr.one_hot(c, ["c_mktsegment"]).drop("c_mktsegment")


@query("pre2_one_hot_base_value", _one_hot_sql(_SEGMENTS[1:]))
def one_hot_base(spark, folder):
    c = _t(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return pr.one_hot(c, ["c_mktsegment"], drop_first=True).drop("c_mktsegment")


_HOLES = """h AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem)"""


def _with_holes(spark, folder):
    """The given tables have no nulls; these are planted by a rule that SQL can repeat."""
    c = F.col
    return _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(c("l_orderkey") % 7 != 0, c("l_quantity")).alias("quantity"),
        F.when(c("l_partkey") % 11 != 0, c("l_returnflag")).alias("flag"),
    )


@query(
    "pre3_impute_average",
    f"""WITH {_HOLES}, m AS (SELECT flag AS common FROM h WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, l_partkey, l_linenumber, round(coalesce(quantity, (SELECT avg(quantity) FROM h)), 6) AS quantity, coalesce(flag, common) AS flag FROM h, m""",
)
def impute_average(spark, folder):
    out = pr.impute(_with_holes(spark, folder), ["quantity"], ["flag"])
    return out.withColumn("quantity", F.round("quantity", 6))


@query("pre4_impute_drop", f"WITH {_HOLES} SELECT * FROM h WHERE quantity IS NOT NULL AND flag IS NOT NULL")
def impute_drop(spark, folder):
    return pr.impute(_with_holes(spark, folder), ["quantity"], ["flag"], strategy="drop")


@query(
    "pre5_standardize",
    """SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
  round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice FROM lineitem""",
)
def standardize(spark, folder):
    li = _t(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    z = pr.standardize(li, ["l_quantity", "l_extendedprice"])
    return z.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_extendedprice")})


@query(
    "pre7_rescale_vector",
    f"WITH {q.EMB} SELECT vec_id, round(list_sum([x / 255 FOR x IN v]), 9) AS total FROM e",
)
def rescale_vector(spark, folder):
    scaled = pr.rescale(_emb(spark, folder), "embedding", 255.0, "scaled")
    return scaled.select("vec_id", F.round(ar.total(F.col("scaled")), 9).alias("total"))


@query(
    "pre8_one_hot_label",
    "SELECT vec_id, CAST(i AS BIGINT) AS pos, CAST(i = label AS INT) AS hit FROM embeddings, range(10) t(i)",
)
def one_hot_label(spark, folder):
    hot = pr.one_hot_label(_t(spark, folder, "embeddings"), "label", 10, "hot")
    return hot.select("vec_id", F.posexplode("hot").alias("pos", "hit")).withColumn("pos", _long("pos"))


@query(
    "pre9_polynomial_terms",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(p_size AS DOUBLE) * p_size AS "p_size*p_size", CAST(p_size AS DOUBLE) * p_size * p_size AS "p_size*p_size*p_size", 1.0::DOUBLE AS bias FROM part""",
)
def polynomial_terms(spark, folder):
    part = _t(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"))
    return pr.poly(part, ["p_size"], 3, bias=True)


@query(
    "pre9_polynomial_two_columns",
    "SELECT l_orderkey, l_partkey, l_linenumber, round(l_discount * l_discount, 9) AS xx, round(l_discount * l_tax, 9) AS xy, round(l_tax * l_tax, 9) AS yy FROM lineitem",
)
def polynomial_two(spark, folder):
    out = pr.poly(_t(spark, folder, "lineitem"), ["l_discount", "l_tax"], 2)
    terms = {"xx": "l_discount*l_discount", "xy": "l_discount*l_tax", "yy": "l_tax*l_tax"}
    return out.select("l_orderkey", "l_partkey", "l_linenumber", *[F.round(F.col(f"`{t}`"), 9).alias(n) for n, t in terms.items()])


@query(
    "pre10_split",
    f"SELECT o_orderkey, CASE WHEN {q.hash_unit('o_orderkey', SEED)} < 0.2 THEN 'test' ELSE 'train' END AS side FROM orders",
)
def split(spark, folder):
    train, test = pr.split(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.2, SEED)
    return jo.stacked_rows(train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test")))


_ORDER = f"SELECT o_orderkey, row_number() OVER (ORDER BY md5('{SEED}:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n FROM orders"


@query(
    "pre11_sample_and_rest",
    f"SELECT o_orderkey, CASE WHEN r <= round(n * 0.2) THEN 'sample' ELSE 'rest' END AS side FROM ({_ORDER})",
)
def sample_and_rest(spark, folder):
    taken, rest = pr.sample(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.2, SEED)
    return jo.stacked_rows(taken.withColumn("side", F.lit("sample")), rest.withColumn("side", F.lit("rest")))


_FOLDS = f"SELECT o_orderkey, ntile({{n}}) OVER (ORDER BY md5('{SEED}:' || o_orderkey), o_orderkey) - 1 AS fold FROM orders"


@query("pre13_shuffled_folds", _FOLDS.format(n=5))
def shuffled_folds(spark, folder):
    return pr.folds(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 5, SEED)


@query(
    "pre12_one_fold_of_ten",
    f"SELECT o_orderkey, CASE WHEN fold = 3 THEN 'fold' ELSE 'rest' END AS side FROM ({_FOLDS.format(n=10)})",
)
def one_fold(spark, folder):
    data = pr.folds(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 10, SEED)
    rest, hit = pr.fold_split(data, "fold", 3)
    both = jo.stacked_rows(rest.withColumn("side", F.lit("rest")), hit.withColumn("side", F.lit("fold")))
    return both.select("o_orderkey", "side")


@query("pre13_quick_folds", f"SELECT o_orderkey, {q.hash_int('o_orderkey', SEED)} % 6 AS fold FROM orders")
def quick_folds(spark, folder):
    return pr.quick_folds(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 6, SEED)


@query("pre14_contiguous_folds", "SELECT o_orderkey, ntile(10) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders")
def contiguous_folds(spark, folder):
    return pr.folds(_t(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 10, shuffle=False)


@query(
    "pre15_stratified_folds",
    f"SELECT vec_id, label, ntile(5) OVER (PARTITION BY label ORDER BY md5('{SEED}:' || vec_id), vec_id) - 1 AS fold FROM embeddings",
)
def stratified_folds(spark, folder):
    return pr.folds(_t(spark, folder, "embeddings").select("vec_id", "label"), "vec_id", 5, SEED, by="label")


@query(
    "pre16_split_by_entity",
    "SELECT o_orderkey, CASE WHEN o_custkey < 300 THEN 'seen' ELSE 'unseen' END AS side FROM orders",
)
def split_by_entity(spark, folder):
    seen, unseen = pr.split_by_group(_t(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 300)
    both = jo.stacked_rows(seen.withColumn("side", F.lit("seen")), unseen.withColumn("side", F.lit("unseen")))
    return both.select("o_orderkey", "side")


@query(
    "pre17_split_by_time",
    "SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1997-12-31 00:00:00' THEN 'after' ELSE 'before' END AS side FROM orders",
)
def split_by_time(spark, folder):
    before, after = pr.split_by_time(_t(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1997-12-31 00:00:00")
    both = jo.stacked_rows(before.withColumn("side", F.lit("before")), after.withColumn("side", F.lit("after")))
    return both.select("o_orderkey", "side")


@query("pre18_split_half", "SELECT vec_id, CASE WHEN ntile(2) OVER (ORDER BY vec_id) = 1 THEN 'first' ELSE 'second' END AS half FROM embeddings")
def split_half(spark, folder):
    first, second = pr.split_half(_t(spark, folder, "embeddings").select("vec_id"), ["vec_id"])
    return jo.stacked_rows(first.withColumn("half", F.lit("first")), second.withColumn("half", F.lit("second")))


@query(
    "pre19_sparse_rows",
    """SELECT l_orderkey, CAST(count(DISTINCT l_suppkey % 1000) AS BIGINT) AS nonzero, round(sum(l_quantity), 4) AS total FROM lineitem GROUP BY l_orderkey""",
)
def sparse_rows(spark, folder):
    cells = _t(spark, folder, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 1000).alias("j"), "l_quantity")
    rows = pr.rows_from_coo(cells, "l_orderkey", "j", "l_quantity", 1000)
    dense = vector_to_array("vector")
    return rows.select(
        "l_orderkey", F.size(F.filter(dense, lambda x: x != 0)).cast("bigint").alias("nonzero"),
        F.round(ar.total(dense), 4).alias("total"),
    )


@query(
    "pre20_score_grid",
    """WITH b AS (SELECT min(l_discount) - 0.05 AS x0, max(l_discount) + 0.05 AS x1, min(l_tax) - 0.05 AS y0, max(l_tax) + 0.05 AS y1 FROM lineitem)
SELECT round(x0 + i * 0.01, 6) AS l_discount, round(y0 + j * 0.01, 6) AS l_tax FROM b, range(1000) t(i), range(1000) u(j)
WHERE i < ceil((x1 - x0) / 0.01) AND j < ceil((y1 - y0) / 0.01)""",
)
def score_grid(spark, folder):
    g = pr.score_grid(_t(spark, folder, "lineitem"), "l_discount", "l_tax", 0.05, 0.01)
    return g.select(F.round("l_discount", 6).alias("l_discount"), F.round("l_tax", 6).alias("l_tax"))


# --- evaluation on a table of predictions -------------------------------------------------------

# price predicted by a fixed rule, so that SQL sees the same predictions
_PRED = "p AS (SELECT l_extendedprice AS label, 1500 * l_quantity AS prediction FROM lineitem)"
_CLS = "p AS (SELECT quality AS label, CASE WHEN n_chars > 600 AND toxic = 0 THEN 1 ELSE 0 END AS prediction, n_chars AS score FROM labels JOIN documents USING (doc_id))"


def _priced(spark, folder):
    return _t(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (1500 * F.col("l_quantity")).alias("prediction")
    )


def _judged(spark, folder):
    docs = _t(spark, folder, "documents").select("doc_id", "n_chars")
    guess = F.when((F.col("n_chars") > 600) & (F.col("toxic") == 0), 1).otherwise(0)
    return _t(spark, folder, "labels").join(docs, "doc_id").select(
        F.col("quality").alias("label"), guess.alias("prediction"), F.col("n_chars").alias("score")
    )


@query(
    "eva1_r2",
    f"WITH {_PRED} SELECT round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 6) AS r2 FROM p",
)
def r2(spark, folder):
    return me.r2(_priced(spark, folder)).select(F.round("r2", 6).alias("r2"))


@query(
    "eva2_regression_metrics",
    f"WITH {_PRED} SELECT round(avg((label - prediction) ** 2), 1) AS mse, round(sqrt(avg((label - prediction) ** 2)), 4) AS rmse, round(avg(abs(label - prediction)), 4) AS mae, round(sum((label - prediction) ** 2) / 1e6, 2) AS sse_millions FROM p",
)
def regression_metrics(spark, folder):
    m = me.reg_metrics(_priced(spark, folder))
    return m.select(
        F.round("mse", 1).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round(F.col("sse") / 1e6, 2).alias("sse_millions"),
    )


@query("eva3_accuracy", f"WITH {_CLS} SELECT round(avg(CAST(label = prediction AS INT)), 9) AS accuracy, round(1 - avg(CAST(label = prediction AS INT)), 9) AS error FROM p")
def accuracy(spark, folder):
    a = me.accuracy(_judged(spark, folder))
    return a.select(F.round("accuracy", 9).alias("accuracy"), F.round("error", 9).alias("error"))


_CELLS = f"""{_CLS}, g AS (SELECT DISTINCT label AS x FROM p UNION SELECT DISTINCT prediction FROM p),
c AS (SELECT a.x AS label, b.x AS prediction, count(p.label) AS n FROM g a CROSS JOIN g b LEFT JOIN p ON p.label = a.x AND p.prediction = b.x GROUP BY ALL)"""


@query("eva4_confusion", f"WITH {_CELLS} SELECT label, prediction, n FROM c")
def confusion(spark, folder):
    return me.confusion(_judged(spark, folder))


@query("eva5_confusion_shares", f"WITH {_CELLS} SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label), 9) AS share FROM c")
def confusion_shares(spark, folder):
    return me.confusion(_judged(spark, folder), normalize=True).withColumn("share", F.round("share", 9))


@query(
    "eva6_confusion_rows",
    "SELECT doc_id, quality, toxic FROM labels WHERE (quality = 1 AND toxic = 1) OR (quality = 0 AND toxic = 0)",
)
def confusion_rows(spark, folder):
    return me.confusion_rows(_t(spark, folder, "labels"), [(1, 1), (0, 0)], "quality", "toxic")


_REPORT = f"""{_CELLS}, s AS (SELECT label, CAST(sum(n) AS BIGINT) AS support, sum(n) FILTER (label = prediction) AS tp FROM c GROUP BY label),
k AS (SELECT prediction AS label, sum(n) AS predicted FROM c GROUP BY prediction),
r AS (SELECT label, support, tp / predicted AS precision, tp / support AS recall FROM s JOIN k USING (label)),
f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM r)"""


@query(
    "eva7_class_report",
    f"WITH {_REPORT} SELECT label, support, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f",
)
def class_report(spark, folder):
    r = me.report(_judged(spark, folder))
    return r.select("label", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "eva7_report_averages",
    f"""WITH {_REPORT} SELECT round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1,
  round(sum(precision * support) / sum(support), 9) AS weighted_precision, round(sum(recall * support) / sum(support), 9) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 9) AS weighted_f1, CAST(sum(support) AS BIGINT) AS support FROM f""",
)
def report_averages(spark, folder):
    r = me.report_averages(me.report(_judged(spark, folder)))
    return r.select(*[F.round(c, 9).alias(c) if c != "support" else F.col(c) for c in r.columns])


@query(
    "eva8_classifier_metrics",
    f"""WITH {_CLS}, ranked AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM p),
u AS (SELECT (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM ranked),
t AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn, avg(CAST(label = prediction AS INT)) AS acc FROM p)
SELECT round(auc, 9) AS auc, round(acc, 9) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall FROM u, t""",
)
def classifier_metrics(spark, folder):
    m = me.cls_metrics(_judged(spark, folder))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query(
    "reg15_support_ratio",
    f"WITH {_PRED} SELECT round(avg(CAST(abs(label - prediction) >= 5000 AS INT)), 9) AS support_ratio FROM p",
)
def support_ratio(spark, folder):
    return me.support_ratio(_priced(spark, folder), 5000.0).select(F.round("support_ratio", 9).alias("support_ratio"))


@query("clu6_crosstab", "SELECT lang, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def crosstab(spark, folder):
    docs = _t(spark, folder, "documents").select("doc_id", "lang")
    return me.crosstab(docs.join(_t(spark, folder, "labels"), "doc_id"), "lang", "quality")
