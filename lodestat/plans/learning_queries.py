"""Named queries on neighbours in vector space, projections, models, selection, clusters, components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lodestat.functions import arrays as ar
from lodestat.functions import text as tx
from lodestat.operators import classify as cl
from lodestat.operators import clustering as cu
from lodestat.operators import corpus as co
from lodestat.operators import joins as jo
from lodestat.operators import kernel as ke
from lodestat.operators import linear as li
from lodestat.operators import linkage as lk
from lodestat.operators import metrics as me
from lodestat.operators import moments as mo
from lodestat.operators import neighbours as nn
from lodestat.operators import prep as pr
from lodestat.operators import projection as rp
from lodestat.operators import sparse_lasso as sp
from lodestat.operators import reduction as re
from lodestat.operators import selection as se
from lodestat.operators.estimators import DescentRegressor
from lodestat.plans import sqltext as q
from lodestat.plans.registry import query
from lodestat.plans.text_queries import WORDS, _bench_items, _bow, _docs, _tfidf
from lodestat.sources import readers as rd

SEED = 42


def _t(spark, folder, name):
    return rd.read_dataset(spark, folder, name)


def _emb(spark, folder):
    e = rd.read_dataset(spark, folder, "embeddings", spread_by="vec_id")
    return e.select("vec_id", "label", ar.doubles(F.col("embedding")).alias("v"))


def _ml(df):
    return df.withColumn("features", array_to_vector("v")).withColumn("label", F.col("label").cast("double"))


def _two_class(df):
    return df.withColumn("label", F.when(F.col("label").isin(1, 4, 7), 1.0).otherwise(0.0))


def _sides(df):
    return pr.split(df, "vec_id", 0.2, SEED)


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- neighbours in vector space ----------------------------------------------------------------

K = 5
_SIDE = f"{q.EMB}, s AS (SELECT *, {q.hash_unit('vec_id', SEED)} < 0.2 AS is_test FROM e)"
_DENSE = f"""{_SIDE}, d AS (SELECT a.vec_id AS test_id, a.label AS truth, b.vec_id AS id, b.label, round(list_distance(a.v, b.v) ** 2, 9) AS d2
  FROM s a JOIN s b ON a.is_test AND NOT b.is_test),
r AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY d2, id) AS rank FROM d)"""
_WON = f"""w AS (SELECT test_id, label, count(*) AS votes FROM r WHERE rank <= {K} GROUP BY ALL),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY votes DESC, label) AS x FROM w) WHERE x = 1)"""


def _near(spark, folder, k):
    train, test = _sides(_emb(spark, folder))
    return nn.dense_knn(train, test, k, id_col="vec_id"), test


@query("knn4_dense_neighbours", f"WITH {_DENSE} SELECT test_id, id, label, round(sqrt(d2), 6) AS distance, rank FROM r WHERE rank <= {K}")
def dense_neighbours(spark, folder):
    near, _ = _near(spark, folder, K)
    return near.select("test_id", "id", "label", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank"))


@query("knn4_classify", f"WITH {_DENSE}, {_WON} SELECT test_id, label AS prediction, votes, round(votes / {K}, 9) AS share FROM won")
def knn_classify(spark, folder):
    near, _ = _near(spark, folder, K)
    return nn.knn_classify(near).withColumn("share", F.round("share", 9))


@query("knn5_vote_shares", f"WITH {_DENSE}, {_WON} SELECT test_id, label, round(votes / {K}, 9) AS proba FROM w")
def vote_shares(spark, folder):
    near, _ = _near(spark, folder, K)
    return nn.knn_proba(near).withColumn("proba", F.round("proba", 9))


@query(
    "knn6_error_curve",
    f"""WITH {_DENSE}, w AS (SELECT test_id, truth, k, label, count(*) AS votes FROM r, range(1, 25) t(k) WHERE rank <= k GROUP BY ALL),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY test_id, k ORDER BY votes DESC, label) AS x FROM w) WHERE x = 1)
SELECT CAST(k AS INT) AS k, round(avg(CAST(label <> truth AS INT)), 9) AS error FROM won GROUP BY k""",
)
def error_curve(spark, folder):
    near, test = _near(spark, folder, 24)
    return nn.knn_error_curve(near, test, list(range(1, 25)), "vec_id", "label").withColumn("error", F.round("error", 9))


@query("knn7_hashed_neighbours")
def hashed_neighbours(spark, folder):
    train, test = _sides(_emb(spark, folder))
    return nn.knn_lsh(train, test, K, radius=1.2, id_col="vec_id")


# --- random projection and topic regression ------------------------------------------------------

DIM, RP_SEED = 32, 11
# the source whose documents count as the topic
TOPIC = "src1"


def _sign_sql(dim):
    base = f"(p.pos * 7919 + j * 104729 + {RP_SEED} * 1299709)"
    x1 = f"(({base} + 12345) % 2147483647)"
    x2 = f"(({x1} * {x1}) % 2147483647)"
    x3 = f"(({x2} * {x2} + {base}) % 2147483647)"
    return f"m AS (SELECT p.pos, CAST(j AS BIGINT) AS j, CASE WHEN ({x3} // 8) % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS r FROM (SELECT pos FROM dict) p, range({dim}) t(j))"


@query(
    "rpj1_random_projection",
    q.corpus_ctes(WORDS) + f", {_sign_sql(DIM)} SELECT doc_id, j AS pos, round(sum(weight * r), 6) AS value FROM tfidf JOIN m USING (pos) GROUP BY ALL",
)
def random_projection(spark, folder):
    _, _, values = _tfidf(spark, folder)
    vectors = rp.random_projection(values, "doc_id", "weight", DIM, RP_SEED, "sign")
    return vectors.select("doc_id", F.posexplode("vector").alias("pos", "value")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), (F.round("value", 6) + 0.0).alias("value")
    )


_FIT2 = f"""{_sign_sql(2)}, x AS (SELECT doc_id, source, sum(weight * r) FILTER (j = 0) AS a, sum(weight * r) FILTER (j = 1) AS b FROM tfidf JOIN m USING (pos) GROUP BY ALL),
g AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(CASE WHEN source = '{TOPIC}' THEN a ELSE -a END) AS ya, sum(CASE WHEN source = '{TOPIC}' THEN b ELSE -b END) AS yb FROM x),
w AS (SELECT (bb * ya - ab * yb) / (aa * bb - ab * ab) AS w0, (aa * yb - ab * ya) / (aa * bb - ab * ab) AS w1 FROM g)"""


@query(
    "rpj2_topic_regression",
    q.corpus_ctes(WORDS) + f", {_FIT2} SELECT 0 AS pos, round(w0, 4) AS weight FROM w UNION ALL SELECT 1, round(w1, 4) FROM w",
)
def topic_regression(spark, folder):
    _, _, values = _tfidf(spark, folder)
    fit = rp.topic_regression(values, "doc_id", "weight", _t(spark, folder, "documents"), "source", [TOPIC], 2, RP_SEED, "sign")
    rows = [(i, float(w)) for i, w in enumerate(fit.weights)]
    return _rounded(spark.createDataFrame(rows, "pos int, weight double"), 4)


@query(
    "rpj3_predict_topic",
    q.corpus_ctes(WORDS) + ",\n" + q.query_ctes() + f""", {_FIT2}, z AS (SELECT item_id, sum(weight * r) FILTER (j = 0) AS a, sum(weight * r) FILTER (j = 1) AS b FROM q JOIN m USING (pos) GROUP BY item_id)
SELECT item_id, round(a * w0 + b * w1, 4) AS score, CASE WHEN a * w0 + b * w1 > 0 THEN 'about the topic' ELSE 'not about the topic' END AS answer FROM z, w""",
)
def predict_topic(spark, folder):
    words, weights, values = _tfidf(spark, folder)
    fit = rp.topic_regression(values, "doc_id", "weight", _t(spark, folder, "documents"), "source", [TOPIC], 2, RP_SEED, "sign")
    asked = co.vectorize_query(_bench_items(spark, folder), words, weights, "item_id", "text", WORDS)
    out = rp.predict_topic(asked, fit, "item_id", "about the topic", "not about the topic")
    return out.withColumn("score", F.round("score", 4) + 0.0)


@query("rpj3_predict_language_gaussian")
def predict_language(spark, folder):
    words, weights, values = _tfidf(spark, folder)
    fit = rp.topic_regression(values, "doc_id", "weight", _t(spark, folder, "documents"), "lang", ["en"], 128, RP_SEED)
    asked = co.vectorize_query(_bench_items(spark, folder), words, weights, "item_id", "text", WORDS)
    return rp.predict_topic(asked, fit, "item_id", "English", "not English")


# --- linear models -------------------------------------------------------------------------------

_LP = "lp AS (SELECT l_orderkey, l_extendedprice / 1000 AS y, l_quantity AS x1, l_discount * 100 AS x2, l_tax * 100 AS x3 FROM lineitem)"


def _priced(spark, folder, spread=False):
    c = F.col
    return rd.read_dataset(spark, folder, "lineitem", spread_by="l_orderkey" if spread else None).select(
        "l_orderkey", "l_partkey", "l_linenumber", (c("l_extendedprice") / 1000).alias("y"), c("l_quantity").alias("x1"),
        (c("l_discount") * 100).alias("x2"), (c("l_tax") * 100).alias("x3"),
    )


@query(
    "reg1_ols_one_predictor",
    f"WITH {_LP} SELECT '(intercept)' AS term, round(regr_intercept(y, x1), 6) AS estimate FROM lp UNION ALL SELECT 'x1', round(regr_slope(y, x1), 6) FROM lp",
)
def ols_one(spark, folder):
    return _rounded(li.ols(_priced(spark, folder), "y", ["x1"]).table(spark))


def _two_sql(alpha):
    return f"""{_LP}, s AS (SELECT count(*) * var_pop(x1) + {alpha} AS s11, count(*) * var_pop(x2) + {alpha} AS s22, count(*) * covar_pop(x1, x2) AS s12,
  count(*) * covar_pop(x1, y) AS s1, count(*) * covar_pop(x2, y) AS s2, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM lp),
w AS (SELECT (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS w1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) AS w2, m1, m2, my FROM s)
SELECT '(intercept)' AS term, round(my - w1 * m1 - w2 * m2, 6) AS estimate FROM w UNION ALL SELECT 'x1', round(w1, 6) FROM w UNION ALL SELECT 'x2', round(w2, 6) FROM w"""


@query("reg1_ols_two_predictors", f"WITH {_two_sql(0)}")
def ols_two(spark, folder):
    return _rounded(li.ols(_priced(spark, folder), "y", ["x1", "x2"]).table(spark))


@query("reg2_ridge", f"WITH {_two_sql(5000)}")
def ridge(spark, folder):
    return _rounded(li.ridge(_priced(spark, folder), "y", ["x1", "x2"], 5000).table(spark))


@query(
    "reg3_lasso_one_predictor",
    f"""WITH {_LP}, s AS (SELECT covar_pop(x1, y) AS c, var_pop(x1) AS v, avg(x1) AS mx, avg(y) AS my FROM lp),
w AS (SELECT sign(c) * greatest(abs(c) - 20, 0) / v AS w, mx, my FROM s)
SELECT '(intercept)' AS term, round(my - w * mx, 4) AS estimate FROM w UNION ALL SELECT 'x1', round(w, 4) FROM w""",
)
def lasso_one(spark, folder):
    return _rounded(li.lasso(_priced(spark, folder), "y", ["x1"], 20.0).table(spark), 4)


@query("reg3_lasso")
def lasso(spark, folder):
    return _rounded(li.lasso(_priced(spark, folder), "y", ["x1", "x2", "x3"], 0.05).table(spark), 4)


@query(
    "reg4_ridge_unit_columns",
    f"WITH {_LP} SELECT '(intercept)' AS term, round(avg(y) - regr_slope(y, x1) / 1.5 * avg(x1), 6) AS estimate FROM lp UNION ALL SELECT 'x1', round(regr_slope(y, x1) / 1.5, 6) FROM lp",
)
def ridge_unit(spark, folder):
    return _rounded(li.ridge(_priced(spark, folder), "y", ["x1"], 0.5, normalize=True).table(spark))


@query(
    "reg5_ridge_leave_one_out",
    f"""WITH {_LP}, s AS (SELECT count(*) AS n, count(*) * covar_pop(x1, y) AS c, count(*) * var_pop(x1) AS v, avg(x1) AS mx, avg(y) AS my FROM lp),
a AS (SELECT unnest([0.1, 1.0, 10.0, 100000.0])::DOUBLE AS alpha)
SELECT alpha, round(avg(((y - my - (x1 - mx) * c / (v + alpha)) / (1 - 1 / n - (x1 - mx) ** 2 / (v + alpha))) ** 2), 6) AS loo_mse FROM lp, s, a GROUP BY alpha""",
)
def ridge_leave_one_out(spark, folder):
    _, scores = li.ridge_cv(_priced(spark, folder), "y", ["x1"], [0.1, 1.0, 10.0, 100_000.0])
    return _rounded(scores)


@query("reg6_vector_regression")
def vector_regression(spark, folder):
    e = _emb(spark, folder).withColumn("upper", F.slice("v", 1, 32)).withColumn("lower", F.slice("v", 33, 32))
    train, test = _sides(e)
    fit = li.multi_ridge(train, "upper", "lower", 1.0)
    gap = ar.distance(F.col("prediction"), F.col("lower"))
    return li.predict_vector(test, fit, "upper").select("vec_id", F.round(gap, 6).alias("error"))


@query(
    "reg7_gradient_descent",
    """WITH RECURSIVE pp AS (SELECT p_retailprice / 1000 AS y, p_size / 10.0 AS x FROM part),
s AS (SELECT avg(x) AS mx, avg(y) AS my, avg(x * x) AS mxx, avg(x * y) AS mxy, avg(y * y) AS myy FROM pp),
g AS (SELECT 0 AS iteration, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1
  UNION ALL SELECT iteration + 1, t0 - 0.05 * (t0 + t1 * mx - my), t1 - 0.05 * (t0 * mx + t1 * mxx - mxy) FROM g, s WHERE iteration < 24)
SELECT iteration, round((t0 * t0 + 2 * t0 * t1 * mx + t1 * t1 * mxx - 2 * t0 * my - 2 * t1 * mxy + myy) / 2, 6) AS loss, round(t0, 6) AS theta0, round(t1, 6) AS theta1 FROM g, s""",
)
def gradient_descent(spark, folder):
    part = _t(spark, folder, "part").select((F.col("p_retailprice") / 1000).alias("y"), (F.col("p_size") / 10.0).alias("x"))
    d = li.gd_linear(part, "y", ["x"], 0.05, 25).table(spark)
    return _rounded(d.select("iteration", "loss", F.col("theta")[0].alias("theta0"), F.col("theta")[1].alias("theta1")))


@query(
    "reg8_predict",
    f"WITH {_LP}, lq AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS x1 FROM lineitem) SELECT l_orderkey, l_partkey, l_linenumber, round((SELECT regr_intercept(y, x1) FROM lp) + (SELECT regr_slope(y, x1) FROM lp) * x1, 6) AS prediction FROM lq",
)
def predict(spark, folder):
    data = _priced(spark, folder)
    out = li.predict(data, li.ols(data, "y", ["x1"]))
    return out.select("l_orderkey", "l_partkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


@query(
    "reg9_loss_surface",
    f"""WITH {_LP}, s AS (SELECT avg(x1) AS mx, avg(y) AS my, avg(x1 * x1) AS mxx, avg(x1 * y) AS mxy, avg(y * y) AS myy FROM lp),
g AS (SELECT -10 + i * 1.0 AS theta0, -1 + j * 0.1 AS theta1 FROM range(20) t(i), range(40) u(j))
SELECT round(theta0, 6)::DOUBLE AS theta0, round(theta1, 6)::DOUBLE AS theta1, round((myy + theta0 * theta0 + theta1 * theta1 * mxx + 2 * theta0 * theta1 * mx - 2 * theta0 * my - 2 * theta1 * mxy) / 2, 4) AS loss FROM g, s""",
)
def loss_surface(spark, folder):
    g0 = ar.arange(F.lit(-10.0), F.lit(10.0), 1.0)
    g1 = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda j: F.lit(-1.0) + j * F.lit(0.1))
    s = li.loss_surface(_priced(spark, folder), "y", "x1", g0, g1)
    return s.select(
        F.round("theta0", 6).alias("theta0"), (F.round("theta1", 6) + 0.0).alias("theta1"), F.round("loss", 4).alias("loss")
    )


@query(
    "reg10_ridge_path",
    f"""WITH {_LP}, s AS (SELECT count(*) * var_pop(x1) AS s11, count(*) * var_pop(x2) AS s22, count(*) * covar_pop(x1, x2) AS s12,
  count(*) * covar_pop(x1, y) AS s1, count(*) * covar_pop(x2, y) AS s2 FROM lp), a AS (SELECT (i * 1000)::DOUBLE AS alpha FROM range(200) t(i))
SELECT alpha, 'x1' AS variable, round(((s22 + alpha) * s1 - s12 * s2) / ((s11 + alpha) * (s22 + alpha) - s12 * s12), 6) AS estimate FROM s, a
UNION ALL SELECT alpha, 'x2', round(((s11 + alpha) * s2 - s12 * s1) / ((s11 + alpha) * (s22 + alpha) - s12 * s12), 6) FROM s, a""",
)
def ridge_path(spark, folder):
    return _rounded(li.coef_path(_priced(spark, folder), "y", ["x1", "x2"], [i * 1000.0 for i in range(200)]))


@query("reg10_lasso_path")
def lasso_path(spark, folder):
    return _rounded(li.coef_path(_priced(spark, folder), "y", ["x1", "x2", "x3"], [i / 10 for i in range(1, 10)], "lasso"), 4)


def _assembled(df, *names):
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(df)


@query("reg11_forest_regression")
def forest_regression(spark, folder):
    data = _assembled(_priced(spark, folder, spread=True), "x1", "x2", "x3")
    train, test = pr.split(data, "l_orderkey", 0.2, SEED)
    model = ke.rf_regress(train, "y", "features", trees=20, depth=5, seed=SEED)
    return _rounded(me.reg_metrics(model.transform(test), "y"), 3)


def _kernel_rows(spark, folder):
    """Unit-scaled inputs for the RBF models."""
    scaled = F.array(F.col("x1") / 50, F.col("x2") / 10, F.col("x3") / 8)
    return _priced(spark, folder, spread=True).withColumn("v", scaled)


@query("reg13_rbf_ridge")
def rbf_ridge(spark, folder):
    train, test = pr.split(_kernel_rows(spark, folder), "l_orderkey", 0.2, SEED)
    fit = ke.rbf_ridge(train, "y", "v", gamma=1.0, alpha=0.1, dim=64, seed=SEED)
    return _rounded(me.reg_metrics(ke.predict(test, fit, "v"), "y"), 2)


@query("reg14_rbf_svr")
def rbf_svr(spark, folder):
    train, test = pr.split(_kernel_rows(spark, folder), "l_orderkey", 0.2, SEED)
    fit = ke.rbf_svr(train, "y", "v", gamma=1.0, C=1.0, eps=1.0, dim=64, steps=20, seed=SEED)
    return _rounded(me.reg_metrics(ke.predict(test, fit, "v"), "y"), 2)


@query("reg16_sparse_lasso")
def sparse_lasso(spark, folder):
    """Lasso of document length on the counts of all dictionary words: screening, covariance descent, optimality checks."""
    words, counts = _bow(spark, folder)
    y = _t(spark, folder, "documents").select("doc_id", (F.col("n_chars") / 1000.0).alias("y"))
    model = sp.fit(counts.select("doc_id", "pos", "cnt"), y, 0.05)
    found = model.table(spark)  # at most one row per dictionary word
    return words.select("word", "pos").join(F.broadcast(found), "pos").withColumn("estimate", F.round("estimate", 4))


# --- classifiers -----------------------------------------------------------------------------------


@query("cls1_logistic_l2")
def logistic_l2(spark, folder):
    model = cl.logistic(_ml(_two_class(_emb(spark, folder))), "label", "features", C=1.0)
    return _rounded(cl.coefficient_table(model, [f"v{i}" for i in range(64)]), 4)


@query("cls2_logistic_l1")
def logistic_l1(spark, folder):
    model = cl.logistic(_ml(_two_class(_emb(spark, folder))), "label", "features", C=0.5, penalty="l1")
    return _rounded(cl.coefficient_table(model, [f"v{i}" for i in range(64)]), 4)


@query("cls3_class_probability")
def class_probability(spark, folder):
    train, test = _sides(_ml(_two_class(_emb(spark, folder))))
    p = cl.predict_proba(cl.logistic(train, "label", "features"), test, ["vec_id", "label"])
    return p.select("vec_id", "label", "prediction", F.round(F.col("probability")[1], 4).alias("p1"))


@query("cls4_sparsity_by_penalty")
def sparsity(spark, folder):
    data = _ml(_two_class(_emb(spark, folder))).persist()
    names, parts = [f"v{i}" for i in range(64)], []
    for penalty in ("l1", "l2"):
        for c in (0.1, 1.0):
            table = cl.coefficient_table(cl.logistic(data, "label", "features", c, penalty, iters=100), names)
            parts.append(cl.sparsity(table).withColumn("penalty", F.lit(penalty)).withColumn("C", F.lit(c)))
    data.unpersist()
    return jo.stacked_rows(*parts)


@query(
    "cls5_gaussian_naive_bayes",
    f"""WITH {q.EMB_LONG}, g AS (SELECT label AS c, pos, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM el GROUP BY ALL),
l AS (SELECT vec_id, c, sum(-0.5 * ln(2 * pi() * s) - (v - m) ** 2 / (2 * s)) + ln(min(n) / (SELECT count(*) FROM embeddings)) AS ll FROM el JOIN g USING (pos) GROUP BY vec_id, c)
SELECT vec_id, CAST(c AS INT) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY ll DESC) AS r FROM l) WHERE r = 1""",
)
def gaussian_nb(spark, folder):
    data = _ml(_emb(spark, folder))
    return cl.gaussian_nb(data, "label", "features").transform(data).select("vec_id", F.col("prediction").cast("int").alias("prediction"))


_XY = "xy AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"


def _xy(spark, folder):
    e = _emb(spark, folder)
    return e.select("vec_id", "label", F.element_at("v", 1).alias("x"), F.element_at("v", 2).alias("y"))


@query(
    "cls6_linear_discriminant",
    f"""WITH {_XY}, k AS (SELECT label AS c, count(*) AS n, avg(x) AS mx, avg(y) AS my, count(*) * var_pop(x) AS sx, count(*) * var_pop(y) AS sy, count(*) * covar_pop(x, y) AS sxy FROM xy GROUP BY label),
p AS (SELECT sum(sx) / (sum(n) - count(*)) AS a, sum(sxy) / (sum(n) - count(*)) AS b, sum(sy) / (sum(n) - count(*)) AS d, sum(n) AS total FROM k),
z AS (SELECT vec_id, c, ln(n / total) - 0.5 * (d * (x - mx) ** 2 - 2 * b * (x - mx) * (y - my) + a * (y - my) ** 2) / (a * d - b * b) AS score FROM xy, k, p)
SELECT vec_id, CAST(c AS VARCHAR) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) AS r FROM z) WHERE r = 1""",
)
def linear_discriminant(spark, folder):
    data = _xy(spark, folder)
    return cl.discriminate(data, cl.lda(data, "label", ["x", "y"]), ["x", "y"]).select("vec_id", "prediction")


@query(
    "cls8_quadratic_discriminant",
    f"""WITH {_XY}, k AS (SELECT label AS c, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, var_samp(y) AS d, covar_samp(x, y) AS b FROM xy GROUP BY label),
z AS (SELECT vec_id, c, ln(n / (SELECT count(*) FROM xy)) - 0.5 * ln(a * d - b * b) - 0.5 * (d * (x - mx) ** 2 - 2 * b * (x - mx) * (y - my) + a * (y - my) ** 2) / (a * d - b * b) AS score FROM xy, k)
SELECT vec_id, CAST(c AS VARCHAR) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) AS r FROM z) WHERE r = 1""",
)
def quadratic_discriminant(spark, folder):
    data = _xy(spark, folder)
    return cl.discriminate(data, cl.qda(data, "label", ["x", "y"]), ["x", "y"]).select("vec_id", "prediction")


@query("cls6_linear_discriminant_vectors")
def linear_discriminant_vectors(spark, folder):
    train, test = _sides(_emb(spark, folder))
    out = cl.discriminate(test, cl.lda(train, "label", "v"), "v")
    return me.accuracy(out.withColumn("label", F.col("label").cast("string")))


@query("cls7_discriminant_axes")
def discriminant_axes(spark, folder):
    data = _emb(spark, folder)
    out = cl.lda_transform(data, cl.lda(data, "label", "v"), "v", 2)
    return out.select("vec_id", "label", F.round(F.col("components")[0], 5).alias("c1"), F.round(F.col("components")[1], 5).alias("c2"))


@query("cls9_linear_svm")
def linear_svm(spark, folder):
    model = cl.linear_svm(_ml(_two_class(_emb(spark, folder))), "label", "features", C=0.025, iters=50)
    table = cl.coefficient_table(model, [f"v{i}" for i in range(64)])
    return table.withColumn("margin", F.lit(cl.svm_margin(model)))


@query("cls10_multilayer_perceptron")
def multilayer_perceptron(spark, folder):
    train, test = _sides(_ml(_emb(spark, folder)))
    return me.accuracy(cl.mlp_classify(train, "label", "features", [64, 32, 10], iters=40, seed=SEED).transform(test))


@query("cls11_rbf_svm")
def rbf_svm(spark, folder):
    train, test = _sides(_two_class(_emb(spark, folder)))
    model, expand = ke.rbf_svm(train, "label", "v", gamma=2.0, C=1.0, dim=128, seed=SEED)
    return me.accuracy(model.transform(expand(test.withColumn("_y", F.col("label")))))


def _accuracy_of(model, test):
    return me.accuracy(model.transform(test))


@query("cls12_decision_tree")
def decision_tree(spark, folder):
    train, test = _sides(_ml(_emb(spark, folder)))
    return _accuracy_of(cl.tree(train, "label", "features", 5, SEED), test)


@query("cls13_random_forest")
def random_forest(spark, folder):
    train, test = _sides(_ml(_emb(spark, folder)))
    return _accuracy_of(cl.forest(train, "label", "features", 10, 5, "1", SEED), test)


@query("cls14_adaboost")
def adaboost(spark, folder):
    train, test = _sides(_ml(_emb(spark, folder)))
    return me.accuracy(cl.adaboost_predict(test, cl.adaboost(train, "label", "features", 6, seed=SEED), "features"))


@query("cls14_boosted_trees")
def boosted_trees(spark, folder):
    train, test = _sides(_ml(_two_class(_emb(spark, folder))))
    return _accuracy_of(cl.boosted_trees(train, "label", "features", 5, 3, SEED), test)


@query("cls15_compare_models")
def compare_models(spark, folder):
    def spark_model(fit):
        return lambda train, test: fit(train).transform(test)

    def lda_model(train, test):
        out = cl.discriminate(test, cl.lda(train, "label", "v"), "v")
        return out.withColumn("prediction", F.col("prediction").cast("double"))

    models = {
        "logistic": spark_model(lambda d: cl.logistic(d, "label", "features", iters=50)),
        "tree": spark_model(lambda d: cl.tree(d, "label", "features")),
        "naive bayes": spark_model(lambda d: cl.gaussian_nb(d, "label", "features")),
        "lda": lda_model,
    }
    data = _ml(_emb(spark, folder))
    pairs = {"ten classes": _sides(data), "two classes": _sides(_two_class(data))}
    return cl.compare(models, pairs, me.accuracy)


@query("joi10_predictions_side_by_side")
def predictions_side_by_side(spark, folder):
    train, test = _sides(_ml(_two_class(_emb(spark, folder))))
    models = {
        "logistic": cl.logistic(train, "label", "features", iters=50),
        "tree": cl.tree(train, "label", "features"),
        "bayes": cl.gaussian_nb(train, "label", "features"),
    }
    return jo.predictions(models, test, ["vec_id", "label"])


@query("pip1_chained_estimator")
def chained_estimator(spark, folder):
    train, test = _sides(_ml(_two_class(_emb(spark, folder))))
    chain = se.chain(
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", regParam=0.01),
    )
    return chain.fit(train).transform(test).select("vec_id", "label", "prediction")


# --- model selection -------------------------------------------------------------------------------

_FOLD = f"{q.hash_int('l_orderkey', SEED)} % 5"
_LF = f"lf AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x, {_FOLD} AS fold FROM lineitem)"


def _folded(spark, folder):
    return pr.quick_folds(_priced(spark, folder, spread=True), "l_orderkey", 5, SEED)


@query(
    "eva9_cross_validated_mse",
    f"""WITH {_LF}, w AS (SELECT f, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM lf, range(5) t(f) WHERE fold <> f GROUP BY f)
SELECT CAST(f AS INT) AS fold, round(avg((y - a - b * x) ** 2), 4) AS value FROM lf JOIN w ON fold = f GROUP BY f""",
)
def cross_validated_mse(spark, folder):
    data = _assembled(_folded(spark, folder), "x1")
    scores = se.cv_score(LinearRegression(labelCol="y", solver="normal"), data, "fold", 5, RegressionEvaluator(labelCol="y", metricName="mse"))
    return _rounded(scores, 4)


@query(
    "eva10_ridge_sweep",
    f"""WITH {_LF}, s AS (SELECT f, count(*) * covar_pop(x, y) AS c, count(*) * var_pop(x) AS v, avg(x) AS mx, avg(y) AS my FROM lf, range(5) t(f) WHERE fold <> f GROUP BY f),
a AS (SELECT (10 ** i)::DOUBLE AS alpha FROM range(8) t(i))
SELECT alpha, CAST(f AS INT) AS fold, round(avg((y - my - c / (v + alpha) * (x - mx)) ** 2), 4) AS mse FROM lf JOIN s ON fold = f, a GROUP BY alpha, f""",
)
def ridge_sweep(spark, folder):
    return _rounded(se.ridge_cv_path(_folded(spark, folder), "y", ["x1"], [10.0**i for i in range(8)], "fold"), 4)


@query("eva10_sweep_and_refit")
def sweep_and_refit(spark, folder):
    data = _assembled(_folded(spark, folder), "x1", "x2")

    def make(alpha):
        return LinearRegression(labelCol="y", regParam=alpha, solver="normal")

    model, params, _ = se.sweep(make, {"alpha": [0.0, 1.0, 10.0]}, data, "fold", 5, RegressionEvaluator(labelCol="y", metricName="mse"))
    rows = [("alpha", float(params["alpha"])), ("intercept", float(model.intercept)), *[(f"x{i + 1}", float(w)) for i, w in enumerate(model.coefficients)]]
    return _rounded(spark.createDataFrame(rows, "term string, value double"), 4)


@query("eva11_grid_search")
def grid_search(spark, folder):
    data = _assembled(_folded(spark, folder), "x1", "x2", "x3")

    def make(penalty, mix):
        return LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=mix)

    scores = se.grid_search(make, {"penalty": [0.1, 1.0], "mix": [0.0, 1.0]}, data, "fold", 5, RegressionEvaluator(labelCol="y", metricName="mse"))
    return _rounded(se.grid_summary(scores, ["penalty", "mix"]), 3)


@query(
    "eva12_repeated_holdout",
    f"""WITH lf AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x, l_orderkey FROM lineitem),
m AS (SELECT r, y, x, CAST('0x' || substr(md5(r || ':' || l_orderkey), 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS t FROM lf, range(100) g(r)),
s AS (SELECT r, count(*) * covar_pop(x, y) AS c, count(*) * var_pop(x) AS v, avg(x) AS mx, avg(y) AS my FROM m WHERE NOT t GROUP BY r),
w AS (SELECT *, model, c / (v + alpha) AS b FROM s, (VALUES ('ols', 0.0), ('ridge', 50000.0)) k(model, alpha)),
e AS (SELECT r, model, avg((y - my - b * (x - mx)) ** 2) FILTER (t) AS test_mse, avg((y - my - b * (x - mx)) ** 2) FILTER (NOT t) AS train_mse, var_pop(y) FILTER (t) AS tv, var_pop(y) FILTER (NOT t) AS nv FROM m JOIN w USING (r) GROUP BY ALL)
SELECT CAST(r AS INT) AS repeat, model, round(1 - train_mse / nv, 6) AS train_r2, round(1 - test_mse / tv, 6) AS test_r2, round(test_mse, 4) AS test_mse FROM e""",
)
def repeated_holdout(spark, folder):
    h = se.repeated_holdout(_priced(spark, folder, spread=True), "y", ["x1"], "l_orderkey", 100, 0.2, 50_000.0)
    return h.select("repeat", "model", F.round("train_r2", 6).alias("train_r2"), F.round("test_r2", 6).alias("test_r2"), F.round("test_mse", 4).alias("test_mse"))


@query("eva13_learning_curve")
def learning_curve(spark, folder):
    data = _assembled(_folded(spark, folder), "x1", "x2", "x3")
    out = se.learning_curve(
        LinearRegression(labelCol="y", solver="normal"), data, ["l_orderkey", "l_linenumber", "l_partkey"], [50, 500, 5000], "fold", 5,
        RegressionEvaluator(labelCol="y", metricName="mse"), SEED,
    )
    return _rounded(out, 3)


@query("eva14_degree_curve")
def degree_curve(spark, folder):
    data = _priced(spark, folder).withColumn("x", F.col("x1") / 50)
    train, test = pr.split(data, "l_orderkey", 0.3, SEED)
    return _rounded(se.degree_curve(train, test, "y", "x", list(range(1, 10))), 1)


@query("eva15_training_history")
def training_history(spark, folder):
    model = cl.logistic(_ml(_two_class(_emb(spark, folder))), "label", "features", iters=30)
    return _rounded(se.training_history(model), 5)


# --- clusters --------------------------------------------------------------------------------------


@query("clu1_kmeans")
def kmeans(spark, folder):
    e = _emb(spark, folder)
    centres = cu.centre_matrix(cu.kmeans(e, "v", 10, iters=30, restarts=2, seed=SEED))
    return cu.assign(e, "v", centres).select("vec_id", "cluster", F.round("distance", 5).alias("distance"))


_CENTRES = f"""{q.EMB_LONG}, c AS (SELECT label AS cluster, pos, avg(v) AS m FROM el GROUP BY ALL),
d AS (SELECT vec_id, cluster, sqrt(sum((v - m) ** 2)) AS distance FROM el JOIN c USING (pos) GROUP BY vec_id, cluster),
a AS (SELECT vec_id, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS r FROM d) WHERE r = 1)"""


def _label_centres(e):
    return np.array(list(cu.centres_by(e, "v", "label").values()))


@query("clu2_assign_to_centres", f"WITH {_CENTRES} SELECT vec_id, CAST(cluster AS BIGINT) AS cluster, round(distance, 6) AS distance FROM a")
def assign_to_centres(spark, folder):
    e = _emb(spark, folder)
    return cu.assign(e, "v", _label_centres(e)).select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query("clu2_lloyd_step", f"WITH {_CENTRES} SELECT CAST(a.cluster AS BIGINT) AS cluster, CAST(el.pos AS BIGINT) AS pos, round(avg(el.v), 6) AS value FROM a JOIN el USING (vec_id) GROUP BY ALL")
def lloyd_step(spark, folder):
    e = _emb(spark, folder)
    new = cu.lloyd_step(e, "v", _label_centres(e))
    return new.select("cluster", F.posexplode("centre").alias("pos", "value")).select(
        "cluster", F.col("pos").cast("bigint").alias("pos"), (F.round("value", 6) + 0.0).alias("value")
    )


@query("joi8_mean_distance_to_centres", f"WITH {_CENTRES} SELECT round(avg(distance), 9) AS distortion FROM a")
def mean_distance(spark, folder):
    e = _emb(spark, folder)
    return cu.assign(e, "v", _label_centres(e)).agg(F.round(F.avg("distance"), 9).alias("distortion"))


@query("clu3_elbow")
def elbow(spark, folder):
    return _rounded(cu.elbow(_emb(spark, folder), "v", range(1, 10), iters=20, seed=SEED), 5)


@query("clu4_kmeans_by_silhouette")
def kmeans_by_silhouette(spark, folder):
    _, scores = cu.kmeans_auto(_emb(spark, folder), "v", 2, 8, iters=20, seed=SEED)
    return _rounded(scores, 5)


def _silhouette_sql(power):
    return f"""WITH {q.EMB}, n AS (SELECT label AS other, count(*) AS n FROM e GROUP BY label),
t AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v) ** {power}) AS total FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
m AS (SELECT vec_id, label, other, CASE WHEN label = other THEN total / nullif(n - 1, 0) ELSE total / n END AS mean FROM t JOIN n USING (other)),
s AS (SELECT vec_id, label, max(mean) FILTER (label = other) AS a, min(mean) FILTER (label <> other) AS b FROM m GROUP BY ALL)
SELECT vec_id AS id, label AS cluster, round(coalesce((b - a) / greatest(a, b), 0), 6) AS silhouette FROM s"""


@query("clu5_silhouette", _silhouette_sql(1))
def silhouette(spark, folder):
    return _rounded(cu.silhouette(_emb(spark, folder), "vec_id", "v", "label"))


@query("clu5_silhouette_squared", _silhouette_sql(2))
def silhouette_squared(spark, folder):
    return _rounded(cu.silhouette(_emb(spark, folder), "vec_id", "v", "label", "squared"))


@query(
    "clu7_row_distances",
    f"""WITH {q.EMB} SELECT a.vec_id AS id, count(*) AS others, round(avg(list_distance(a.v, b.v)), 6) AS mean, round(max(list_distance(a.v, b.v)), 6) AS farthest, round(min(list_distance(a.v, b.v)), 6) AS nearest
FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY a.vec_id""",
)
def row_distances(spark, folder):
    return _rounded(cu.distance_profile(_emb(spark, folder), "vec_id", "v"))


@query(
    "clu8_column_distances",
    f"WITH {q.EMB_LONG} SELECT CAST(a.pos AS BIGINT) AS i, CAST(b.pos AS BIGINT) AS j, round(sqrt(sum((a.v - b.v) ** 2)), 6) AS distance FROM el a JOIN el b USING (vec_id) GROUP BY a.pos, b.pos",
)
def column_distances(spark, folder):
    return _rounded(cu.pairwise_cols(_emb(spark, folder), "v"))


@query("clu9_single_linkage")
def single_linkage(spark, folder):
    return lk.single_linkage(_emb(spark, folder), "vec_id", "v", 10)


@query("clu10_complete_linkage")
def complete_linkage(spark, folder):
    labels, _ = lk.agglomerate(_emb(spark, folder), "vec_id", "v", 10, "complete")
    return labels


@query("clu10_average_linkage_merges")
def average_linkage(spark, folder):
    _, merges = lk.agglomerate(_emb(spark, folder), "vec_id", "v", 10, "average")
    return _rounded(merges, 5)


@query("clu11_bicluster")
def bicluster(spark, folder):
    rows, columns = re.bicluster(_emb(spark, folder), "vec_id", "v", 4, rounds=10, seed=SEED)
    return jo.stacked_rows(
        rows.select(F.lit("row").alias("side"), F.col("id").cast("bigint").alias("key"), "cluster"),
        columns.select(F.lit("column").alias("side"), F.col("pos").cast("bigint").alias("key"), "cluster"),
    )


# --- components ------------------------------------------------------------------------------------


@query(
    "dim1_two_column_components",
    """WITH m AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS d, covar_samp(l_quantity, l_discount * 100) AS b FROM lineitem),
l AS (SELECT (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) AS l1, (a + d) / 2 - sqrt(((a - d) / 2) ** 2 + b * b) AS l2 FROM m)
SELECT 1 AS component, round(l1, 6) AS variance, round(l1 / (l1 + l2), 6) AS ratio, round(l1 / (l1 + l2), 6) AS cumulative FROM l
UNION ALL SELECT 2, round(l2, 6), round(l2 / (l1 + l2), 6), 1.0 FROM l""",
)
def two_column_components(spark, folder):
    m = mo.column_moments(_priced(spark, folder), ["x1", "x2"])
    return _rounded(re.components_from(m, None, None, False).table(spark))


@query("dim1_total_variance", f"WITH {q.EMB_LONG}, p AS (SELECT pos, var_samp(v) AS s FROM el GROUP BY pos) SELECT round(sum(s), 6) AS total FROM p")
def total_variance(spark, folder):
    fit = re.pca(_emb(spark, folder), "v")
    return fit.table(spark).agg(F.round(F.sum("variance"), 6).alias("total"))


@query("dim1_component_scores")
def component_scores(spark, folder):
    e = _emb(spark, folder)
    s = re.pca_scores(e, re.pca(e, "v", 3), "v")
    return s.select("vec_id", *[F.round(F.col("scores")[i], 5).alias(f"pc{i + 1}") for i in range(3)])


@query("dim2_components_for_share")
def components_for_share(spark, folder):
    fit = re.pca(_emb(spark, folder), "v", variance=0.9, normalize=True)
    return _rounded(fit.table(spark).filter(F.col("component") <= fit.kept), 5)


@query("dim3_components_of_two_sets")
def components_of_two_sets(spark, folder):
    low, high = _sides(_emb(spark, folder))
    both = jo.stacked_rows(low.withColumn("part", F.lit("train")), high.withColumn("part", F.lit("test")))
    s = re.pca_scores(both, re.pca(both, "v", 2), "v")
    return s.groupBy("part").agg(*[F.round(F.avg(F.col("scores")[i]), 5).alias(f"pc{i + 1}") for i in range(2)], F.count("*").alias("n"))


# --- user-defined functions ------------------------------------------------------------------------


@query("udf1_function_per_record", "SELECT item_id, CAST(length(text) - length(replace(text, 'e', '')) AS BIGINT) AS n_e FROM benchmark")
def function_per_record(spark, folder):
    @F.arrow_udf("bigint")
    def count_e(t: pa.Array) -> pa.Array:
        return pc.count_substring(t, "e").cast(pa.int64())

    return _bench_items(spark, folder).select("item_id", count_e("text").alias("n_e"))


@query("udf3_fold", "SELECT event_type, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY event_type")
def fold(spark, folder):
    """A user fold with zero, per-row step and combine: partial results per task, then one sum."""
    def partial(frames):
        zero = None
        for f in frames:
            step = f.groupby("event_type")["value"].agg(total="sum", n="count")
            zero = step if zero is None else zero.add(step, fill_value=0)
        if zero is not None and len(zero):  # a task without rows has no partial result
            yield zero.rename_axis("event_type").reset_index().astype({"n": "int64"})

    parts = _t(spark, folder, "events").select("event_type", "value").mapInPandas(partial, "event_type string, total double, n bigint")
    return parts.groupBy("event_type").agg(F.round(F.sum("total"), 2).alias("total"), F.sum("n").alias("n"))


@query("udf4_table_transform", "SELECT event_id, round(value * 2 + 1, 6) AS scaled FROM events WHERE value > 0")
def table_transform(spark, folder):
    def script(frames):
        for f in frames:
            f = f[f["value"] > 0]
            yield f[["event_id"]].assign(scaled=f["value"] * 2 + 1)

    out = _t(spark, folder, "events").select("event_id", "value").mapInPandas(script, "event_id bigint, scaled double")
    return out.withColumn("scaled", F.round("scaled", 6))


@query("udf5_closure_value", "SELECT c_custkey, round(c_acctbal * 1.25, 4) AS raised FROM customer")
def closure_value(spark, folder):
    factor = 1.25  # captured when the job is built

    @F.pandas_udf("double")
    def raise_by(b: pd.Series) -> pd.Series:
        return b * factor

    return _t(spark, folder, "customer").select("c_custkey", F.round(raise_by("c_acctbal"), 4).alias("raised"))


@query("udf6_user_estimator")
def user_estimator(spark, folder):
    part = _t(spark, folder, "part").select("p_partkey", (F.col("p_retailprice") / 1000).alias("label"), (F.col("p_size") / 10.0).alias("x"))
    data = _assembled(part, "x")
    model = DescentRegressor(maxIter=200, stepSize=0.05).fit(data)
    return model.transform(data).select("p_partkey", F.round("prediction", 5).alias("prediction"))
