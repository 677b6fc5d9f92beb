import numpy as np
import pandas as pd
import pytest
from lodestat.operators import classify as cl
from lodestat.operators import clustering as cu
from lodestat.operators import kernel as ke
from lodestat.operators import linear as li
from lodestat.operators import linkage as lk
from lodestat.operators import metrics as me
from lodestat.operators import moments as mo
from lodestat.operators import neighbours as nn
from lodestat.operators import prep as pr
from lodestat.operators import reduction as re
from lodestat.operators import selection as se
from lodestat.operators.estimators import DescentRegressor
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

XS = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def wide(vectors):
    df = vectors[0]
    return df.select("id", "label", "y", "v", *[F.col("v")[i].alias(x) for i, x in enumerate(XS)]).cache()


def ridge_closed(x, y, a):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + a * np.eye(x.shape[1]), xc.T @ yc)


def test_gram_and_moments(vectors):
    df, x, labels, _ = vectors
    g = mo.gram_matrices(df, "v")[""]
    assert np.allclose(g, x.T @ x)
    by = mo.vector_moments_by(df, "v", "label")
    for k in range(3):
        assert np.allclose(by[str(k)].cov, np.cov(x[labels == k].T, bias=True))
    again = mo.gram_matrices(df.repartition(9), "v", "label")
    assert np.allclose(sum(again.values()), g)


@pytest.mark.parametrize("alpha", [0.0, 3.0])
def test_ridge_matches_closed_form(wide, vectors, alpha):
    _, x, _, y = vectors
    fit = li.ridge(wide, "y", XS, alpha)
    assert np.allclose(fit.weights, ridge_closed(x, y, alpha))
    assert fit.intercept == pytest.approx(y.mean() - x.mean(0) @ fit.weights)


def test_ridge_on_unit_columns(wide, vectors):
    _, x, _, y = vectors
    lengths = np.linalg.norm(x - x.mean(0), axis=0)
    want = ridge_closed((x - x.mean(0)) / lengths, y, 0.7) / lengths
    assert np.allclose(li.ridge(wide, "y", XS, 0.7, normalize=True).weights, want)


def lasso_cd(x, y, a):
    xc, yc = x - x.mean(0), y - y.mean()
    w, n = np.zeros(x.shape[1]), len(y)
    for _ in range(3000):
        for j in range(x.shape[1]):
            r = yc - xc @ w + xc[:, j] * w[j]
            c = xc[:, j] @ r / n
            w[j] = np.sign(c) * max(abs(c) - a, 0) / (xc[:, j] @ xc[:, j] / n)
    return w


def test_lasso_matches_coordinate_descent(wide, vectors):
    _, x, _, y = vectors
    assert np.allclose(li.lasso(wide, "y", XS, 0.1).weights, lasso_cd(x, y, 0.1), atol=1e-5)


def test_leave_one_out_scores(wide, vectors):
    _, x, _, y = vectors
    _, scores = li.ridge_cv(wide, "y", XS, [0.1, 10.0])
    for r in scores.collect():
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            # the penalty is kept; the row alone is left out
            w = ridge_closed(x[keep], y[keep], r.alpha)
            errors.append((y[i] - y[keep].mean() - (x[i] - x[keep].mean(0)) @ w) ** 2)
        assert r.loo_mse == pytest.approx(np.mean(errors), rel=1e-6)


def test_vector_regression(vectors):
    df, x, _, _ = vectors
    halves = df.withColumn("a", F.slice("v", 1, 3)).withColumn("b", F.slice("v", 4, 3))
    fit = li.multi_ridge(halves, "a", "b", 2.0)
    assert np.allclose(fit.weights, np.column_stack([ridge_closed(x[:, :3], x[:, 3 + j], 2.0) for j in range(3)]))
    p = {r.id: r.prediction for r in li.predict_vector(halves, fit, "a").collect()}
    assert np.allclose([p[i] for i in range(120)], x[:, :3] @ fit.weights + fit.intercept)


def test_descent_falls_and_reaches_least_squares(wide, vectors):
    _, _, _, y = vectors
    d = li.gd_linear(wide, "y", XS[:2], 0.01, 20_000)
    losses = [h[1] for h in d.history]
    assert losses[0] == pytest.approx((y * y).mean() / 2)
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    best = li.ols(wide, "y", XS[:2])
    assert np.allclose(d.theta, [best.intercept, *best.weights], atol=1e-4)


def test_user_estimator(wide, tmp_path):
    data = wide.withColumn("features", array_to_vector(F.array("x0", "x1"))).withColumnRenamed("label", "g").withColumnRenamed("y", "label")
    model = DescentRegressor(maxIter=20_000, stepSize=0.01).fit(data)
    best = li.ols(data, "label", ["x0", "x1"])
    assert np.allclose(model.getOrDefault("theta"), [best.intercept, *best.weights], atol=1e-3)
    assert "prediction" in model.transform(data).columns


def test_rbf_models_fit_a_curve(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-2, 2, 100)
    y = np.sin(2 * x) + rng.normal(0, 0.05, 100)
    df = spark.createDataFrame([(i, [float(a)], float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, v array<double>, y double")
    kernel = np.exp(-1.0 * (x[:, None] - x[None, :]) ** 2)
    exact = kernel @ np.linalg.solve(kernel + 0.1 * np.eye(100), y)
    fit = ke.rbf_ridge(df, "y", "v", gamma=1.0, alpha=0.1, dim=512)
    got = {r.id: r.prediction for r in ke.predict(df, fit, "v").collect()}
    assert np.abs(np.array([got[i] for i in range(100)]) - exact).max() < 0.15
    svr = ke.predict(df, ke.rbf_svr(df, "y", "v", gamma=1.0, C=10.0, eps=0.1, dim=64, steps=60), "v")
    assert me.r2(svr, "y").first().r2 > 0.8
    assert 0 < me.support_ratio(svr, 0.1, "y").first().support_ratio < 1


def log_scores(x, mean, cov, prior):
    d = x - mean
    return np.log(prior) - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def test_discriminants(vectors):
    df, x, labels, _ = vectors
    n = len(x)
    groups = [x[labels == k] for k in range(3)]
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / (n - 3)
    want = np.column_stack([log_scores(x, g.mean(0), pooled, len(g) / n) for g in groups]).argmax(1)
    model = cl.lda(df, "label", "v")
    got = {r.id: int(r.prediction) for r in cl.discriminate(df, model, "v").collect()}
    assert [got[i] for i in range(n)] == want.tolist()
    axes = {r.id: r.c for r in cl.lda_transform(df, model, "v", 2, "c").collect()}
    z = np.array([axes[i] for i in range(n)])
    within = sum(np.cov(z[labels == k].T, bias=True) * (labels == k).sum() for k in range(3)) / (n - 3)
    assert np.allclose(within, np.eye(2), atol=1e-8)
    full = np.column_stack(
        [log_scores(x, g.mean(0), np.cov(g.T), len(g) / n) - 0.5 * np.linalg.slogdet(np.cov(g.T))[1] for g in groups]
    )
    q = {r.id: int(r.prediction) for r in cl.discriminate(df, cl.qda(df, "label", "v"), "v").collect()}
    assert [q[i] for i in range(n)] == full.argmax(1).tolist()


def two_class(df):
    return df.withColumn("features", array_to_vector("v")).withColumn("label", (F.col("label") == 1).cast("double"))


def test_logistic_is_stationary_and_l1_is_sparser(vectors):
    df, x, labels, _ = vectors
    data, y = two_class(df).cache(), (labels == 1).astype(float)
    model = cl.logistic(data, "label", "features", C=0.05)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # gradient of |w|^2 / 2 + C * loss
    assert np.abs(w + 0.05 * x.T @ (p - y)).max() < 1e-4
    names = [f"v{i}" for i in range(6)]
    zero = {
        pen: cl.sparsity(cl.coefficient_table(cl.logistic(data, "label", "features", 0.02, pen), names)).first().zero_percent
        for pen in ("l1", "l2")
    }
    assert zero["l1"] > zero["l2"] == 0


def test_boosting_and_rbf_svm_learn(vectors):
    data = vectors[0].withColumn("features", array_to_vector("v")).withColumn("label", F.col("label").cast("double")).cache()
    b = cl.adaboost(data, "label", "features", 6)
    assert me.accuracy(cl.adaboost_predict(data, b, "features")).first().accuracy > 0.8
    model, expand = ke.rbf_svm(two_class(vectors[0]).drop("features"), "label", "v", gamma=0.05, C=10.0, dim=64)
    assert me.accuracy(model.transform(expand(two_class(vectors[0]).drop("features").withColumn("_y", F.col("label"))))).first().accuracy > 0.9


def brute_knn(x, labels, test, train, k):
    out = {}
    for i in test:
        d = np.round(((x[train] - x[i]) ** 2).sum(1), 9)
        out[i] = [int(t) for t in np.array(train)[np.lexsort((train, d))[:k]]]
    return out


@pytest.mark.parametrize("blocks", [False, True])
def test_dense_neighbours_both_ways(vectors, monkeypatch, blocks):
    df, x, labels, _ = vectors
    if blocks:
        monkeypatch.setattr(nn, "TEST_BLOCK", 7)
        monkeypatch.setattr(nn, "TRAIN_BLOCK", 20)
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    near = nn.dense_knn(train, test, 5).toPandas().sort_values(["test_id", "rank"])
    want = brute_knn(x, labels, range(0, 120, 4), [i for i in range(120) if i % 4], 5)
    assert {int(t): g["id"].tolist() for t, g in near.groupby("test_id")} == want


def test_hashed_neighbours_recall(vectors):
    df, x, labels, _ = vectors
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    exact = nn.dense_knn(train, test, 3).select("test_id", "id").toPandas()
    found = nn.knn_lsh(train, test, 3, radius=20.0, bucket=6.0, tables=6).select("test_id", "id").toPandas()
    hit = pd.merge(exact, found, on=["test_id", "id"])
    assert len(hit) / len(exact) > 0.7


def test_silhouette_forms(vectors):
    df, x, labels, _ = vectors
    for metric, power in (("euclidean", 1), ("squared", 2)):
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** power
        want = []
        for i in range(len(x)):
            means = [d[i][(labels == k) & (np.arange(len(x)) != i)].mean() for k in range(3)]
            a, b = means[labels[i]], min(m for k, m in enumerate(means) if k != labels[i])
            want.append((b - a) / max(a, b))
        got = {r.id: r.silhouette for r in cu.silhouette(df, "id", "v", "label", metric).collect()}
        assert np.allclose([got[i] for i in range(len(x))], want)


def test_block_distances_with_many_blocks(vectors, monkeypatch):
    df, x, _, _ = vectors
    monkeypatch.setattr(cu, "BLOCK", 25)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    cells = {(r.id, o): v for r in cu.pairwise(df).collect() for o, v in zip(r.ids, r.distances)}
    assert len(cells) == 120 * 120
    assert all(cells[i, j] == pytest.approx(d[i, j], abs=1e-6) for i in range(120) for j in range(120))
    got = {r.id: r.nearest for r in cu.distance_profile(df).collect()}
    assert np.allclose([got[i] for i in range(120)], (d + np.eye(120) * 1e9).min(1))


def single_brute(x, n):
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 7)
    edges = sorted((d[i, j], i, j) for i in range(len(x)) for j in range(i + 1, len(x)))
    comp = list(range(len(x)))
    left = len(x)
    for _, i, j in edges:
        if left == n:
            break
        a, b = comp[i], comp[j]
        if a != b:
            comp = [min(a, b) if c in (a, b) else c for c in comp]
            left -= 1
    return comp


@pytest.mark.parametrize("small,block", [(200_000, 4096), (4, 30)])
def test_single_linkage_both_ways(vectors, monkeypatch, small, block):
    df, x, _, _ = vectors
    df, x = df.filter("id < 60"), x[:60]
    monkeypatch.setattr(cu, "BLOCK", block)
    got = {r.id: r.cluster for r in lk.single_linkage(df, "id", "v", 5, small=small).collect()}
    assert [got[i] for i in range(60)] == single_brute(x, 5)


def test_single_linkage_with_equal_rows(spark):
    rows = [(i, [float(i // 4), 0.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = {r.id: r.cluster for r in lk.single_linkage(df, "id", "v", 3).collect()}
    assert [got[i] for i in range(12)] == [0] * 4 + [4] * 4 + [8] * 4


@pytest.mark.parametrize("linkage", ["complete", "average"])
def test_agglomerate_is_exact(vectors, linkage, monkeypatch):
    df, x, _, _ = vectors
    df, x = df.filter("id < 40"), x[:40]
    labels, merges = lk.agglomerate(df, "id", "v", 4, linkage)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    groups, heights = [[i] for i in range(40)], []
    join = np.max if linkage == "complete" else np.mean
    while len(groups) > 1:
        h, a, b = min((join(d[np.ix_(p, q)]), i, j) for i, p in enumerate(groups) for j, q in enumerate(groups) if i < j)
        heights.append(h)
        if len(groups) == 4:
            four = [set(g) for g in groups]
        groups[a] = groups[a] + groups.pop(b)
    if len(heights) and len(four) == 4:
        got = labels.toPandas().groupby("cluster")["id"].apply(lambda s: frozenset(int(i) for i in s))
        assert set(got) == {frozenset(g) for g in four}
    assert np.allclose([r.height for r in merges.orderBy("step").collect()], heights, atol=1e-6)
    parts = lambda found: {frozenset(g["id"]) for _, g in found.toPandas().groupby("cluster")}
    tree = lambda found: [(r.step, r.a, r.b, round(r.height, 6), r.size) for r in found.orderBy("step").collect()]
    for block, large in ((4096, 1024), (16, 3)):  # rounds in one block; several blocks, larger clusters spread over them
        monkeypatch.setattr(lk, "BLOCK", block)
        monkeypatch.setattr(lk, "LARGE", large)
        few, again = lk.agglomerate(df, "id", "v", 4, linkage, items=6)
        assert parts(few) == parts(labels) and tree(again) == tree(merges)


def test_agglomerate_beyond_the_matrix(spark):
    x = np.random.default_rng(4).random((1_100, 3))
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "id int, v array<double>")
    labels, merges = lk.agglomerate(df, "id", "v", 7, "complete")
    assert merges.count() == 1_099 and labels.count() == 1_100 and labels.select("cluster").distinct().count() == 7
    assert merges.agg({"size": "max"}).first()[0] == 1_100


def test_agglomerate_repeated_rows(spark):
    rows = [(0, [0.0]), (1, [0.0]), (2, [1.0]), (3, None)]
    labels, merges = lk.agglomerate(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", 1, "average")
    assert {tuple(r) for r in labels.collect()} == {(0, 0), (1, 0), (2, 0)}
    assert [tuple(r) for r in merges.collect()] == [(0, 0, 1, 1.0, 3.0)]


@pytest.mark.parametrize("width", [1, 8, 9, 33])
def test_moments_far_from_zero(spark, width):
    values = np.array([i / 999 for i in range(1_000)])
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame([tuple([1e9 + float(v)] * width) for v in values], ", ".join(f"{c} double" for c in names))
    m = mo.column_moments(df, names)
    assert np.allclose(m.cov, values.var(), atol=1e-6) and np.allclose(m.mean, 1e9 + values.mean())
    parts = mo.column_moments_by(df.withColumn("g", (F.col("c0") > 1e9 + 0.3).cast("int")), names, "g")
    whole = se._merge(list(parts.values()))
    assert np.allclose(whole.cov, values.var(), atol=1e-6)
    assert np.allclose(se._minus(whole, [parts["0"]]).cov, parts["1"].cov, atol=1e-6)


def test_components(vectors):
    df, x, _, _ = vectors
    fit = re.pca(df, "v", 2)
    values, axes = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(fit.variances, values[::-1])
    assert np.allclose(np.abs(fit.axes.T @ axes[:, ::-1][:, :2]), np.eye(2), atol=1e-8)
    scores = {r.id: r.scores for r in re.pca_scores(df, fit, "v").collect()}
    assert np.allclose(np.mean(list(scores.values()), axis=0), 0)
    shares = np.cumsum(fit.variances) / fit.variances.sum()
    for share in (0.5, 0.9, 0.99):
        assert re.pca(df, "v", variance=share).kept == int(np.argmax(shares >= share)) + 1


def test_bicluster_finds_blocks(spark):
    rng = np.random.default_rng(0)
    a = np.full((40, 8), 1.0) + rng.random((40, 8)) * 0.1
    a[:20, :4] += 5
    a[20:, 4:] += 5
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(a)], "id int, v array<double>")
    rows, columns = re.bicluster(df, "id", "v", 2, rounds=20)
    r = {x.id: x.cluster for x in rows.collect()}
    c = {x.pos: x.cluster for x in columns.collect()}
    assert len({r[i] for i in range(20)}) == 1 == len({r[i] for i in range(20, 40)}) and r[0] != r[39]
    assert len({c[i] for i in range(4)}) == 1 == len({c[i] for i in range(4, 8)}) and c[0] != c[7]


def test_kmeans_elbow_falls(vectors):
    scores = [r.distortion for r in cu.elbow(vectors[0], "v", [1, 2, 3]).orderBy("k").collect()]
    x = vectors[1]
    assert scores[0] == pytest.approx(np.linalg.norm(x - x.mean(0), axis=1).mean())
    assert scores[0] > scores[1] > scores[2]
    model, _ = cu.kmeans_auto(vectors[0], "v", 2, 4)
    assert model.summary.k == 3


def test_fold_path_matches_refits(wide, vectors):
    _, x, _, y = vectors
    data = wide.withColumn("fold", (F.col("id") % 4).cast("int"))
    for r in se.ridge_cv_path(data, "y", XS, [0.5, 5.0], "fold").collect():
        out = np.arange(120) % 4 == r.fold
        w = ridge_closed(x[~out], y[~out], r.alpha)
        e = y[out] - y[~out].mean() - (x[out] - x[~out].mean(0)) @ w
        assert r.mse == pytest.approx((e * e).mean())


def test_sweep_picks_the_best_cell(wide):
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=XS, outputCol="features").transform(pr.quick_folds(wide, "id", 3, 1))
    evaluator = RegressionEvaluator(labelCol="y", metricName="mse")
    model, params, scores = se.sweep(lambda p: LinearRegression(labelCol="y", regParam=p), {"p": [0.0, 100.0]}, data, "fold", 3, evaluator)
    assert params == {"p": 0.0} and scores.count() == 6
    summary = {r.p: r for r in se.grid_summary(scores, ["p"]).collect()}
    assert summary[0.0].stderr == pytest.approx(summary[0.0].std / np.sqrt(3))
    curve = se.learning_curve(LinearRegression(labelCol="y"), data, ["id"], [20, 60], "fold", 2, evaluator)
    assert curve.count() == 4


def test_degree_curve_never_gets_worse_in_training(wide):
    train, test = pr.split(wide.withColumn("x", F.col("x0") / 4), "id", 0.3, 1)
    errors = [r.train_error for r in se.degree_curve(train, test, "y", "x", [1, 2, 3]).orderBy("degree").collect()]
    assert errors == sorted(errors, reverse=True)
