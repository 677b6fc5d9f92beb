"""Cases of the third round's findings; each test builds its own rows."""


def test_fold_with_tasks_without_rows(spark, tmp_path):
    from lodestat.plans import load_all
    from lodestat.plans.registry import QUERIES

    load_all()
    schema = "event_id bigint, event_type string, value double"
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "a", 0.5)], schema).coalesce(1).write.parquet(path)
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    got = {r.event_type: (r.total, r.n) for r in QUERIES["udf3_fold"](spark, str(tmp_path)).collect()}
    assert got == {"a": (1.5, 2), "b": (2.0, 1)}


def test_lasso_working_set_follows_the_solution(spark, monkeypatch):
    """A penalty far below the largest gradient leaves no column out by the strong rule; few of them have a weight."""
    import numpy as np

    from lodestat.operators import sparse_lasso as sl

    rng = np.random.default_rng(5)
    n, p = 150, 400
    X = (rng.random((n, p)) < 0.05) * rng.integers(1, 4, (n, p)).astype(float)
    X[:, :2] = rng.integers(1, 40, (n, 2))
    y = X[:, 0] * 3 - X[:, 1] * 2 + X[:, 5] + rng.normal(0, 0.1, n)
    cells = spark.createDataFrame([(i, j, float(X[i, j])) for i in range(n) for j in range(p) if X[i, j]], "doc_id long, pos long, cnt double")
    targets = spark.createDataFrame([(i, float(y[i])) for i in range(n)], "doc_id long, y double")
    xc, yc, alpha = X - X.mean(0), y - y.mean(), 0.05
    corr, var = xc.T @ yc, (xc**2).sum(0)
    assert len(sl._first_working(corr, var, n, alpha, np.abs(corr).max() / n)) == int((var > 1e-12).sum())
    monkeypatch.setattr(sl, "GROW", 20)
    fit = sl.fit(cells, targets, alpha)
    w = np.zeros(p)
    for c, v in fit.weights.items():
        w[c] = v
    g = xc.T @ (yc - xc @ w) / n
    assert np.abs(g).max() <= alpha * (1 + 1e-6) and np.allclose(g[w != 0], alpha * np.sign(w[w != 0]), atol=1e-8)
    assert 0 < len(fit.weights) <= fit.working < p // 2


def test_hashed_neighbours_match_the_bucket_join(spark, monkeypatch):
    """Same pairs as Spark's own join by buckets, however the buckets are cut into blocks, and no vector in its output."""
    import numpy as np
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from lodestat.operators import neighbours as nn
    from lodestat.operators.windows import top_k_per

    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (160, 6))
    x[100:110] = x[90]
    rows = [(i, i % 3, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, label int, v array<double>")
    train, test = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    side = lambda d: d.select("id", "label", array_to_vector("v").alias("f"))
    model = BucketedRandomProjectionLSH(inputCol="f", outputCol="h", bucketLength=0.5, numHashTables=4, seed=7).fit(side(train))
    pairs = model.approxSimilarityJoin(side(test), side(train), 3.0, distCol="distance").select(
        F.col("datasetA.id").alias("test_id"), F.col("datasetB.id").alias("id"), F.col("datasetB.label").alias("label"), "distance"
    )
    want = sorted(map(tuple, top_k_per(pairs, "test_id", [F.col("distance"), F.col("id")], 3).collect()))
    for block in (nn.LSH_BLOCK, 20):
        monkeypatch.setattr(nn, "LSH_BLOCK", block)
        found = nn.knn_lsh(train, test, 3, radius=3.0)
        assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and len(want) > 40


def test_block_copies_grow_as_the_rows():
    from lodestat.operators import clustering as cu

    assert [cu._grid(n) for n in (0, 1, 4_096, 4_097, 60_000)] == [1, 1, 1, 2, 6]
    assert cu._grid(102_560) == cu._grid(390_000) == cu.GRID  # more rows, as many copies of a row
    assert cu._grid(615_360) == 10


def test_tiles_give_the_same_distances(vectors, monkeypatch):
    import numpy as np

    from lodestat.operators import clustering as cu
    from lodestat.operators import linkage as lk

    df, x, labels, _ = vectors
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    other = ~np.eye(len(x), dtype=bool)
    monkeypatch.setattr(cu, "TILE", 17)
    for r in cu.distance_profile(df, "id", "v").collect():
        mine = d[r.id][other[r.id]]
        assert r.others == len(mine) and np.allclose([r.mean, r.farthest, r.nearest], [mine.mean(), mine.max(), mine.min()])
    tiny = {r.id: r.silhouette for r in cu.silhouette(df, "id", "v", "label").collect()}
    edges = sorted((round(r.d, 6), r.lo, r.hi) for r in lk.spanning_tree(df, "id", "v").collect())
    monkeypatch.setattr(cu, "TILE", 1_024)
    whole = {r.id: r.silhouette for r in cu.silhouette(df, "id", "v", "label").collect()}
    assert np.allclose([tiny[i] for i in range(120)], [whole[i] for i in range(120)])
    assert edges == sorted((round(r.d, 6), r.lo, r.hi) for r in lk.spanning_tree(df, "id", "v").collect()) and len(edges) == 119


def test_similarity_keeps_no_sums_for_all_pairs(spark, monkeypatch):
    """The all-pairs table equals the plain join and sum, and no aggregate is keyed by (query, document)."""
    from lodestat.operators import neighbours as nn

    asked = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 1.0), (None, 2, 3.0), ("c", 9, 1.0)], "q string, pos bigint, weight double")
    rows = [(d, p, float((d * 7 + p * 3) % 5)) for d in range(700) for p in range(4) if (d + p) % 3]
    corpus = spark.createDataFrame(rows, "doc bigint, pos bigint, weight double")
    for metric in ("dot", "cosine"):
        found = nn.similarity(asked, corpus, "q", "doc", metric=metric)
        got = sorted(map(str, map(tuple, found.collect())))
        assert "keys=[q" not in found._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(nn, "QUERY_CELLS", 0)  # the join by positions
        assert got == sorted(map(str, map(tuple, nn.similarity(asked, corpus, "q", "doc", metric=metric).collect())))
        monkeypatch.undo()


def test_svr_keeps_the_given_vectors(spark, monkeypatch):
    """What a step reads is the vector, not the features made from it, and the gradient is the same."""
    import numpy as np

    from lodestat.operators import kernel as ke

    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, (50, 2)), rng.normal(0, 1, 50)
    df = spark.createDataFrame([([float(c) for c in v], float(t)) for v, t in zip(x, y)], "v array<double>, y double").coalesce(2)
    seen, inner = [], ke._tube_gradient

    def watched(rows, w, *rest):
        g = inner(rows, w, *rest)
        seen.append((rows.columns, rows.first()[1], w, rest, g))
        return g

    monkeypatch.setattr(ke, "_tube_gradient", watched)
    ke.rbf_svr(df, "y", "v", gamma=1.0, dim=16, steps=2, seed=3)
    _, first, w, rest, g = seen[1]
    z, t = ke._features(x, 1.0, 16, 3), (y - y.mean()) / y.std()
    e = t - z @ w - rest[0]
    side = np.sign(e) * (np.abs(e) > rest[1])
    assert len(first) == 2 and np.allclose(g, [*(side @ z), side.sum()])


def test_size_guesses_stay_bounded_over_merge_rounds(vectors, monkeypatch):
    """Spark's guess of the rows' size, a product of the guesses of the round before, has no more digits round after round."""
    from lodestat.operators import linkage as lk

    digits, inner = [], lk._merge_round

    def watched(rows, linkage, level):
        digits.append(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length())
        return inner(rows, linkage, level)

    monkeypatch.setattr(lk, "_merge_round", watched)
    df = vectors[0].filter("id < 40")
    _, merges = lk.agglomerate(df, "id", "v", 4, "complete", items=12)
    assert merges.count() == 39 and len(digits) >= 3 and max(digits) <= 40
