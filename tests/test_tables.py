import numpy as np
import pytest
from lodestat.functions import arrays as ar
from lodestat.functions import hashing as hs
from lodestat.operators import aggregates as ag
from lodestat.operators import joins as jo
from lodestat.operators import metrics as me
from lodestat.operators import prep as pr
from lodestat.operators import rows as ro
from lodestat.operators import windows as wi
from lodestat.roles import Roles
from lodestat.sources import readers as rd
from lodestat.sources import sinks as sk
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import functions as F


def test_lines_from_file_and_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("three\n")
    assert rd.read_lines(spark, str(tmp_path / "a.txt")).count() == 2
    lines = rd.read_lines(spark, str(tmp_path), with_file=True)
    assert lines.count() == 3 and lines.select("file").distinct().count() == 2
    assert rd.list_files(spark, str(tmp_path), "*.txt").count() == 2


def test_delimited_files_with_roles_quotes_and_bom(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('﻿key,name,x\n1,"a, ""b""",2.5\n2,c,\n'.encode())
    df = rd.read_table(spark, str(tmp_path / "t.csv"), "key int, name string, x double")
    assert [tuple(r) for r in df.orderBy("key").collect()] == [(1, 'a, "b"', 2.5), (2, "c", None)]
    (tmp_path / "t.tsv").write_text("key\tx\n1\t2.0\n")
    assert rd.read_table(spark, str(tmp_path / "t.tsv"), "key int, x double", sep="\t").first().x == 2.0
    table = rd.read_role_table(spark, str(tmp_path / "t.csv"), "key int, name string, x double", Roles(("x",), None, ("key",)))
    assert table.df.columns == ["key", "x"]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 3.5)], "id int, x double")
    sk.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True, schema="id int, x double").exceptAll(df).isEmpty()
    sk.write_table(df, str(tmp_path / "p"), ("id",))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    model = LinearRegression(featuresCol="f", labelCol="x", regParam=0.1).fit(ro.with_roles(df, Roles(("id",), "x"), "f"))
    sk.save_model(model, str(tmp_path / "m"))
    assert LinearRegressionModel.load(str(tmp_path / "m")).coefficients == model.coefficients


def test_row_id_with_one_value_on_most_rows(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("k"))
    placed = ro.with_row_id(df, ["k", "id"]).toPandas().sort_values("row_id")
    want = df.toPandas().sort_values(["k", "id"])
    assert (placed["row_id"].to_numpy() == np.arange(5000)).all()
    assert (placed["id"].to_numpy() == want["id"].to_numpy()).all()
    ranked = ro.rank_within(df, "k", ["id"]).toPandas()
    for _, g in ranked.groupby("k"):
        g = g.sort_values("id")
        assert (g["rank"].to_numpy() == np.arange(len(g))).all()


@pytest.mark.parametrize("start,stop,step", [(2, 9, 1), (0, None, 2), (-3, None, 1), (1, -2, 3)])
def test_slices_follow_python(spark, start, stop, step):
    df = spark.range(20).select((19 - F.col("id")).alias("x"))
    got = sorted(r.x for r in ro.slice_rows(df, ["x"], start, stop, step).collect())
    assert got == list(range(20))[start:stop:step]


def test_splits_are_complete_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = pr.split(df, "k", 0.2, 1)
    assert train.count() + test.count() == 2000 and abs(test.count() - 400) < 80
    again = pr.split(df.repartition(7), "k", 0.2, 1)[1]
    assert test.exceptAll(again).isEmpty()
    taken, rest = pr.sample(df, "k", 0.25, 3)
    assert (taken.count(), rest.count()) == (500, 1500)
    unit = df.filter(hs.hash_unit("k", 1) < 0.2)
    assert unit.exceptAll(test).isEmpty() and test.exceptAll(unit).isEmpty()


@pytest.mark.parametrize("n,parts", [(10, 3), (9, 3), (2, 5)])
def test_fold_sizes_differ_by_at_most_one(spark, n, parts):
    df = spark.range(n).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in pr.folds(df, "k", parts, 1).groupBy("fold").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    runs = {r.k: r.fold for r in pr.folds(df, "k", parts, shuffle=False).collect()}
    want = {}
    for f, part in enumerate(np.array_split(np.arange(n), parts)):
        want |= {int(k): f for k in part}
    assert runs == want


def test_impute_one_hot_and_standardize(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 4.0, None), (4, 1.0, "b")], "id int, x double, c string")
    full = {r.id: (r.x, r.c) for r in pr.impute(df, ["x"], ["c"]).collect()}
    assert full[2] == (2.0, "b") and full[3] == (4.0, "b")
    assert pr.impute(df, ["x"], ["c"], "drop").count() == 2
    assert pr.one_hot(df, ["c"]).columns[-2:] == ["c=a", "c=b"]
    assert pr.one_hot(df, ["c"], drop_first=True).columns[-1:] == ["c=b"]
    z = [r.x for r in pr.standardize(df.dropna(), ["x"]).collect()]
    assert z == [0.0, 0.0]


def test_poly_terms_and_grid(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    assert pr.poly(df, ["a", "b"], 2, bias=True).first().asDict() == {
        "a": 2.0, "b": 3.0, "a*a": 4.0, "a*b": 6.0, "b*b": 9.0, "bias": 1.0
    }
    g = pr.score_grid(df.unionByName(spark.createDataFrame([(3.0, 4.0)], df.schema)), "a", "b", 0.5, 0.5)
    assert g.count() == len(np.arange(1.5, 3.5, 0.5)) * len(np.arange(2.5, 4.5, 0.5))


def test_sparse_rows(spark):
    cells = spark.createDataFrame([(0, 2, 1.5), (0, 2, 0.5), (1, 0, 3.0)], "i int, j int, v double")
    rows = {r.i: r.vector.toArray().tolist() for r in pr.rows_from_coo(cells, "i", "j", "v", 3).collect()}
    assert rows == {0: [0, 0, 2.0], 1: [3.0, 0, 0]}


def test_array_functions(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0],)], "v array<double>")
    r = df.select(
        ar.argmax(F.col("v")).alias("a"), ar.polyval(ar.array_literal([1, 0, 1]), F.lit(4.0)).alias("p"),
        ar.linspace(F.lit(0.0), F.lit(1.0), 3).alias("l"), ar.arange(F.lit(0.0), F.lit(1.0), 0.5).alias("r"),
        ar.arange(F.lit(1.0), F.lit(0.0), 0.5).alias("none"),
    ).first()
    assert (r.a, r.p, r.l, r.r, r.none) == (1, 17.0, [0.0, 0.5, 1.0], [0.0, 0.5], [])


def test_joins_keep_unmatched_and_split(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "z")], "k int, b string")
    assert {tuple(r) for r in jo.append_columns(a, b, "k").collect()} == {(1, "x", "z"), (2, "y", None)}
    assert jo.keep_missing(a, b, "k").first().k == 2
    hit, rest = ro.split_where(spark.createDataFrame([(1,), (None,), (5,)], "x int"), F.col("x") > 2)
    assert (hit.count(), rest.count()) == (1, 2)


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean()
    assert me.auc(df).first().auc == pytest.approx(want)


def test_improved_and_best(spark):
    steps = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 4.5)], "d int, e double")
    assert [r.verdict for r in wi.improved(steps, "d", "e").orderBy("d").collect()] == ["start", "better", "not better"]
    assert wi.best(steps, "e").first().d == 2


def test_running_total_over_ranges(spark):
    rng = np.random.default_rng(3)
    by, n = rng.permutation(500), rng.integers(0, 9, 500)
    rows = spark.createDataFrame([*zip(by.tolist(), n.tolist(), strict=True), (None, 4)], "by int, n bigint")
    want, total = {None: 4}, 4
    for i in np.argsort(by):
        total += int(n[i])
        want[int(by[i])] = total
    got = ag.running_total(rows.repartition(7), "by", "n")
    assert got.columns == ["by", "n", "running"] and {r["by"]: r["running"] for r in got.collect()} == want
    assert ag.running_total(rows.limit(0), "by", "n").count() == 0


def test_confusion_checks_the_number_of_classes(spark, monkeypatch):
    pred = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in me.confusion(pred).collect()}
    assert cells == {(a, b): int((a, b) in {(0, 0), (0, 1), (2, 1)}) for a in (0, 1, 2) for b in (0, 1, 2)}
    monkeypatch.setattr(me, "MAX_CLASSES", 2)
    with pytest.raises(ValueError, match="at most 2 classes"):
        me.confusion(pred)
