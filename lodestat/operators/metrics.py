"""Scores of predictions: each is one grouped aggregate over (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.operators.aggregates import running_total
from lodestat.session import cut_lineage, fits

MAX_CLASSES = 1_000  # a confusion table has the square of this many cells


def reg_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """SSE, MSE, RMSE, MAE and R2 in one pass."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    s = pred.agg(
        F.sum(e * e).alias("sse"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (F.var_pop(y) * F.count("*")).alias("_sst"),
    )
    return s.select(
        "sse", "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.col("sse") / F.nullif("_sst", F.lit(0.0))).alias("r2")
    )


def r2(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return reg_metrics(pred, label, prediction).select("r2")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return pred.agg(F.avg(hit).alias("accuracy"), (1 - F.avg(hit)).alias("error"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction", normalize: bool = False) -> DataFrame:
    """Every (label, prediction) cell including zeros; ``normalize`` adds the share of the true row.
    The rows counted come down to one per cell, written once, and the classes are checked before anything is completed."""
    counts = cut_lineage(pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n")))
    classes = counts.select("label").union(counts.select("prediction")).distinct()
    if not fits(classes, MAX_CLASSES):
        raise ValueError(f"a confusion table is made for at most {MAX_CLASSES} classes; crosstab counts the cells of more")
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("label", "prediction")))))
    frame = counts.agg(names.alias("names"))
    cells = frame.select("names", F.explode("names").alias("label")).select("label", F.explode("names").alias("prediction"))
    out = cells.join(counts, ["label", "prediction"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if normalize:
        total = F.sum("n").over(W.partitionBy("label"))
        out = out.withColumn("share", F.coalesce(F.col("n") / F.nullif(total, F.lit(0)), F.lit(0.0)))
    return out


def confusion_rows(
    pred: DataFrame, cells: Sequence[tuple], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows that fall into the chosen (label, prediction) cells."""
    hit = F.lit(False)
    for y, p in cells:
        hit = hit | ((F.col(label) == F.lit(y)) & (F.col(prediction) == F.lit(p)))
    return pred.filter(hit)


def report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    c = confusion(pred, label, prediction)
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    rows = c.groupBy("label").agg(F.sum("n").alias("support"), hits.alias("tp"))
    cols = c.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    p = F.coalesce(F.col("tp") / F.nullif("predicted", F.lit(0)), F.lit(0.0))
    r = F.coalesce(F.col("tp") / F.nullif("support", F.lit(0)), F.lit(0.0))
    out = rows.join(cols, "label").select("label", "support", p.alias("precision"), r.alias("recall"))
    f1 = 2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))
    return out.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def report_averages(per_class: DataFrame) -> DataFrame:
    """Plain and support-weighted averages of a per-class report."""
    names = ("precision", "recall", "f1")
    w = F.col("support") / F.sum("support").over(W.partitionBy(F.lit(0)))
    weighted = per_class.withColumn("_w", w)
    return weighted.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[F.sum(F.col(m) * F.col("_w")).alias(f"weighted_{m}") for m in names],
        F.sum("support").alias("support"),
    )


def auc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve of a 0/1 label, ties counted half.

    Scores are first counted per distinct value and then per range of values, so that no step sorts
    all rows in one task: a pair (positive, negative) counts 1 when its scores lie in order.
    """
    per = pred.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
    )
    placed = running_total(per, "s", "neg")
    below = F.col("running") - F.col("neg")
    return placed.select("pos", "neg", (F.col("pos") * (below + F.col("neg") / 2)).alias("wins")).agg(
        (F.sum("wins") / F.nullif(F.sum("pos") * F.sum("neg").cast("double"), F.lit(0.0))).alias("auc")
    )


def cls_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """AUC, accuracy, F1, precision and recall of a 0/1 classifier in one row."""
    y, p = F.col(label) == 1, F.col(prediction) == 1

    def n(c):
        return F.sum(F.when(c, 1.0).otherwise(0.0))

    tp, fp, fn = n(y & p), n(~y & p), n(y & ~p)
    one = pred.agg(
        n(F.col(label) == F.col(prediction)).alias("_hit"), F.count("*").alias("_n"),
        (tp / F.nullif(tp + fp, F.lit(0.0))).alias("precision"), (tp / F.nullif(tp + fn, F.lit(0.0))).alias("recall"),
        (2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0.0))).alias("f1"),
    )
    return one.select(
        auc(pred, label, score).scalar().alias("auc"), (F.col("_hit") / F.col("_n")).alias("accuracy"),
        "f1", "precision", "recall",
    )


def support_ratio(pred: DataFrame, eps: float, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose residual reaches the tube."""
    outside = F.abs(F.col(label) - F.col(prediction)) >= eps
    return pred.agg(F.avg(F.when(outside, 1.0).otherwise(0.0)).alias("support_ratio"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))
