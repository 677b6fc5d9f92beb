"""Named queries on tables: projection, filters, joins, aggregates, windows, scalar functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestat.functions import arrays as ar
from lodestat.functions import hashing as hs
from lodestat.operators import aggregates as ag
from lodestat.operators import joins as jo
from lodestat.operators import moments as mo
from lodestat.operators import rows as ro
from lodestat.operators import windows as wi
from lodestat.plans import sqltext as q
from lodestat.plans.registry import query
from lodestat.roles import Roles
from lodestat.sources import readers as rd
from lodestat.sources import sinks as sk


def _t(spark, folder, name):
    return rd.read_dataset(spark, folder, name)


def _emb(spark, folder):
    return rd.read_dataset(spark, folder, "embeddings", spread_by="vec_id").withColumn(
        "embedding", ar.doubles(F.col("embedding"))
    )


def _long(c):
    return F.col(c).cast("bigint").alias(c)


# --- sources, sinks ----------------------------------------------------------------------------


@query(
    "src7_rows_to_table",
    """SELECT meaning, count(*) AS n FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) m(l_returnflag, meaning)
USING (l_returnflag) GROUP BY meaning""",
)
def rows_to_table(spark, folder):
    held = [("A", "accepted"), ("N", "none"), ("R", "returned")]
    meanings = rd.from_rows(spark, held, "l_returnflag string, meaning string")
    return ag.value_counts(jo.lookup(_t(spark, folder, "lineitem"), meanings, "l_returnflag"), "meaning")


@query("src8_vectors_of_length", "SELECT vec_id, label FROM embeddings WHERE len(embedding) = 64")
def vectors_of_length(spark, folder):
    return rd.vectors_of_length(_emb(spark, folder), "embedding", 64).select("vec_id", "label")


@query(
    "src9_json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') <> ''",
)
def json_field(spark, folder):
    return rd.json_field(_t(spark, folder, "events"), "props", "$.k", "k").select("event_id", _long("k"))


@query(
    "jsn1_json_totals",
    "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type",
)
def json_totals(spark, folder):
    parsed = _t(spark, folder, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return parsed.groupBy("event_type").agg(F.sum("k").alias("total"))


@query(
    "snk4_show_table",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def show_table(spark, folder):
    return sk.show_table(
        _t(spark, folder, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"]
    )


# --- projection --------------------------------------------------------------------------------


@query("prj1_map_record", "SELECT c_custkey * 2 AS double_key, upper(c_mktsegment) AS segment FROM customer")
def map_record(spark, folder):
    return _t(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("double_key"), F.upper("c_mktsegment").alias("segment")
    )


@query("prj2_select_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def select_columns(spark, folder):
    return _t(spark, folder, "orders").select("o_orderkey", "o_orderstatus")


@query("prj3_column_range", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def column_range(spark, folder):
    return ro.select_range(_t(spark, folder, "lineitem"), 4, 8)


@query(
    "prj4_assign_roles",
    "SELECT p_partkey, p_retailprice, round(p_size + p_retailprice * 2, 4) AS weighted FROM part",
)
def assign_roles(spark, folder):
    part = _t(spark, folder, "part").withColumn("p_size", F.col("p_size").cast("double"))
    part = part.withColumn("twice", F.col("p_retailprice") * 2)
    table = ro.with_roles(part, Roles(("p_size", "twice"), "p_retailprice", ("p_partkey",)), "features")
    return table.select(
        "p_partkey", "p_retailprice", F.round(ar.total(vector_to_array("features")), 4).alias("weighted")
    )


@query(
    "prj5_derived_columns",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity > 25 AS large, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem",
)
def derived_columns(spark, folder):
    return _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") > 25).alias("large"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
    )


@query(
    "prj6_code_to_category",
    """SELECT c_custkey, CASE c_nationkey // 10 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS grade FROM customer""",
)
def code_to_category(spark, folder):
    c = _t(spark, folder, "customer").withColumn("code", F.col("c_nationkey") / 10)
    return ro.code_to_category(c, "code", ["A", "B", "C"], "grade").select("c_custkey", "grade")


@query(
    "prj7_category_codes",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer",
)
def category_codes(spark, folder):
    return ro.category_codes(_t(spark, folder, "customer"), "c_mktsegment").select("c_custkey", "code")


@query(
    "prj8_unpivot",
    """SELECT l_returnflag, variable, round(estimate, 4) AS estimate FROM (
  UNPIVOT (SELECT l_returnflag, avg(l_quantity) AS quantity, avg(l_discount) AS discount, avg(l_tax) AS tax FROM lineitem GROUP BY l_returnflag)
  ON quantity, discount, tax INTO NAME variable VALUE estimate)""",
)
def unpivot(spark, folder):
    wide = _t(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax")
    )
    long = ro.unpivot_columns(wide, ["l_returnflag"], ["quantity", "discount", "tax"], "variable", "estimate")
    return long.withColumn("estimate", F.round("estimate", 4))


@query(
    "prj9_concat_arrays",
    f"WITH {q.EMB} SELECT vec_id, CAST(len(list_concat(v, v)) AS BIGINT) AS width, list_concat(v, v)[65] AS first_again FROM e",
)
def concat_arrays(spark, folder):
    both = ro.concat_arrays(_emb(spark, folder), "embedding", "embedding", "both")
    return both.select("vec_id", F.size("both").cast("bigint").alias("width"), F.element_at("both", 65).alias("first_again"))


@query(
    "prj10_split_array",
    f"WITH {q.EMB} SELECT vec_id, round(list_sum(v[1:32]), 6) AS upper_half, round(list_sum(v[33:64]), 6) AS lower_half FROM e",
)
def split_array(spark, folder):
    halves = ro.split_array(_emb(spark, folder), "embedding", 32, "upper", "lower")
    return halves.select(
        "vec_id", F.round(ar.total(F.col("upper")), 6).alias("upper_half"), F.round(ar.total(F.col("lower")), 6).alias("lower_half")
    )


@query("prj11_bias_column", "SELECT p_partkey, 1.0::DOUBLE AS bias, p_size FROM part")
def bias_column(spark, folder):
    return ro.add_bias(_t(spark, folder, "part")).select("p_partkey", "bias", "p_size")


# --- filters -----------------------------------------------------------------------------------


@query(
    "flt3_split_where",
    """SELECT 'hit' AS side, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 250000
UNION ALL SELECT 'rest', count(*), round(sum(o_totalprice), 2) FROM orders WHERE NOT o_totalprice > 250000""",
)
def split_where(spark, folder):
    hit, rest = ro.split_where(_t(spark, folder, "orders"), F.col("o_totalprice") > 250_000)

    def side(df, name):
        return df.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("side", F.lit(name))

    return jo.stacked_rows(side(hit, "hit"), side(rest, "rest"))


@query("flt4_equality_mask", "SELECT vec_id FROM embeddings WHERE label = 0")
def equality_mask(spark, folder):
    return _t(spark, folder, "embeddings").filter(F.col("label") == 0).select("vec_id")


@query(
    "flt5_norm",
    f"WITH {q.EMB_LONG} SELECT vec_id FROM el GROUP BY vec_id HAVING sqrt(sum(v * v)) > 0.9",
)
def norm_filter(spark, folder):
    return ro.filter_norm(_emb(spark, folder), "embedding", 0.9).select("vec_id")


@query(
    "flt6_compound",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_quantity >= 30 AND l_discount > 0.05 AND l_returnflag <> 'N') OR NOT (l_tax > 0 OR l_linestatus = 'O')",
)
def compound(spark, folder):
    c = F.col
    return (
        _t(spark, folder, "lineitem")
        .filter(
            ((c("l_quantity") >= 30) & (c("l_discount") > 0.05) & (c("l_returnflag") != "N"))
            | ~((c("l_tax") > 0) | (c("l_linestatus") == "O"))
        )
        .select("l_orderkey", "l_linenumber", "l_partkey")
    )


@query(
    "flt7_membership",
    "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND list_contains([1, 3, 5, 7], c_nationkey)",
)
def membership(spark, folder):
    listed = F.array(*[F.lit(i) for i in (1, 3, 5, 7)])
    return (
        _t(spark, folder, "customer")
        .filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.array_contains(listed, F.col("c_nationkey")))
        .select("c_custkey")
    )


@query(
    "flt8_correct_rows",
    "SELECT doc_id, quality, toxic, (CASE WHEN toxic = 1 THEN 0 ELSE 1 END) = quality AS correct FROM labels",
)
def correct_rows(spark, folder):
    guess = F.when(F.col("toxic") == 1, 0).otherwise(1)
    scored = _t(spark, folder, "labels").withColumn("guess", guess)
    right, wrong = ro.split_where(scored, F.col("guess") == F.col("quality"))
    both = jo.stacked_rows(right.withColumn("correct", F.lit(True)), wrong.withColumn("correct", F.lit(False)))
    return both.select("doc_id", "quality", "toxic", "correct")


_ORD = "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders"


@query("flt9_row_slice", f"SELECT o_orderkey FROM ({_ORD}) WHERE r >= 10 AND r < n - 10 AND (r - 10) % 2 = 0")
def row_slice(spark, folder):
    orders = _t(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ro.slice_rows(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 10, -10, 2).select("o_orderkey")


# --- joins -------------------------------------------------------------------------------------


@query(
    "joi2_inner_merge",
    "SELECT o_orderkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_merge(spark, folder):
    orders = _t(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return jo.merge(orders, _t(spark, folder, "customer"), "c_custkey").select("o_orderkey", "c_mktsegment", "o_totalprice")


@query("joi3_append_columns", "SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def append_columns(spark, folder):
    docs = _t(spark, folder, "documents").select("doc_id", "lang")
    return jo.append_columns(docs, _t(spark, folder, "labels"), "doc_id")


@query("joi4_matching_rows", "SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def matching_rows(spark, folder):
    docs = _t(spark, folder, "documents").select("doc_id", "n_chars")
    return jo.matching_rows(docs, _t(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


@query(
    "joi5_existing_and_missing",
    "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS listed FROM documents",
)
def existing_and_missing(spark, folder):
    docs, labels = _t(spark, folder, "documents").select("doc_id"), _t(spark, folder, "labels")
    return jo.stacked_rows(
        jo.keep_existing(docs, labels, "doc_id").withColumn("listed", F.lit(True)),
        jo.keep_missing(docs, labels, "doc_id").withColumn("listed", F.lit(False)),
    )


@query(
    "joi6_grid",
    """WITH b AS (SELECT min(p_size) AS x0, max(p_size) AS x1, min(p_retailprice) AS y0, max(p_retailprice) AS y1 FROM part)
SELECT i AS size_step, j AS price_step, round(x0 + i * (x1 - x0) / 20.0, 6) AS x, round(y0 + j * (y1 - y0) / 20.0, 6) AS y
FROM b, range(21) t(i), range(21) u(j)""",
)
def grid(spark, folder):
    b = ag.extent(_t(spark, folder, "part"), "p_size", "p_retailprice")
    steps = F.sequence(F.lit(0), F.lit(20)).cast("array<bigint>")
    lo_x, hi_x, lo_y, hi_y = (F.col(c) for c in ("p_size_min", "p_size_max", "p_retailprice_min", "p_retailprice_max"))
    g = jo.grid(b, steps, steps, "size_step", "price_step")
    return g.select(
        "size_step", "price_step",
        F.round(lo_x + F.col("size_step") * (hi_x - lo_x) / 20.0, 6).alias("x"),
        F.round(lo_y + F.col("price_step") * (hi_y - lo_y) / 20.0, 6).alias("y"),
    )


@query(
    "joi9_map_lookup",
    "SELECT event_id, CAST(coalesce(map(['click', 'view', 'purchase'], [1, 2, 10])[event_type], 0) AS BIGINT) AS points FROM events",
)
def map_lookup(spark, folder):
    points = F.create_map(*[F.lit(x) for x in ("click", 1, "view", 2, "purchase", 10)])
    return _t(spark, folder, "events").select(
        "event_id", ar.map_get(points, F.col("event_type"), 0).cast("bigint").alias("points")
    )


# --- aggregates --------------------------------------------------------------------------------


@query("agg4_vector_sum", f"WITH {q.EMB_LONG} SELECT CAST(pos AS BIGINT) AS pos, round(sum(v), 6) AS total FROM el GROUP BY pos")
def vector_sum(spark, folder):
    return ag.vector_sum(_emb(spark, folder), "embedding").select(_long("pos"), F.round("total", 6).alias("total"))


@query(
    "agg6_gram_matrix",
    f"""WITH {q.EMB_LONG} SELECT CAST(a.pos AS BIGINT) AS i, CAST(b.pos AS BIGINT) AS j, round(sum(a.v * b.v), 6) AS value
FROM el a JOIN el b USING (vec_id) GROUP BY a.pos, b.pos""",
)
def gram_matrix(spark, folder):
    return mo.gram(_emb(spark, folder), "embedding").withColumn("value", F.round("value", 6))


@query(
    "agg7_target_weighted_sum",
    f"WITH {q.EMB_LONG} SELECT CAST(pos AS BIGINT) AS pos, round(sum(CASE WHEN label IN (1, 4, 7) THEN v ELSE -v END), 6) AS total FROM el GROUP BY pos",
)
def target_weighted_sum(spark, folder):
    y = F.when(F.col("label").isin(1, 4, 7), 1.0).otherwise(-1.0)
    return ag.xty(_emb(spark, folder), "embedding", y).select(_long("pos"), F.round("total", 6).alias("total"))


@query("agg8_group_mean", "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY l_returnflag")
def group_mean(spark, folder):
    return ag.group_mean(_t(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice").withColumn("mean", F.round("mean", 4))


@query(
    "agg9_group_stats",
    "SELECT l_suppkey, round(sum(l_quantity), 4) AS total, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std FROM lineitem GROUP BY l_suppkey",
)
def group_stats(spark, folder):
    s = ag.group_stats(_t(spark, folder, "lineitem"), "l_suppkey", "l_quantity")
    return s.select("l_suppkey", F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("agg16_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, folder):
    return ag.value_counts(_t(spark, folder, "events"), "event_type")


def _hist(by="", bins=20):
    key = f"{by}, " if by else ""
    return f"""b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT {key}CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin, count(*) AS n FROM lineitem, b GROUP BY ALL)"""


@query(
    "agg17_histogram",
    f"""WITH {_hist()}, f AS (SELECT range AS bin, coalesce(n, 0) AS n, lo, (hi - lo) / 20 AS w FROM range(20) LEFT JOIN c ON bin = range, b)
SELECT bin, n, round(lo + bin * w, 4) AS edge, round(n / (sum(n) OVER () * w), 9) AS density, CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS running FROM f""",
)
def histogram(spark, folder):
    h = ag.histogram(_t(spark, folder, "lineitem"), "l_extendedprice", 20, density=True, cumulative=True)
    return h.select("bin", "n", F.round("edge", 4).alias("edge"), F.round("density", 9).alias("density"), "running")


@query(
    "agg18_histogram_by_group",
    f"""WITH {_hist('l_returnflag')}, g AS (SELECT DISTINCT l_returnflag FROM lineitem)
SELECT g.l_returnflag, range AS bin, coalesce(n, 0) AS n FROM g CROSS JOIN range(20) LEFT JOIN c ON c.bin = range AND c.l_returnflag = g.l_returnflag""",
)
def histogram_by_group(spark, folder):
    h = ag.histogram(_t(spark, folder, "lineitem"), "l_extendedprice", 20, by="l_returnflag")
    return h.select("l_returnflag", "bin", "n")


@query("win5_running_distribution", "SELECT l_quantity, CAST(sum(count(*)) OVER (ORDER BY l_quantity) AS BIGINT) AS running FROM lineitem GROUP BY l_quantity")
def running_distribution(spark, folder):
    counts = ag.value_counts(_t(spark, folder, "lineitem"), "l_quantity")
    return ag.running_total(counts, "l_quantity", "n", "running").select("l_quantity", "running")


@query(
    "agg19_extent",
    "SELECT count(*) AS n, min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, min(l_tax) AS l_tax_min, max(l_tax) AS l_tax_max FROM lineitem",
)
def extent(spark, folder):
    return ag.extent(_t(spark, folder, "lineitem"), "l_quantity", "l_tax")


@query(
    "agg20_score_stats",
    "SELECT round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events",
)
def score_stats(spark, folder):
    s = ag.score_stats(_t(spark, folder, "events"), "value")
    return s.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("agg21_distinct", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct(spark, folder):
    return _t(spark, folder, "orders").select("o_orderpriority").distinct()


_COV_COLS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "agg22_covariance",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}), 6) AS cov, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(_COV_COLS)
        for b in _COV_COLS[i:]
    ),
)
def covariance(spark, folder):
    c = ag.covariance(_t(spark, folder, "lineitem"), _COV_COLS)
    # adding zero turns a rounded -0.0 into 0.0
    return c.select("a", "b", (F.round("cov", 6) + 0.0).alias("cov"), (F.round("corr", 6) + 0.0).alias("corr"))


# --- windows, sorting, sets --------------------------------------------------------------------


@query("win3_row_id", "SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_id FROM lineitem")
def row_id(spark, folder):
    li = _t(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ro.with_row_id(li, order).select("l_orderkey", "l_partkey", "l_linenumber", "row_id")


@query(
    "win4_weekly_lag_lead",
    """WITH w AS (SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS period, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume FROM lineitem GROUP BY ALL),
p AS (SELECT *, lag(volume) OVER o AS volume_prev, lead(volume) OVER o AS volume_next FROM w WINDOW o AS (PARTITION BY l_suppkey ORDER BY period))
SELECT l_suppkey, CAST(period AS VARCHAR) AS period, volume, volume_prev, volume_next,
  round(100 * (volume - volume_prev) / nullif(volume_prev, 0), 6) AS volume_pct_prev, round(100 * (volume_next - volume) / nullif(volume, 0), 6) AS volume_pct_next FROM p""",
)
def weekly_lag_lead(spark, folder):
    out = wi.periodic_lag_lead(
        _t(spark, folder, "lineitem"), "l_suppkey", "l_shipdate", "week",
        {"volume": F.sum(F.col("l_quantity").cast("bigint"))},
    )
    return out.withColumns(
        {
            "period": F.col("period").cast("string"),
            "volume_pct_prev": F.round("volume_pct_prev", 6),
            "volume_pct_next": F.round("volume_pct_next", 6),
        }
    )


@query(
    "win6_improved",
    """WITH m AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS step, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY step)
SELECT step, cents, CASE WHEN lag(cents) OVER (ORDER BY step) IS NULL THEN 'start' WHEN cents < lag(cents) OVER (ORDER BY step) THEN 'better' ELSE 'not better' END AS verdict FROM m""",
)
def improved(spark, folder):
    step = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("step")
    months = _t(spark, folder, "orders").groupBy(step).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )
    return wi.improved(months, "step", "cents")


@query("srt1_sorted", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sorted_rows(spark, folder):
    return _t(spark, folder, "customer").select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey")


@query(
    "top2_best_row",
    "SELECT l_suppkey, round(avg(l_discount), 9) AS score FROM lineitem GROUP BY l_suppkey ORDER BY score, l_suppkey LIMIT 1",
)
def best_row(spark, folder):
    scores = _t(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 9).alias("score"))
    return wi.best(scores, "score", "min", ["l_suppkey"])


@query(
    "win2_top_rows_per_group",
    "SELECT c_nationkey, c_custkey, c_acctbal, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 5",
)
def top_rows_per_group(spark, folder):
    top = wi.top_k_per(_t(spark, folder, "customer"), "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 5)
    return top.select("c_nationkey", "c_custkey", "c_acctbal", _long("rank"))


@query(
    "set1_append_rows",
    "SELECT item_id AS id, text FROM benchmark UNION ALL SELECT conv_id, text FROM conversations",
)
def append_rows(spark, folder):
    a = _t(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    return jo.stacked_rows(a, _t(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text"))


@query(
    "set2_append_columns_by_row",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS r FROM customer),
b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS r FROM part)
SELECT c_custkey, p_partkey FROM a FULL JOIN b USING (r)""",
)
def append_columns_by_row(spark, folder):
    a = ro.with_row_id(_t(spark, folder, "customer").select("c_custkey"), ["c_custkey"])
    b = ro.with_row_id(_t(spark, folder, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"])
    return jo.side_by_side(a, b, "row_id").select("c_custkey", "p_partkey")


@query(
    "set3_stack_vectors",
    """WITH s AS (SELECT vec_id, label, list_sum(CAST(embedding AS DOUBLE[])) AS t FROM embeddings)
SELECT 'first' AS part, vec_id, round(t, 6) AS total FROM s WHERE label < 5 UNION ALL SELECT 'second', vec_id, round(t, 6) FROM s WHERE label >= 5""",
)
def stack_vectors(spark, folder):
    e = _emb(spark, folder)
    low, high = ro.split_where(e, F.col("label") < 5)
    both = jo.stacked_rows(low.withColumn("part", F.lit("first")), high.withColumn("part", F.lit("second")))
    return both.select("part", "vec_id", F.round(ar.total(F.col("embedding")), 6).alias("total"))


# --- scalar, array and map functions -----------------------------------------------------------


@query(
    "mth1_arithmetic",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(floor(l_quantity / 7) AS BIGINT) AS whole, l_quantity % 7 AS rest, l_quantity ** 2 AS square,
  round(sqrt(l_extendedprice), 6) AS root, round(sin(l_discount), 9) AS s, round(cos(l_tax), 9) AS c, round(ln(l_extendedprice), 9) AS l, abs(l_quantity - 25) AS a FROM lineitem""",
)
def arithmetic(spark, folder):
    c = F.col
    return _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        ar.floor_div(c("l_quantity"), F.lit(7)).alias("whole"), (c("l_quantity") % 7).alias("rest"),
        F.pow("l_quantity", F.lit(2.0)).alias("square"), F.round(F.sqrt("l_extendedprice"), 6).alias("root"),
        F.round(F.sin("l_discount"), 9).alias("s"), F.round(F.cos("l_tax"), 9).alias("c"),
        F.round(F.log("l_extendedprice"), 9).alias("l"), F.abs(c("l_quantity") - 25).alias("a"),
    )


@query("mth3_polynomial", "SELECT p_partkey, CAST(1 + p_size * p_size AS DOUBLE) AS value FROM part")
def polynomial(spark, folder):
    value = ar.polyval(ar.array_literal([1, 0, 1]), F.col("p_size").cast("double"))
    return _t(spark, folder, "part").select("p_partkey", value.alias("value"))


@query(
    "mth4_value_grids",
    """WITH b AS (SELECT l_suppkey, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, CAST(i AS BIGINT) AS i, round(lo + i * ((hi - lo) / 4), 6) AS linear, round(10.0 ** (lo / 50 + i * ((hi / 50 - lo / 50) / 4)), 6) AS logarithmic FROM b, range(5) t(i)""",
)
def value_grids(spark, folder):
    b = _t(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    zipped = F.arrays_zip(
        ar.linspace(F.col("lo"), F.col("hi"), 5).alias("lin"), ar.logspace(F.col("lo") / 50, F.col("hi") / 50, 5).alias("log")
    )
    return b.select("l_suppkey", F.posexplode(zipped).alias("i", "z")).select(
        "l_suppkey", _long("i"), F.round("z.lin", 6).alias("linear"), F.round("z.log", 6).alias("logarithmic")
    )


@query(
    "mth4_step_grid",
    """SELECT l_suppkey, lo + i * 7 AS x FROM (SELECT l_suppkey, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_suppkey), range(20) t(i) WHERE lo + i * 7 < hi""",
)
def step_grid(spark, folder):
    b = _t(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    return b.select("l_suppkey", F.explode(ar.arange(F.col("lo"), F.col("hi"), 7.0)).alias("x"))


@query(
    "arr1_index_slice",
    f"WITH {q.EMB} SELECT vec_id, v[1] AS first, v[-1] AS last, round(list_sum(v[3:6]), 9) AS part FROM e",
)
def index_slice(spark, folder):
    e = F.col("embedding")
    return _emb(spark, folder).select(
        "vec_id", F.element_at(e, 1).alias("first"), F.element_at(e, -1).alias("last"),
        F.round(ar.total(F.slice(e, 3, 4)), 9).alias("part"),
    )


@query(
    "arr2_append_pop",
    f"WITH {q.EMB} SELECT vec_id, CAST(len(list_append(v, 1.0)) AS BIGINT) AS longer, CAST(len(v[1:len(v) - 1]) AS BIGINT) AS shorter, v[len(v) - 1] AS new_last FROM e",
)
def append_pop(spark, folder):
    e = F.col("embedding")
    return _emb(spark, folder).select(
        "vec_id", F.size(F.array_append(e, F.lit(1.0))).cast("bigint").alias("longer"),
        F.size(ar.drop_last(e)).cast("bigint").alias("shorter"), F.element_at(ar.drop_last(e), -1).alias("new_last"),
    )


@query(
    "arr3_map_filter",
    f"WITH {q.EMB} SELECT vec_id, round(list_sum([x * x FOR x IN v]), 6) AS squares, CAST(len([x FOR x IN v IF x > 0]) AS BIGINT) AS positive FROM e",
)
def map_filter(spark, folder):
    e = F.col("embedding")
    return _emb(spark, folder).select(
        "vec_id", F.round(ar.total(F.transform(e, lambda x: x * x)), 6).alias("squares"),
        F.size(F.filter(e, lambda x: x > 0)).cast("bigint").alias("positive"),
    )


@query(
    "arr6_elementwise",
    f"""WITH {q.EMB_LONG}, p AS (SELECT vec_id, v, lead(v) OVER (PARTITION BY vec_id ORDER BY pos) AS w, pos FROM el)
SELECT vec_id, round(sum(v + w), 6) AS added, round(sum(v * w), 6) AS multiplied, CAST(count(*) FILTER (v < w) AS BIGINT) AS less FROM p WHERE w IS NOT NULL GROUP BY vec_id""",
)
def elementwise(spark, folder):
    a, b = F.slice("embedding", 1, 63), F.slice("embedding", 2, 63)
    return _emb(spark, folder).select(
        "vec_id", F.round(ar.total(ar.add(a, b)), 6).alias("added"), F.round(ar.dot(a, b), 6).alias("multiplied"),
        F.size(F.filter(ar.less(a, b), lambda x: x)).cast("bigint").alias("less"),
    )


@query(
    "arr7_dot_distance_norm",
    f"""WITH {q.EMB} SELECT vec_id, round(list_dot_product(v[1:32], v[33:64]), 6) AS dot, round(list_distance(v[1:32], v[33:64]), 6) AS distance, round(sqrt(list_dot_product(v, v)), 6) AS norm FROM e""",
)
def dot_distance_norm(spark, folder):
    a, b = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    return _emb(spark, folder).select(
        "vec_id", F.round(ar.dot(a, b), 6).alias("dot"), F.round(ar.distance(a, b), 6).alias("distance"),
        F.round(ar.norm(F.col("embedding")), 6).alias("norm"),
    )


@query("arr8_argmax", f"WITH {q.EMB} SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS BIGINT) AS at FROM e")
def argmax(spark, folder):
    return _emb(spark, folder).select("vec_id", ar.argmax(F.col("embedding")).alias("at"))


@query(
    "arr9_flatten",
    f"WITH {q.EMB} SELECT vec_id, CAST(len(flatten([v[1:8], v[9:64]])) AS BIGINT) AS width, round(list_sum(flatten([v[1:8], v[9:64]])), 6) AS total FROM e",
)
def flatten(spark, folder):
    flat = F.flatten(F.array(F.slice("embedding", 1, 8), F.slice("embedding", 9, 56)))
    return _emb(spark, folder).select("vec_id", F.size(flat).cast("bigint").alias("width"), F.round(ar.total(flat), 6).alias("total"))


@query(
    "map1_get_with_default",
    "SELECT c_custkey, CAST(coalesce(map(['BUILDING', 'MACHINERY'], [3, 5])[c_mktsegment], 0) + 1 AS BIGINT) AS n FROM customer",
)
def get_with_default(spark, folder):
    m = F.create_map(F.lit("BUILDING"), F.lit(3), F.lit("MACHINERY"), F.lit(5))
    return _t(spark, folder, "customer").select(
        "c_custkey", (ar.map_get(m, F.col("c_mktsegment"), 0) + 1).cast("bigint").alias("n")
    )


@query(
    "cnd1_conditional",
    "SELECT vec_id, CASE WHEN label IN (1, 4, 7) THEN 1.0 ELSE -1.0 END::DOUBLE AS target, CASE WHEN label IN (1, 4, 7) THEN 'in' ELSE 'out' END AS side FROM embeddings",
)
def conditional(spark, folder):
    t = F.when(F.col("label").isin(1, 4, 7), 1.0).otherwise(-1.0)
    return _t(spark, folder, "embeddings").select(
        "vec_id", t.alias("target"), F.when(t > 0, "in").otherwise("out").alias("side")
    )


@query("prj5_hash_unit", f"SELECT o_orderkey, round({q.hash_unit('o_orderkey', 42)}, 9) AS u FROM orders")
def hash_unit(spark, folder):
    return _t(spark, folder, "orders").select("o_orderkey", F.round(hs.hash_unit("o_orderkey", 42), 9).alias("u"))
