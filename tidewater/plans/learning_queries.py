"""Vector parsing and the learners' batch steps over ``blobs``/``points``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewater.functions.vectors import parse_labeled, parse_vector
from tidewater.operators import learning as ML
from tidewater.plans import duck as D
from tidewater.plans.registry import query
from tidewater.sources.tables import blobs, points

# Explicit starting centres in standardised (income, age) space, k = 5.
KMEANS_START = [(-1.0, -1.0), (-1.0, 1.0), (0.0, 0.0), (1.0, -1.0), (1.0, 1.0)]
POINTS_PER_BATCH = 1000     # the reference's sample files hold 1000 lines
ROUND = 6


def _r(c):
    return F.round(c, ROUND)


def _vec_text():
    return F.concat(F.lit("["), F.col("income").cast("bigint").cast("string"), F.lit(","),
                    F.col("age").cast("bigint").cast("string"), F.lit("]"))


_VEC_SQL = "'[' || cast(cast(income as bigint) as varchar) || ',' || cast(cast(age as bigint) as varchar) || ']'"


def _duck_doubles(text: str, sep: str) -> str:
    return f"list_transform(string_split({text}, '{sep}'), lambda x: try_cast(trim(x) as double))"


# -- SRC8 --------------------------------------------------------------------------
@query("parse_vectors", D.with_(D.BLOBS) + f"""
select id, v[1] as f0, v[2] as f1 from (
  select id, {_duck_doubles(f"regexp_extract(regexp_replace({_VEC_SQL}, '\\s+', '', 'g'), '^\\[(.*)\\]$', 1)", ',')} as v
  from blobs)""")
def q_parse_vectors(spark, sf):
    b = blobs(spark, sf).select("id", parse_vector(_vec_text()).alias("v"))
    return b.select("id", F.get("v", 0).alias("f0"), F.get("v", 1).alias("f1"))


# -- SRC9 --------------------------------------------------------------------------
@query("parse_labeled", D.with_(D.BLOBS) + f"""
select id, try_cast(cast(label as varchar) as double) as label, v[1] as f0, v[2] as f1 from (
  select id, label, {_duck_doubles(f"cast(cast(income as bigint) as varchar) || ',' || cast(cast(age as bigint) as varchar)", ',')} as v
  from blobs)""")
def q_parse_labeled(spark, sf):
    text = F.concat(F.lit("("), F.col("label").cast("string"), F.lit(","), _vec_text(), F.lit(")"))
    b = blobs(spark, sf).select("id", parse_labeled(text).alias("p"))
    return b.select("id", F.col("p.label").alias("label"), F.get("p.features", 0).alias("f0"),
                    F.get("p.features", 1).alias("f1"))


@query("parse_labeled_csv", D.with_(D.POINTS) + """
select id, cast(floor(y * 1e6) as double) as label, cast(floor(x * 1e6) as double) as f0 from points""")
def q_parse_labeled_csv(spark, sf):
    p = points(spark, sf)
    text = F.concat(F.floor(F.col("y") * 1e6).cast("string"), F.lit(","),
                    F.floor(F.col("x") * 1e6).cast("string"))
    q = p.select("id", parse_labeled(text).alias("p"))
    return q.select("id", F.col("p.label").alias("label"), F.get("p.features", 0).alias("f0"))


# -- ML6 ------------------------------------------------------------------------------
@query("standardize", D.with_(D.POINTS) + f"""
select id, round((x - avg(x) over ()) / stddev_pop(x) over (), {ROUND}) as x_std,
       round((y - avg(y) over ()) / stddev_pop(y) over (), {ROUND}) as y_std from points""")
def q_standardize(spark, sf):
    s = ML.standardize(points(spark, sf), ["x", "y"])
    return s.select("id", _r("x_std").alias("x_std"), _r("y_std").alias("y_std"))


# -- ML2 / ML3 / ML1 -----------------------------------------------------------------------
def _scaled_blobs(spark, sf):
    return ML.standardize(blobs(spark, sf), ["income", "age"])


def _duck_assign():
    ds = []
    for c0, c1 in KMEANS_START:
        ds.append(f"(xi - ({c0}))*(xi - ({c0})) + (xa - ({c1}))*(xa - ({c1}))")
    arr = "[" + ", ".join(ds) + "]"
    return f"cast(list_position({arr}, list_min({arr})) - 1 as integer)"


_SCALED = """s as (select id, label, (income - avg(income) over ()) / stddev_pop(income) over () as xi,
                    (age - avg(age) over ()) / stddev_pop(age) over () as xa from blobs)"""


@query("kmeans_assign", D.with_(D.BLOBS, _SCALED) + f"select id, label, {_duck_assign()} as cluster from s")
def q_kmeans_assign(spark, sf):
    s = _scaled_blobs(spark, sf)
    return s.select("id", "label", ML.nearest_centre(["income_std", "age_std"], KMEANS_START).alias("cluster"))


@query("kmeans_contingency", D.with_(D.BLOBS, _SCALED) + f"""
select label, cluster, count(*) as n from (select label, {_duck_assign()} as cluster from s) group by all""")
def q_kmeans_contingency(spark, sf):
    s = _scaled_blobs(spark, sf)
    a = s.select("label", ML.nearest_centre(["income_std", "age_std"], KMEANS_START).alias("cluster"))
    return a.groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("kmeans_update_step", D.with_(D.BLOBS, _SCALED) + f"""
select cluster, count(*) as n, round(sum(xi) / count(*), {ROUND}) as c0, round(sum(xa) / count(*), {ROUND}) as c1
from (select xi, xa, {_duck_assign()} as cluster from s) group by cluster""")
def q_kmeans_update_step(spark, sf):
    """One update from the starting centres with weight 0: each centre
    with points moves to their mean (the first ``trainOn`` batch)."""
    feats = ["income_std", "age_std"]
    sums = ML.cluster_sums(_scaled_blobs(spark, sf), feats, KMEANS_START)
    return sums.select("cluster", "n", *[_r(F.col(f"sum_{f}") / F.col("n")).alias(f"c{i}")
                                         for i, f in enumerate(feats)])


# -- ML4 / ML5 -------------------------------------------------------------------------------
@query("regression_moments", D.with_(D.POINTS) + f"""
select id // {POINTS_PER_BATCH} as batch, count(*) as n,
       round(sum(x), {ROUND}) as sx, round(sum(y), {ROUND}) as sy,
       round(sum(x * x), {ROUND}) as sxx, round(sum(x * y), {ROUND}) as sxy
from points group by all""")
def q_regression_moments(spark, sf):
    p = points(spark, sf).withColumn("batch", F.expr(f"id div {POINTS_PER_BATCH}"))
    m = p.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
                               F.sum(F.col("x") * F.col("x")).alias("sxx"),
                               F.sum(F.col("x") * F.col("y")).alias("sxy"))
    return m.select("batch", "n", *[_r(c).alias(c) for c in ("sx", "sy", "sxx", "sxy")])


@query("regression_predict", D.with_(D.POINTS) + f"""
, m as (select regr_slope(y, x) as b1, regr_intercept(y, x) as b0 from points)
select id, y, round(b0 + b1 * x, {ROUND}) as y_hat from points, m""")
def q_regression_predict(spark, sf):
    """Predictions carried with the known label, from the least-squares
    fit of the whole table's moments."""
    p = points(spark, sf)
    slope, intercept = ML.least_squares(ML.regression_moments(p, ["x"], "y").first().asDict())
    model = ML.LinearModel(weights=np.array([slope]), intercept=intercept)
    return p.select("id", "y", _r(model.predict(["x"])).alias("y_hat"))
