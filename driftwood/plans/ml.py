"""Registered queries: batch scoring by spec replay, MLlib tree models, permutation importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mllib as ML
from ..operators import models as M
from ..operators.evaluate import regression_report
from ..operators.lookup import FeatureLookup, create_training_set, score_batch
from ..operators.prep import random_split
from .registry import Tables, query


def _order_training(t):
    spine = t.orders.select("o_orderkey", "o_custkey", "o_totalprice",
                            (F.col("o_orderstatus") == "F").cast("double").alias("label"),
                            (F.col("o_totalprice") / F.lit(1000.0)).alias("y"))
    return create_training_set(
        spine, [FeatureLookup(t.customer, lookup_key="o_custkey", table_keys="c_custkey",
                              feature_names=["c_acctbal", "c_nationkey", "c_mktsegment"])],
        label="label")


@query("score_batch", """
WITH d AS (SELECT o.o_orderkey, o.o_totalprice / 1000.0 AS y, c.c_acctbal
           FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
m AS (SELECT regr_slope(y, c_acctbal) AS b1, regr_intercept(y, c_acctbal) AS b0 FROM d)
SELECT o.o_orderkey, c.c_acctbal, round(m.b0 + m.b1 * c.c_acctbal, 6) AS prediction
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey, m
""")
def score_batch_q(spark, sf_dir):
    """Fit on the training set, then score key-only rows: the stored spec replays the lookups."""
    t = Tables(spark, sf_dir)
    train, spec = _order_training(t)
    model = M.fit_linear(train, ["c_acctbal"], "y")
    keys_only = t.orders.select("o_orderkey", "o_custkey")
    scored = score_batch(model, spec, keys_only)
    return scored.select("o_orderkey", "c_acctbal", F.round("prediction", 6).alias("prediction"))


@query("gbt_score")
def gbt_score(spark, sf_dir):
    """Boosted-tree classifier on the order training set; scored on the held-out split."""
    t = Tables(spark, sf_dir)
    df, _ = _order_training(t)
    df = random_split(df, "o_orderkey", 0.2, 42)
    model = ML.fit_gbt_classifier(df.where("split = 'train'"), ["o_totalprice", "c_acctbal", "c_nationkey"],
                                  ["c_mktsegment"], "label", max_iter=10)
    scored = ML.positive_probability(model.transform(df.where("split = 'test'")))
    return scored.select("o_orderkey", "label", "prediction", F.round("p1", 6).alias("p1"))


@query("rf_score")
def rf_score(spark, sf_dir):
    """Random-forest regressor (depth 3, 20 trees, seed 42) on line items; scored on the test split."""
    t = Tables(spark, sf_dir)
    li = random_split(t.lineitem.withColumn("y", F.col("l_extendedprice") / F.lit(1000.0))
                      .withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber")), "row_id", 0.2, 42)
    model = ML.fit_rf_regressor(li.where("split = 'train'"), ["l_quantity", "l_discount", "l_tax"], "y")
    scored = model.transform(li.where("split = 'test'"))
    return scored.select("l_orderkey", "l_linenumber", "y", F.round("prediction", 6).alias("prediction"))


@query("permutation_importance", """
WITH d AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_quantity AS a, l_discount AS b,
                  l_extendedprice / 1000.0 AS y FROM lineitem),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS caa, covar_pop(a, b) AS cab, var_pop(b) AS cbb,
             covar_pop(a, y) AS cay, covar_pop(b, y) AS cby FROM d),
k AS (SELECT *, (cbb * cay - cab * cby) / (caa * cbb - cab * cab) AS b1, (caa * cby - cab * cay) / (caa * cbb - cab * cab) AS b2 FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY md5('7|' || id || '|row'), id) AS rr,
             row_number() OVER (ORDER BY md5('7|' || id || '|val'), id) AS rv FROM d),
p AS (SELECT r.y, r.a, r.b, v.a AS pa, v.b AS pb FROM r JOIN r v ON v.rv = r.rr),
e AS (SELECT avg(pow(y - my - b1 * (a - ma) - b2 * (b - mb), 2)) AS base_mse,
             avg(pow(y - my - b1 * (pa - ma) - b2 * (b - mb), 2)) AS e1, avg(pow(y - my - b1 * (a - ma) - b2 * (pb - mb), 2)) AS e2 FROM p, k)
SELECT f AS feature, round(base_mse, 6) AS base_mse, round(m, 6) AS permuted_mse, round(m - base_mse, 6) AS importance
FROM (SELECT 'l_quantity' AS f, base_mse, e1 AS m FROM e UNION ALL SELECT 'l_discount', base_mse, e2 FROM e)
""")
def permutation_importance(spark, sf_dir):
    """MSE increase when one feature's values are permuted across rows (seeded, bucketed shuffle)."""
    t = Tables(spark, sf_dir)
    li = (t.lineitem.withColumn("y", F.col("l_extendedprice") / F.lit(1000.0))
          .withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    feats = ["l_quantity", "l_discount"]
    model = M.fit_linear(li, feats, "y")
    base = regression_report(model.score(li, "pred"), "y", "pred").select(F.col("metric_mse").alias("base_mse"))
    parts = []
    for f in feats:
        perm = M.permuted_column(li.select("row_id", "y", *feats), f, "row_id")
        rep = regression_report(model.score(perm, "pred"), "y", "pred")
        parts.append(rep.select(F.lit(f).alias("feature"), F.col("metric_mse").alias("permuted_mse")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.crossJoin(base).select("feature", F.round("base_mse", 6).alias("base_mse"),
                                      F.round("permuted_mse", 6).alias("permuted_mse"),
                                      F.round(F.col("permuted_mse") - F.col("base_mse"), 6).alias("importance"))
