"""Registered queries over catalog feature tables: merge, lookup, DDL, and an appended log of runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.evaluate import regression_report
from ..operators.lookup import FeatureLookup, create_training_set
from ..operators.models import fit_linear
from ..sources.catalog import FeatureCatalog, append_partitioned
from .registry import Tables, query
from .tables import _MERGE_SQL, customer_updates


def _new(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


def merged_customers(spark, t) -> str:
    """A catalog feature table of the customers after their updates."""
    store, name = FeatureCatalog(spark), _new("customer_features")
    store.create(name, t.customer, "c_custkey", description="customer's balance features")
    store.merge(name, customer_updates(t))
    return name


@query("catalog_merge", f"WITH {_MERGE_SQL} SELECT * FROM m")
def catalog_merge(spark, sf_dir):
    return spark.table(merged_customers(spark, Tables(spark, sf_dir)))


@query("catalog_lookup", f"""
WITH {_MERGE_SQL}
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, m.c_acctbal, m.c_mktsegment
FROM orders o LEFT JOIN m ON m.c_custkey = o.o_custkey
""")
def catalog_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    look = FeatureLookup(spark.table(merged_customers(spark, t)), "o_custkey", "c_custkey", ["c_acctbal", "c_mktsegment"])
    df, _ = create_training_set(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [look])
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "c_acctbal", "c_mktsegment")


@query("catalog_ddl", """
SELECT o_custkey AS c_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""")
def catalog_ddl(spark, sf_dir):
    """A table declared in SQL, filled by a merge, read by SQL."""
    store, name = FeatureCatalog(spark), _new("order_features")
    store.create_empty(name, "c_custkey BIGINT, n_orders BIGINT, spent DOUBLE", "c_custkey", description="orders of a customer")
    orders = Tables(spark, sf_dir).orders
    store.merge(name, orders.where("o_custkey is not null").groupBy(F.col("o_custkey").cast("long").alias("c_custkey"))
                .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")))
    return spark.sql(f"SELECT c_custkey, n_orders, spent FROM {name}")


@query("compare_runs", """
WITH d AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice / 1000.0 AS y, l_returnflag FROM lineitem),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS caa, covar_pop(a, b) AS cab, var_pop(b) AS cbb,
             covar_pop(a, y) AS cay, covar_pop(b, y) AS cby FROM d),
k AS (SELECT *, (cbb * cay - cab * cby) / (caa * cbb - cab * cab) AS b1, (caa * cby - cab * cay) / (caa * cbb - cab * cab) AS b2 FROM s),
e AS (SELECT l_returnflag, y, my + cby / cbb * (b - mb) AS p1, my + b1 * (a - ma) + b2 * (b - mb) AS p2 FROM d, k),
m AS (SELECT l_returnflag AS segment, avg((y - p1) * (y - p1)) AS mse_discount, avg((y - p2) * (y - p2)) AS mse_both FROM e GROUP BY 1)
SELECT segment, round(mse_discount, 6) AS mse_discount, round(mse_both, 6) AS mse_both,
       round(mse_both - mse_discount, 6) AS mse_change, mse_both < mse_discount AS better FROM m
""")
def compare_runs(spark, sf_dir):
    """Two feature sets fitted one after the other, each run appended to the log, then compared by query."""
    li = Tables(spark, sf_dir).lineitem.withColumn("y", F.col("l_extendedprice") / F.lit(1000.0))
    log = _new("runs")
    for run, features in (("discount", ["l_discount"]), ("both", ["l_quantity", "l_discount"])):
        model = fit_linear(li, features, "y")
        rep = regression_report(model.score(li, "pred"), "y", "pred", ["l_returnflag"])
        append_partitioned(spark, log, rep.select(F.col("l_returnflag").alias("segment"), F.lit(",".join(features)).alias("features"),
                                                  F.col("metric_mse").alias("mse"), F.lit(run).alias("run_id")), ["run_id"])
    both = spark.table(log).groupBy("segment").pivot("run_id", ["discount", "both"]).agg(F.first("mse"))
    r6 = lambda c: F.round(c, 6)
    return both.select("segment", r6(F.col("discount")).alias("mse_discount"), r6(F.col("both")).alias("mse_both"),
                       r6(F.col("both") - F.col("discount")).alias("mse_change"), (F.col("both") < F.col("discount")).alias("better"))
