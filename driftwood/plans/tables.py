"""Registered queries: key checks, merge upsert, change feed, feature-table round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.tables import change_feed, merge_frames, primary_key_violations
from ..session import new_table_path
from ..sources.feature_store import FeatureStore
from ..sources.tables import read_csv, schema_from_pairs, write_csv
from .registry import Tables, query


def customer_updates(t):
    """BUILDING customers get a new balance (explicit NULL for nation 0); suppliers are new keys."""
    c = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 0, F.col("c_acctbal") + F.lit(100.0)).alias("c_acctbal"),
        "c_mktsegment")
    s = t.supplier.select((F.col("s_suppkey") + F.lit(1000000000)).alias("c_custkey"),
                          F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"))
    return c.unionByName(s)


_MERGE_SQL = """
u AS (
  SELECT c_custkey, CASE WHEN c_nationkey <> 0 THEN c_acctbal + 100.0 END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT s_suppkey + 1000000000, s_acctbal, 'SUPPLIER' FROM supplier),
m AS (
  SELECT CASE WHEN u.c_custkey IS NOT NULL THEN u.c_custkey ELSE t.c_custkey END AS c_custkey,
         t.c_name, t.c_nationkey,
         CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
         CASE WHEN u.c_custkey IS NOT NULL THEN u.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
  FROM customer t FULL OUTER JOIN u ON t.c_custkey = u.c_custkey)"""


@query("merge_upsert", f"WITH {_MERGE_SQL} SELECT * FROM m")
def merge_upsert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge_frames(t.customer, customer_updates(t), "c_custkey")


@query("read_merged", f"WITH {_MERGE_SQL} SELECT * FROM m")
def read_merged(spark, sf_dir):
    """Register a keyed feature table, merge the updates into it, read the current version."""
    t = Tables(spark, sf_dir)
    fs = FeatureStore(spark)
    name = f"customer_features_{uuid.uuid4().hex[:8]}"
    fs.create_table(name, primary_keys="c_custkey", df=t.customer, description="customer balance features")
    fs.write_table(name, customer_updates(t), mode="merge")
    return fs.read_table(name)


@query("merge_add_columns", """
WITH u AS (
  SELECT p_partkey, regexp_extract(p_name, '^([a-z]+) ', 1) AS p_name_prefix,
         CASE WHEN p_size >= 40 THEN 'large' ELSE 'medium' END AS p_size_band
  FROM part WHERE p_size > 25)
SELECT t.*, u.p_name_prefix, u.p_size_band FROM part t LEFT JOIN u USING (p_partkey)
""")
def merge_add_columns(spark, sf_dir):
    t = Tables(spark, sf_dir)
    upd = t.part.where(F.col("p_size") > 25).select(
        "p_partkey", F.regexp_extract("p_name", r"^([a-z]+) ", 1).alias("p_name_prefix"),
        F.when(F.col("p_size") >= 40, "large").otherwise("medium").alias("p_size_band"))
    return merge_frames(t.part, upd, "p_partkey")


@query("change_feed", f"""
WITH {_MERGE_SQL},
a AS (SELECT * FROM m WHERE c_nationkey IS NULL OR c_nationkey <> 24)
SELECT b.*, 'delete' AS _change_type FROM customer b WHERE b.c_custkey NOT IN (SELECT c_custkey FROM a)
UNION ALL
SELECT a.*, 'insert' FROM a WHERE a.c_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT b.*, 'update_preimage' FROM customer b JOIN a ON b.c_custkey = a.c_custkey
WHERE (b.c_name, b.c_nationkey, b.c_acctbal, b.c_mktsegment)
      IS DISTINCT FROM (a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment)
UNION ALL
SELECT a.*, 'update_postimage' FROM customer b JOIN a ON b.c_custkey = a.c_custkey
WHERE (b.c_name, b.c_nationkey, b.c_acctbal, b.c_mktsegment)
      IS DISTINCT FROM (a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment)
""")
def change_feed_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    after = (merge_frames(t.customer, customer_updates(t), "c_custkey")
             .where(F.col("c_nationkey").isNull() | (F.col("c_nationkey") != 24)))
    return change_feed(t.customer, after, "c_custkey")


@query("primary_key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def primary_key_check(spark, sf_dir):
    return primary_key_violations(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    """Write customer as CSV to shared storage, read back with declared types (no inference)."""
    c = Tables(spark, sf_dir).customer
    path = write_csv(c, new_table_path(spark, "customer_csv"))
    schema = schema_from_pairs([("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "int"),
                                ("c_acctbal", "double"), ("c_mktsegment", "string")])
    return read_csv(spark, path, schema=schema)
