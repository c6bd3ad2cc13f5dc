"""Registered queries: lookups, point-in-time joins, training sets (driver tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..operators.lookup import FeatureLookup, create_training_set
from .registry import Tables, query


def _clicks(t):
    return t.events.where(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value")


def _typed(t, kind: str):
    return t.events.where(F.col("event_type") == kind)


@query("asof_lookup", """
SELECT c.event_id, c.user_id, c.ts, c.value, p.purchase_value, p.purchase_id
FROM (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT user_id, ts, value AS purchase_value, event_id AS purchase_id
                FROM events WHERE event_type = 'purchase') p
ON c.user_id = p.user_id AND c.ts >= p.ts
""")
def asof_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    purchases = _typed(t, "purchase").select(
        "user_id", "ts", F.col("value").alias("purchase_value"), F.col("event_id").alias("purchase_id"))
    return asof_join(_clicks(t), purchases, "user_id", "user_id", "ts", "ts")


@query("pit_training_set", """
WITH spine AS (
  SELECT event_id, user_id, ts, CAST(value >= 25 AS INTEGER) AS label
  FROM events WHERE event_type = 'click'),
p AS (SELECT user_id, ts, value AS last_purchase_value, event_id AS last_purchase_id
      FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, value AS last_view_value FROM events WHERE event_type = 'view'),
a AS (SELECT s.*, p.last_purchase_value, p.last_purchase_id FROM spine s
      ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.ts >= p.ts)
SELECT a.event_id, a.user_id, a.ts, a.last_purchase_value, a.last_purchase_id,
       v.last_view_value, a.label
FROM a ASOF LEFT JOIN v ON a.user_id = v.user_id AND a.ts >= v.ts
""")
def pit_training_set(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spine = _clicks(t).select("event_id", "user_id", "ts",
                              (F.col("value") >= 25).cast("int").alias("label"))
    lookups = [
        FeatureLookup(_typed(t, "purchase").select("user_id", "ts", "value", "event_id"),
                      lookup_key="user_id", timestamp_key="ts", timestamp_lookup_key="ts",
                      rename={"value": "last_purchase_value", "event_id": "last_purchase_id"}),
        FeatureLookup(_typed(t, "view").select("user_id", "ts", "value"),
                      lookup_key="user_id", timestamp_key="ts", timestamp_lookup_key="ts",
                      rename={"value": "last_view_value"}),
    ]
    df, _ = create_training_set(spine, lookups, label="label")
    return df


@query("feature_lookup", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_acctbal, c.c_mktsegment, c.c_nationkey,
       n.n_name, n.n_regionkey, r.r_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def feature_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spine = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lookups = [
        FeatureLookup(t.customer, lookup_key="o_custkey", table_keys="c_custkey",
                      feature_names=["c_acctbal", "c_mktsegment", "c_nationkey"]),
        FeatureLookup(t.nation, lookup_key="c_nationkey", table_keys="n_nationkey"),
        FeatureLookup(t.region, lookup_key="n_regionkey", table_keys="r_regionkey"),
    ]
    df, _ = create_training_set(spine, lookups)
    return df


@query("training_set", """
SELECT o.o_orderkey, o.o_totalprice, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       CAST(o.o_orderstatus = 'F' AS INTEGER) AS label
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def training_set(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spine = t.orders.select("o_orderkey", "o_custkey", "o_totalprice",
                            (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    df, _ = create_training_set(
        spine, [FeatureLookup(t.customer, lookup_key="o_custkey", table_keys="c_custkey")],
        label="label", exclude_columns=["o_custkey", "c_name"])
    return df


ASOF_CHOICES = ["2025-12-01 00:00:00", "2026-01-01 00:00:00", "2026-02-01 00:00:00"]


@query("assign_asof", """
SELECT doc_id, quality,
       (['2025-12-01 00:00:00'::TIMESTAMP, '2026-01-01 00:00:00'::TIMESTAMP, '2026-02-01 00:00:00'::TIMESTAMP])[
         CAST(floor(CAST(('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
                    / 4294967296.0 * 3) AS INTEGER) + 1] AS as_of_ts
FROM labels
""")
def assign_asof(spark, sf_dir):
    """Seeded per-key choice among fixed as-of times (no positional concat with a random list)."""
    from ..functions.hashing import hash_bucket
    t = Tables(spark, sf_dir)
    choices = F.array(*[F.to_timestamp_ntz(F.lit(s)) for s in ASOF_CHOICES])
    return t.labels.select("doc_id", "quality",
                           F.element_at(choices, hash_bucket(42, len(ASOF_CHOICES), "doc_id") + 1).alias("as_of_ts"))
