"""Registered queries: projections, scalar feature transforms, seeded columns, feature functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.geo import haversine
from ..functions.hashing import hash_text, hash_uniform, surrogate_id
from ..operators.lookup import FeatureFunction, FeatureLookup, FeatureSpec
from ..operators.tables import snapshot_expand, split_features
from .registry import Tables, query

SEED = 42

# Passenger-style names built from customer keys: "Automobile, Mrs. Customer 000000004 (BUILDING Smith)".
_TITLES = ["Mr", "Mrs", "Miss", "Master", "Dr"]


def passenger_names(customer):
    title = F.element_at(F.array(*[F.lit(x) for x in _TITLES]), (F.pmod("c_custkey", F.lit(5)) + 1).cast("int"))
    titled = F.when(F.pmod("c_custkey", F.lit(7)) == 0, F.lit("")).otherwise(F.concat(title, F.lit(". ")))
    paren = F.when(F.pmod("c_custkey", F.lit(3)) == 0,
                   F.concat(F.lit(" ("), F.col("c_mktsegment"), F.lit(" Smith)"))).otherwise(F.lit(""))
    name = F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(", "), titled,
                    F.regexp_replace("c_name", "#", " "), paren)
    return customer.select("c_custkey", name.alias("name"))


_NAMES_SQL = """
names AS (
  SELECT c_custkey,
         concat(upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)), ', ',
                CASE WHEN c_custkey % 7 = 0 THEN ''
                     ELSE (['Mr','Mrs','Miss','Master','Dr'])[(c_custkey % 5) + 1] || '. ' END,
                replace(c_name, '#', ' '),
                CASE WHEN c_custkey % 3 = 0 THEN ' (' || c_mktsegment || ' Smith)' ELSE '' END) AS name
  FROM customer)"""


@query("normalize_columns", """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_key_f_k,
       c_acctbal AS acct__bal, c_mktsegment AS mkt_segment__name
FROM customer
""")
def normalize_columns(spark, sf_dir):
    raw = Tables(spark, sf_dir).customer.toDF(
        "CustomerKey", "CustomerName", "NationKey(FK)", "Acct-Bal", "MktSegment Name")
    return C.replace_spaces(C.normalize_columns(raw))


@query("coerce_numeric", """
SELECT c_custkey,
       TRY_CAST(trim(CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN 'n/a'
                          ELSE CAST(c_acctbal AS VARCHAR) END) AS DOUBLE) AS acctbal_num
FROM customer
""")
def coerce_numeric(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    text = (F.when(F.pmod("c_custkey", F.lit(10)) == 0, F.lit(""))
            .when(F.pmod("c_custkey", F.lit(10)) == 1, F.lit("n/a"))
            .otherwise(F.col("c_acctbal").cast("string")))
    return c.select("c_custkey", C.coerce_numeric(text).alias("acctbal_num"))


@query("feature_split", """
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
""")
def feature_split(spark, sf_dir):
    parts = split_features(Tables(spark, sf_dir).customer, "c_custkey",
                           {"demographic": ["c_name", "c_nationkey"],
                            "account": ["c_acctbal", "c_mktsegment"]})
    return parts["account"]


@query("snapshot_expand", """
SELECT c.*, t.ts FROM customer c CROSS JOIN (
  SELECT strptime(s, '%m/%d/%Y') AS ts FROM (VALUES ('12/01/2025'), ('01/01/2026'), ('02/01/2026')) v(s)) t
""")
def snapshot_expand_q(spark, sf_dir):
    return snapshot_expand(Tables(spark, sf_dir).customer, ["12/01/2025", "01/01/2026", "02/01/2026"],
                           ts_col="ts", fmt="MM/dd/yyyy")


@query("name_prefix", f"""
WITH {_NAMES_SQL}
SELECT c_custkey, name, regexp_extract(name, '([A-Za-z]+)\\.', 1) AS name_prefix FROM names
""")
def name_prefix(spark, sf_dir):
    n = passenger_names(Tables(spark, sf_dir).customer)
    return n.withColumn("name_prefix", C.title_prefix("name"))


@query("name_secondary", f"""
WITH {_NAMES_SQL},
x AS (SELECT c_custkey, nullif(regexp_extract(name, '\\(([A-Za-z ]+)\\)', 1), '') AS name_secondary FROM names)
SELECT c_custkey, name_secondary,
       CASE WHEN name_secondary IS NOT NULL THEN '1' ELSE '0' END AS name_multiple
FROM x
""")
def name_secondary(spark, sf_dir):
    n = passenger_names(Tables(spark, sf_dir).customer)
    return (n.select("c_custkey", C.secondary_name("name").alias("name_secondary"))
            .withColumn("name_multiple", C.presence_flag("name_secondary")))


@query("nan_to_null", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS l_discount_clean
FROM lineitem
""")
def nan_to_null(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    raw = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", C.nan_to_null(raw).alias("l_discount_clean"))


@query("derived_mean", """
SELECT l_orderkey, l_linenumber, round((l_tax + l_discount) / 2, 6) AS tax_discount_mean FROM lineitem
""")
def derived_mean(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     F.round(C.mean_of("l_tax", "l_discount"), 6).alias("tax_discount_mean"))


@query("label_map", """
SELECT o_orderkey, o_orderstatus,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS label
FROM orders
""")
def label_map(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", "o_orderstatus", C.label_map("o_orderstatus", {"F": 1, "O": 0}).alias("label"))


@query("surrogate_id", f"""
SELECT CAST(('0x' || substr(md5('{SEED}|' || CAST(c_custkey AS VARCHAR)), 1, 15)) AS BIGINT) AS cust_sid, *
FROM customer
""")
def surrogate_id_q(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select(surrogate_id(SEED, "c_custkey").alias("cust_sid"), *c.columns)


@query("hash_uniform", f"""
SELECT o_orderkey,
       round(10 * CAST(('0x' || substr(md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)
             / 4294967296.0, 6) AS real_time_measurement,
       md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)) AS row_uuid
FROM orders
""")
def hash_uniform_q(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey",
                    F.round(F.lit(10.0) * hash_uniform(SEED, "o_orderkey"), 6).alias("real_time_measurement"),
                    hash_text(SEED, "o_orderkey").alias("row_uuid"))


# Coordinates derived from keys so the distance feature has whole-table inputs.
def supplier_locations(t):
    s = t.supplier
    return s.select(F.col("s_suppkey").alias("destination_id"),
                    (F.pmod(F.col("s_suppkey") * 37, F.lit(180)) - 90 + 0.5).cast("double").alias("latitude"),
                    (F.pmod(F.col("s_suppkey") * 91, F.lit(360)) - 180 + 0.25).cast("double").alias("longitude"),
                    "s_nationkey")


def user_requests(t):
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("destination_id"),
                     (F.pmod(F.col("l_orderkey") * 13, F.lit(180)) - 90).cast("double").alias("user_latitude"),
                     (F.pmod(F.col("l_orderkey") * 29, F.lit(360)) - 180).cast("double").alias("user_longitude"))


_GEO_SQL = """
loc AS (SELECT s_suppkey AS destination_id, CAST((s_suppkey * 37) % 180 - 90 + 0.5 AS DOUBLE) AS latitude,
               CAST((s_suppkey * 91) % 360 - 180 + 0.25 AS DOUBLE) AS longitude, s_nationkey FROM supplier),
req AS (SELECT l_orderkey, l_linenumber, l_suppkey AS destination_id,
               CAST((l_orderkey * 13) % 180 - 90 AS DOUBLE) AS user_latitude,
               CAST((l_orderkey * 29) % 360 - 180 AS DOUBLE) AS user_longitude FROM lineitem),
j AS (SELECT r.*, l.latitude, l.longitude, l.s_nationkey,
             6371.0 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS distance
      FROM req r LEFT JOIN loc l USING (destination_id),
      LATERAL (SELECT pow(sin((radians(r.user_latitude) - radians(l.latitude)) / 2), 2)
                    + cos(radians(l.latitude)) * cos(radians(r.user_latitude))
                    * pow(sin((radians(r.user_longitude) - radians(l.longitude)) / 2), 2) AS a) x)"""


@query("haversine", f"""
WITH {_GEO_SQL}
SELECT l_orderkey, l_linenumber, destination_id, latitude, longitude, user_latitude, user_longitude,
       round(distance, 6) AS distance
FROM j
""")
def haversine_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spec = FeatureSpec([
        FeatureLookup(supplier_locations(t).drop("s_nationkey"), lookup_key="destination_id"),
        FeatureFunction(haversine, "distance", {"latitude": "latitude", "longitude": "longitude",
                                                "user_latitude": "user_latitude",
                                                "user_longitude": "user_longitude"}),
    ])
    df = spec.apply(user_requests(t))
    return df.withColumn("distance", F.round("distance", 6))


@query("feature_spec", f"""
WITH {_GEO_SQL}
SELECT j.l_orderkey, j.l_linenumber, j.destination_id, round(j.distance, 6) AS distance, n.n_name
FROM j LEFT JOIN nation n ON j.s_nationkey = n.n_nationkey
""")
def feature_spec_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spec = FeatureSpec(
        steps=[
            FeatureLookup(supplier_locations(t), lookup_key="destination_id"),
            FeatureFunction(haversine, "distance", {"latitude": "latitude", "longitude": "longitude",
                                                    "user_latitude": "user_latitude",
                                                    "user_longitude": "user_longitude"}),
            FeatureLookup(t.nation.select("n_nationkey", "n_name"), lookup_key="s_nationkey",
                          table_keys="n_nationkey"),
        ],
        exclude_columns=["latitude", "longitude", "user_latitude", "user_longitude", "s_nationkey"])
    return spec.apply(user_requests(t)).withColumn("distance", F.round("distance", 6))
