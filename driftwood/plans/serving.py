"""Registered queries: request payloads, model versions and promotion, run logs, schema contracts,
plain aggregates over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_uniform
from ..operators import payload as PL
from ..operators import registry as R
from ..operators.evaluate import regression_report
from ..operators.models import fit_linear
from .registry import Tables, query

PAYLOAD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
PAYLOAD_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                               T.StructField("o_orderstatus", T.StringType()),
                               T.StructField("o_totalprice", T.DoubleType()),
                               T.StructField("o_orderpriority", T.StringType())])


def _batched(t):
    """Request batches of at most 100 orders (order keys are unique, so the batch size is bounded)."""
    return t.orders.withColumn("batch_id", F.floor(F.col("o_orderkey") / 100).cast("long"))


@query("payload_encode", """
SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS batch_id, count(*) AS n_rows,
       '{"dataframe_split":{"columns":["o_orderkey","o_custkey","o_orderstatus","o_totalprice","o_orderpriority"],"index":['
       || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) || '],"data":['
       || string_agg('[' || CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',"' || o_orderstatus
                     || '",' || CAST(o_totalprice AS VARCHAR) || ',"' || o_orderpriority || '"]', ',' ORDER BY o_orderkey)
       || ']}}' AS request
FROM orders GROUP BY 1
""")
def payload_encode(spark, sf_dir):
    return PL.encode_split(_batched(Tables(spark, sf_dir)), "batch_id", "o_orderkey", PAYLOAD_COLS)


_DECODED_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


@query("payload_split_parse", _DECODED_SQL)
def payload_split_parse(spark, sf_dir):
    log = PL.encode_split(_batched(Tables(spark, sf_dir)), "batch_id", "o_orderkey", PAYLOAD_COLS)
    return PL.decode_split(log, "request", PAYLOAD_SCHEMA).drop("index")


@query("payload_records_parse", _DECODED_SQL)
def payload_records_parse(spark, sf_dir):
    log = PL.encode_records(_batched(Tables(spark, sf_dir)), "batch_id", "o_orderkey", PAYLOAD_COLS)
    return PL.decode_records(log, "request", PAYLOAD_SCHEMA)


@query("payload_inputs_parse", _DECODED_SQL)
def payload_inputs_parse(spark, sf_dir):
    log = PL.encode_inputs(_batched(Tables(spark, sf_dir)), "batch_id", "o_orderkey", PAYLOAD_COLS)
    return PL.decode_inputs(log, "request", PAYLOAD_SCHEMA)


# -- model versions ---------------------------------------------------------------------------

def model_versions(t):
    """One version per (priority, order month): version text = months since 1995-01 + 1,
    score = share of fulfilled orders that month."""
    o = t.orders
    ver = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int")
    return (o.groupBy(F.col("o_orderpriority").alias("name"), ver.alias("v"))
            .agg((F.sum((F.col("o_orderstatus") == "F").cast("long")) / F.count(F.lit(1))).alias("val_auc_score"))
            .select("name", F.col("v").cast("string").alias("version"), "val_auc_score"))


_VERSIONS_SQL = """
vers AS (SELECT o_orderpriority AS name,
                CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS version,
                CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS score
         FROM orders GROUP BY 1, 2)"""


@query("latest_version", f"""
WITH {_VERSIONS_SQL}
SELECT name AS o_orderpriority, max(version) AS latest_version FROM vers GROUP BY name
""")
def latest_version(spark, sf_dir):
    return R.latest_version(model_versions(Tables(spark, sf_dir))).withColumnRenamed("name", "o_orderpriority")


@query("champion_challenger", f"""
WITH {_VERSIONS_SQL},
a AS (SELECT *, row_number() OVER w = 1 OR score >= max(score) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS swap
      FROM vers WINDOW w AS (PARTITION BY name ORDER BY version)),
b AS (SELECT *, last(CASE WHEN swap THEN version END IGNORE NULLS) OVER (PARTITION BY name ORDER BY version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS champ FROM a),
c AS (SELECT *, lag(champ) OVER (PARTITION BY name ORDER BY version) AS old_champ FROM b),
f AS (SELECT name, arg_max(champ, version) AS f_champ, max(version) AS f_last, arg_max(swap, version) AS f_last_swap
      FROM c GROUP BY name),
arch AS (SELECT c.name, c.old_champ AS arch FROM c JOIN f ON c.name = f.name AND c.version = f.f_champ
         WHERE c.swap AND c.old_champ IS NOT NULL),
del AS (SELECT name, old_champ - 1 AS version FROM c WHERE swap AND old_champ IS NOT NULL)
SELECT c.name, c.version, round(c.score, 6) AS score,
       CASE WHEN c.version = f.f_champ THEN 'production' WHEN c.version = arch.arch THEN 'archived'
            WHEN c.version = f.f_last AND NOT f.f_last_swap THEN 'staging' END AS alias,
       EXISTS (SELECT 1 FROM del WHERE del.name = c.name AND del.version = c.version) AS deleted
FROM c JOIN f ON c.name = f.name LEFT JOIN arch ON c.name = arch.name
""")
def champion_challenger(spark, sf_dir):
    p = R.promote(model_versions(Tables(spark, sf_dir)))
    return p.withColumn("score", F.round("score", 6))


@query("runs_pivot", """
WITH d AS (SELECT *, l_extendedprice / 1000.0 AS y FROM lineitem),
s AS (SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(y) AS my,
             covar_pop(l_quantity, l_quantity) AS c11, covar_pop(l_quantity, l_discount) AS c12,
             covar_pop(l_discount, l_discount) AS c22, covar_pop(l_quantity, y) AS c1y,
             covar_pop(l_discount, y) AS c2y FROM d),
k AS (SELECT (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2, m1, m2, my FROM s),
p AS (SELECT l_returnflag, y, my - b1 * m1 - b2 * m2 + b1 * l_quantity + b2 * l_discount AS pred FROM d, k)
SELECT 'run_' || l_returnflag AS run_id, round(avg((y - pred) * (y - pred)), 6) AS metric_mse,
       round(avg(abs(y - pred)), 6) AS metric_mae, round(1 - avg((y - pred) * (y - pred)) / var_pop(y), 6) AS metric_r2,
       'l_quantity,l_discount' AS param_features, 'false' AS tag_autolog, 'true' AS tag_evaluate
FROM p GROUP BY l_returnflag
""")
def runs_pivot(spark, sf_dir):
    """Per-run metrics, parameters and tags logged as long rows, then pivoted back per run."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.withColumn("y", F.col("l_extendedprice") / F.lit(1000.0))
    model = fit_linear(li, ["l_quantity", "l_discount"], "y")
    rep = regression_report(model.score(li, "pred"), "y", "pred", ["l_returnflag"]).withColumn(
        "run_id", F.concat(F.lit("run_"), F.col("l_returnflag")))
    for c in ("metric_mse", "metric_mae", "metric_r2"):
        rep = rep.withColumn(c, F.round(c, 6))
    params = rep.select("run_id", F.lit(",".join(model.features)).alias("param_features"))
    tags = rep.select("run_id", F.lit("false").alias("tag_autolog"), F.lit("true").alias("tag_evaluate"))
    runs = R.runs_long({"metric": (rep, ["metric_mse", "metric_mae", "metric_r2"]),
                        "param": (params, ["param_features"]),
                        "tag": (tags, ["tag_autolog", "tag_evaluate"])}, "run_id")
    keys = ["metric_mse", "metric_mae", "metric_r2", "param_features", "tag_autolog", "tag_evaluate"]
    return R.runs_pivot(runs, keys, metric_keys=keys[:3])


ORDERS_CONTRACT = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
                   "o_orderpriority": "int", "o_comment": "string"}


@query("schema_contract", """
SELECT * FROM (VALUES
  ('o_orderpriority', 'int', 'string', 'type_mismatch',
   (SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL)),
  ('o_comment', 'string', NULL, 'missing', NULL),
  ('o_orderstatus', NULL, 'string', 'extra', NULL),
  ('o_orderdate', NULL, 'timestamp_ntz', 'extra', NULL)
) v(column_name, expected_type, actual_type, status, bad_values)
""")
def schema_contract(spark, sf_dir):
    return R.schema_contract(Tables(spark, sf_dir).orders, ORDERS_CONTRACT)


# -- plain aggregates ---------------------------------------------------------------------------

@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, sf_dir):
    return Tables(spark, sf_dir).events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("group_centers", """
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(avg(CAST(v AS DOUBLE)), 6) AS center
FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY label, i
""")
def group_centers(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    x = e.select("label", F.posexplode("embedding").alias("dim", "v"))
    return x.groupBy("label", "dim").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("center"))


@query("distinct_labels", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_labels(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("user_id", "event_type").distinct()


@query("topk_sample", """
SELECT o_orderkey, o_totalprice,
       round(CAST(('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0, 6) AS u
FROM orders
ORDER BY CAST(('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT), o_orderkey
LIMIT 10
""")
def topk_sample(spark, sf_dir):
    """Seeded sample of n rows: order by a hash uniform and keep n (per-partition top-n, then merge)."""
    o = Tables(spark, sf_dir).orders
    u = hash_uniform(7, "o_orderkey")
    return (o.select("o_orderkey", "o_totalprice", u.alias("uu"))
            .orderBy("uu", "o_orderkey").limit(10)
            .select("o_orderkey", "o_totalprice", F.round("uu", 6).alias("u")))
