"""Registered queries: raw and stored inputs, encoders without a driver vocabulary, ids, strict scoring, tree attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import models as M
from ..operators import payload as PL
from ..operators import prep as P
from ..operators import trees as TR
from ..session import new_table_path
from ..sources.tables import read_csv, read_csv_permissive, schema_from_pairs, write_csv
from .modeling import _GOLS_SQL, _grouped_models, _li_y, OLS_FEATURES
from .registry import Tables, query
from .serving import PAYLOAD_COLS, PAYLOAD_SCHEMA, _batched


def _r6(c):
    return F.round(c, 6)


@query("csv_inferred", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, sf_dir):
    """A semicolon CSV read back with inferred types."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    d = read_csv(spark, write_csv(c, new_table_path(spark, "customer_semicolon"), sep=";"), sep=";")
    assert dict(d.dtypes)["c_acctbal"] == "double"
    return d.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("csv_permissive", """
SELECT CASE WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'corrupt' ELSE 'read' END AS status, count(*) AS n,
       round(sum(CASE WHEN o_orderpriority LIKE '%MEDIUM%' THEN NULL ELSE o_totalprice END), 2) AS total
FROM orders GROUP BY 1
""")
def csv_permissive(spark, sf_dir):
    """Orders whose price field holds text (those of one priority) are kept as corrupt lines, all others are read."""
    o = Tables(spark, sf_dir).orders
    price = F.when(F.col("o_orderpriority").contains("MEDIUM"), F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    path = write_csv(o.select("o_orderkey", price.alias("o_totalprice")), new_table_path(spark, "orders_raw"), sep=";")
    d = read_csv_permissive(spark, path, schema_from_pairs([("o_orderkey", "long"), ("o_totalprice", "double")]), sep=";")
    status = F.when(F.col("_corrupt_record").isNotNull(), "corrupt").otherwise("read")
    return d.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("payload_log", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(3 AS BIGINT) AS malformed_requests FROM orders
""")
def payload_log(spark, sf_dir):
    """Requests logged to storage, one a line, three of them cut off; read back as VARIANT."""
    sent = PL.encode_split(_batched(Tables(spark, sf_dir)), "batch_id", "o_orderkey", PAYLOAD_COLS)
    cut = sent.orderBy("batch_id").limit(3).select(F.expr("substring(request, 1, length(request) - 9)").alias("value"))
    path = new_table_path(spark, "request_log")
    sent.select(F.col("request").alias("value")).unionByName(cut).write.text(path)
    log = PL.read_log(spark, path)
    bad = PL.malformed(log).agg(F.count(F.lit(1)).alias("malformed_requests"))
    return PL.decode_log(log, PAYLOAD_SCHEMA).crossJoin(F.broadcast(bad))


@query("metrics_csv", """
SELECT o_custkey, count(*) AS n, CASE WHEN o_custkey % 3 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN NULL ELSE 'x, "y"' END AS note,
       max(o_totalprice) AS top, min(o_orderpriority) AS first_priority
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""")
def metrics_csv(spark, sf_dir):
    """Metrics with an array column, empty and NULL text written as CSV and read back unchanged."""
    k = F.col("o_custkey") % 3
    m = (Tables(spark, sf_dir).orders.where("o_custkey is not null").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"), F.array(F.min("o_orderpriority"), F.lit("-")).alias("priorities"))
         .withColumn("note", F.when(k == 0, "").when(k == 2, 'x, "y"')))
    path = write_csv(m, new_table_path(spark, "metrics_csv"), null_value="\\N")
    kinds = schema_from_pairs([("o_custkey", "long"), ("n", "long"), ("top", "double"), ("priorities", "string"), ("note", "string")])
    d = read_csv(spark, path, kinds, null_value="\\N")
    return d.select("o_custkey", "n", "note", "top", F.from_json("priorities", "array<string>")[0].alias("first_priority"))


@query("rename_spaces", """
SELECT c_custkey AS "customer_key", c_name AS "customer__name", c_acctbal AS acctbal FROM customer
""")
def rename_spaces(spark, sf_dir):
    raw = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal").toDF("customer key", "customer  name", "acctbal")
    return C.replace_spaces(raw)


@query("unmapped_labels", """
SELECT o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1
""")
def unmapped_labels(spark, sf_dir):
    return C.unmapped(Tables(spark, sf_dir).orders, "o_orderstatus", {"F": 1, "O": 0})


@query("dense_ids", """
SELECT CAST(row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) - 1 AS BIGINT) AS row_id, * FROM customer
""")
def dense_ids(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return P.number_rows(c, ["c_custkey"], "row_id").select("row_id", *c.columns)


_SPARSE_SQL = """
v AS (SELECT user_id, row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id) - 1 AS i
      FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events WHERE event_type = 'purchase'))"""


@query("one_hot_sparse", f"""
WITH {_SPARSE_SQL}
SELECT e.event_id, CAST(v.i AS BIGINT) AS user_index, CASE WHEN v.i IS NULL THEN 0 ELSE 1 END AS n_set
FROM events e LEFT JOIN v ON v.user_id = CAST(e.user_id AS VARCHAR)
""")
def one_hot_sparse(spark, sf_dir):
    """Users seen in purchases are the vocabulary; events of other users get an empty vector."""
    e = Tables(spark, sf_dir).events.select("event_id", "event_type", F.col("user_id").cast("string").alias("user"))
    d = P.one_hot_sparse(e, "user", P.vocabulary(e.where("event_type = 'purchase'"), "user"))
    return d.select("event_id", F.get("user_vector.indices", F.lit(0)).alias("user_index"), F.size("user_vector.values").alias("n_set"))


@query("grouped_predict_strict", f"""
WITH {_GOLS_SQL}
SELECT l_orderkey, l_linenumber, d.l_suppkey, round(b0 + b1 * l_quantity + b2 * l_discount, 6) AS prediction
FROM d JOIN g ON g.l_suppkey = d.l_suppkey
""")
def grouped_predict_strict(spark, sf_dir):
    """As grouped_predict, but a line without a model or without a feature would stop the job."""
    t = Tables(spark, sf_dir)
    rows = _li_y(t).select("l_orderkey", "l_linenumber", "l_suppkey", *OLS_FEATURES)
    s = M.score_grouped(rows, _grouped_models(t), ["l_suppkey"], OLS_FEATURES, strict=True)
    return s.select("l_orderkey", "l_linenumber", "l_suppkey", _r6("prediction").alias("prediction"))


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
TREE_SPLITS = [[("l_quantity", 25.0), ("l_discount", 0.055), ("l_tax", 0.035)], [("l_tax", 0.055), ("l_quantity", 12.0), ("l_quantity", 38.0)]]


def _contribution_sql() -> str:
    """Shapley values by the definition: for each tree the value of all eight sets of known features in each of its cells."""
    weight = {0: "1.0/3", 1: "1.0/6", 2: "1.0/3"}
    parts = []
    for t, splits in enumerate(TREE_SPLITS):
        bits = ", ".join(f"CAST({f} > {c} AS INTEGER) AS b{i}" for i, (f, c) in enumerate(splits))
        known = lambda s, i: f"CASE WHEN l.b{i} = x.b{i} THEN 1.0 ELSE 0.0 END" if splits[i][0] in s else f"l.p{i}"  # noqa: B023, E731
        subsets = [[f for k, f in enumerate(TREE_FEATURES) if m >> k & 1] for m in range(8)]
        values = ", ".join(f"sum(l.v * {known(s, 0)} * {known(s, 1)} * {known(s, 2)}) AS s{m}" for m, s in enumerate(subsets))
        phi = ", ".join(
            " + ".join(f"{weight[len(s)]} * (s{m | 1 << k} - s{m})" for m, s in enumerate(subsets) if not m >> k & 1) + f" AS phi{k}"
            for k in range(3))
        parts.append(f"""
c{t} AS (SELECT l_orderkey, l_linenumber, y, {bits} FROM d),
n{t} AS (SELECT b0, b1, b2, avg(y) AS v, count(*) AS n FROM c{t} GROUP BY 1, 2, 3),
l{t} AS (SELECT b0, b1, b2, v, sum(n) OVER (PARTITION BY b0) / sum(n) OVER () AS p0,
                sum(n) OVER (PARTITION BY b0, b1) / sum(n) OVER (PARTITION BY b0) AS p1, n / sum(n) OVER (PARTITION BY b0, b1) AS p2 FROM n{t}),
v{t} AS (SELECT x.b0, x.b1, x.b2, {values} FROM n{t} x, l{t} l GROUP BY 1, 2, 3),
f{t} AS (SELECT b0, b1, b2, s0, s7, {phi} FROM v{t}),
r{t} AS (SELECT c.l_orderkey, c.l_linenumber, c.y, f.s0, f.s7, f.phi0, f.phi1, f.phi2 FROM c{t} c JOIN f{t} f USING (b0, b1, b2))""")
    total = ",\n       ".join(f"round((r0.{c} + r1.{c}) / 2, 6) AS {n}" for c, n in
                              [("s0", "base"), ("phi0", "attr_l_quantity"), ("phi1", "attr_l_discount"), ("phi2", "attr_l_tax"), ("s7", "prediction")])
    return f"""WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice / 1000.0 AS y FROM lineitem),{",".join(parts)}
SELECT r0.l_orderkey, r0.l_linenumber, {total}
FROM r0 JOIN r1 ON r0.l_orderkey = r1.l_orderkey AND r0.l_linenumber = r1.l_linenumber AND r0.y = r1.y"""


@query("tree_attribution", _contribution_sql())
def tree_attribution(spark, sf_dir):
    """Exact Shapley values of a forest of two depth-3 trees, one of which asks a feature twice; base and values add up."""
    li = _li_y(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "y", *TREE_FEATURES)
    trees = [TR.fit_fixed_tree(li, s, TREE_FEATURES, "y", i) for i, s in enumerate(TREE_SPLITS)]
    nodes = trees[0].unionByName(trees[1]).withColumn("value", F.col("value") / len(trees))
    d = TR.tree_attribution(li, nodes, TREE_FEATURES)
    attrs = [f"attr_{f}" for f in TREE_FEATURES]
    total = F.col("attr_base") + sum((F.col(a) for a in attrs[1:]), F.col(attrs[0]))
    return d.select("l_orderkey", "l_linenumber", _r6("attr_base").alias("base"), *[_r6(a).alias(a) for a in attrs], _r6(total).alias("prediction"))
