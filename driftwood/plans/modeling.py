"""Registered queries: splits, imputation, scaling, encoding, evaluation, linear and grouped models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import models as M
from ..operators import prep as P
from .registry import Tables, query

SEED = 42
OLS_FEATURES = ["l_quantity", "l_discount"]


def _li_y(t):
    """lineitem with the regression target in thousands (keeps sums well inside double precision)."""
    return t.lineitem.withColumn("y", F.col("l_extendedprice") / F.lit(1000.0))


def _r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


@query("stratified_split", f"""
WITH x AS (SELECT o_orderkey, o_orderstatus, md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)) AS h FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM x)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split
FROM r
""")
def stratified_split(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    return P.stratified_split(o, "o_orderstatus", "o_orderkey", 0.2, SEED)


@query("random_split", f"""
SELECT o_orderkey,
       CASE WHEN CAST(('0x' || substr(md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)
                 / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def random_split(spark, sf_dir):
    return P.random_split(Tables(spark, sf_dir).orders.select("o_orderkey"), "o_orderkey", 0.2, SEED)


def _customer_holes(t):
    """customer with deterministic gaps so imputation has work to do."""
    c = t.customer
    return c.select(
        "c_custkey",
        F.when(F.pmod("c_custkey", F.lit(10)) != 0, F.col("c_acctbal")).alias("acctbal"),
        F.when(F.pmod("c_custkey", F.lit(7)) != 0, F.col("c_nationkey").cast("double")).alias("nation_num"),
        F.when(F.pmod("c_custkey", F.lit(10)) != 3, F.col("c_mktsegment")).alias("segment"),
        F.when(F.pmod("c_custkey", F.lit(9)) != 0, F.col("c_nationkey").cast("string")).alias("nation_txt"))


_HOLES_SQL = """
h AS (SELECT c_custkey,
             CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS acctbal,
             CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS nation_num,
             CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END AS segment,
             CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation_txt
      FROM customer)"""


@query("impute_median", f"""
WITH {_HOLES_SQL},
m AS (SELECT quantile_cont(acctbal, 0.5) AS ma, quantile_cont(nation_num, 0.5) AS mn FROM h)
SELECT c_custkey, round(coalesce(acctbal, ma), 6) AS acctbal, round(coalesce(nation_num, mn), 6) AS nation_num
FROM h, m
""")
def impute_median(spark, sf_dir):
    h = _customer_holes(Tables(spark, sf_dir)).select("c_custkey", "acctbal", "nation_num")
    out = P.impute(h, P.median_values(h, ["acctbal", "nation_num"]), ["acctbal", "nation_num"])
    return out.select("c_custkey", _r6("acctbal").alias("acctbal"), _r6("nation_num").alias("nation_num"))


@query("impute_mode", f"""
WITH {_HOLES_SQL},
cs AS (SELECT segment AS v, count(*) AS c FROM h WHERE segment IS NOT NULL GROUP BY 1),
cn AS (SELECT nation_txt AS v, count(*) AS c FROM h WHERE nation_txt IS NOT NULL GROUP BY 1),
ms AS (SELECT min(v) AS v FROM cs WHERE c = (SELECT max(c) FROM cs)),
mn AS (SELECT min(v) AS v FROM cn WHERE c = (SELECT max(c) FROM cn))
SELECT c_custkey, coalesce(segment, (SELECT v FROM ms)) AS segment,
       coalesce(nation_txt, (SELECT v FROM mn)) AS nation_txt
FROM h
""")
def impute_mode(spark, sf_dir):
    h = _customer_holes(Tables(spark, sf_dir)).select("c_custkey", "segment", "nation_txt")
    return P.impute(h, P.mode_values(h, ["segment", "nation_txt"]), ["segment", "nation_txt"])


@query("standard_scale", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / 1000.0 AS y FROM lineitem),
s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(y) AS my, stddev_pop(y) AS sy FROM d)
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / CASE WHEN sq = 0 THEN 1.0 ELSE sq END, 6) AS l_quantity,
       round((y - my) / CASE WHEN sy = 0 THEN 1.0 ELSE sy END, 6) AS y
FROM d, s
""")
def standard_scale(spark, sf_dir):
    d = _li_y(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_quantity", "y")
    out = P.standard_scale(d, P.scaler_stats(d, ["l_quantity", "y"]), ["l_quantity", "y"])
    return out.select("l_orderkey", "l_linenumber", _r6("l_quantity").alias("l_quantity"), _r6("y").alias("y"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_ONE_HOT_SQL = ",\n".join(f"coalesce(CAST(segment = '{s}' AS INTEGER), 0) AS segment_{s}" for s in _SEGMENTS)


@query("one_hot", f"""
WITH {_HOLES_SQL}
SELECT c_custkey, {_ONE_HOT_SQL} FROM h
""")
def one_hot(spark, sf_dir):
    h = _customer_holes(Tables(spark, sf_dir)).select("c_custkey", "segment")
    return P.one_hot(h, "segment", P.fit_vocabulary(h, "segment"))


@query("preprocess_rows", f"""
WITH {_HOLES_SQL},
m AS (SELECT quantile_cont(acctbal, 0.5) AS ma, quantile_cont(nation_num, 0.5) AS mn FROM h),
i AS (SELECT c_custkey, coalesce(acctbal, ma) AS acctbal, coalesce(nation_num, mn) AS nation_num, segment FROM h, m),
s AS (SELECT avg(acctbal) AS a1, stddev_pop(acctbal) AS s1, avg(nation_num) AS a2, stddev_pop(nation_num) AS s2 FROM i),
cs AS (SELECT segment AS v, count(*) AS c FROM h WHERE segment IS NOT NULL GROUP BY 1),
ms AS (SELECT min(v) AS v FROM cs WHERE c = (SELECT max(c) FROM cs)),
f AS (SELECT c_custkey, round((acctbal - a1) / CASE WHEN s1 = 0 THEN 1.0 ELSE s1 END, 6) AS acctbal,
             round((nation_num - a2) / CASE WHEN s2 = 0 THEN 1.0 ELSE s2 END, 6) AS nation_num,
             coalesce(segment, (SELECT v FROM ms)) AS segment FROM i, s)
SELECT c_custkey, acctbal, nation_num, {_ONE_HOT_SQL} FROM f
""")
def preprocess_rows(spark, sf_dir):
    h = _customer_holes(Tables(spark, sf_dir)).select("c_custkey", "acctbal", "nation_num", "segment")
    pre = P.fit_preprocessor(h, ["acctbal", "nation_num"], ["segment"])
    out = pre.transform(h)
    return out.withColumn("acctbal", _r6("acctbal")).withColumn("nation_num", _r6("nation_num"))


# -- evaluation -------------------------------------------------------------------------------

_CLS_SQL = """
d AS (SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS s,
             CAST(l_discount >= 0.05 AS INTEGER) AS p,
             least(greatest(l_discount * 10, 1e-15), 1 - 1e-15) AS pr
      FROM lineitem)"""


@query("roc_auc", f"""
WITH {_CLS_SQL},
r AS (SELECT l_linestatus, y,
             CAST(rank() OVER (PARTITION BY l_linestatus ORDER BY s) AS DOUBLE)
             + (CAST(count(*) OVER (PARTITION BY l_linestatus, s) AS DOUBLE) - 1) / 2e0 AS mr
      FROM d),
a AS (SELECT l_linestatus, sum(mr) FILTER (WHERE y = 1) AS rp, CAST(sum(y) AS DOUBLE) AS np,
             CAST(count(*) - sum(y) AS DOUBLE) AS nn FROM r GROUP BY l_linestatus)
SELECT l_linestatus, round((rp - np * (np + 1) / 2e0) / (np * nn), 6) AS auc FROM a
""")
def roc_auc(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    d = li.select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                  F.col("l_discount").alias("s"))
    return EV.roc_auc(d, "y", "s", ["l_linestatus"]).select("l_linestatus", _r6("auc").alias("auc"))


def _cls_frame(t):
    li = t.lineitem
    return li.select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("p"),
                     (F.col("l_discount") * 10).alias("pr"))


@query("classifier_report", f"""
WITH {_CLS_SQL},
a AS (SELECT l_linestatus, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND p = 1) AS fp,
             count(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn, count(*) FILTER (WHERE y = 1 AND p <> 1) AS fn,
             avg(-(y * ln(pr) + (1 - y) * ln(1.0 - pr))) AS ll
      FROM d GROUP BY l_linestatus),
b AS (SELECT *, CAST(tp AS DOUBLE) AS dtp, CAST(fp AS DOUBLE) AS dfp, CAST(tn AS DOUBLE) AS dtn, CAST(fn AS DOUBLE) AS dfn FROM a),
c AS (SELECT *, CASE WHEN dtp + dfp > 0 THEN dtp / (dtp + dfp) ELSE 0.0 END AS prec,
             CASE WHEN dtp + dfn > 0 THEN dtp / (dtp + dfn) ELSE 0.0 END AS rec FROM b)
SELECT l_linestatus, tp AS val_true_positives, fp AS val_false_positives, tn AS val_true_negatives,
       fn AS val_false_negatives, round((dtp + dtn) / (dtp + dfp + dtn + dfn), 6) AS val_accuracy_score,
       round(prec, 6) AS val_precision_score, round(rec, 6) AS val_recall_score,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS val_f1_score,
       round(ll, 6) AS val_log_loss
FROM c
""")
def classifier_report(spark, sf_dir):
    r = EV.classifier_report(_cls_frame(Tables(spark, sf_dir)), "y", "p", "pr", group_cols=["l_linestatus"])
    return r.select(*[(_r6(c).alias(c) if r.schema[c].dataType.typeName() == "double" else F.col(c))
                      for c in r.columns])


@query("confusion_matrix", f"""
WITH {_CLS_SQL}
SELECT y AS label, p AS prediction, count(*) AS n FROM d GROUP BY y, p
""")
def confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_cls_frame(Tables(spark, sf_dir)), "y", "p")


# -- linear models ----------------------------------------------------------------------------

_OLS_SQL = """
d AS (SELECT *, l_extendedprice / 1000.0 AS y FROM lineitem),
s AS (SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(y) AS my,
             covar_pop(l_quantity, l_quantity) AS c11, covar_pop(l_quantity, l_discount) AS c12,
             covar_pop(l_discount, l_discount) AS c22, covar_pop(l_quantity, y) AS c1y,
             covar_pop(l_discount, y) AS c2y FROM d),
k AS (SELECT (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2, m1, m2, my FROM s),
mdl AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0, m1, m2 FROM k)"""

_GOLS_SQL = """
d AS (SELECT *, l_extendedprice / 1000.0 AS y FROM lineitem),
s AS (SELECT l_suppkey, count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(y) AS my, var_pop(y) AS vy,
             covar_pop(l_quantity, l_quantity) AS c11, covar_pop(l_quantity, l_discount) AS c12,
             covar_pop(l_discount, l_discount) AS c22, covar_pop(l_quantity, y) AS c1y,
             covar_pop(l_discount, y) AS c2y FROM d GROUP BY l_suppkey),
k AS (SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2 FROM s),
g AS (SELECT l_suppkey, n, b1, b2, my - b1 * m1 - b2 * m2 AS b0,
             greatest(vy - (b1 * c1y + b2 * c2y), 0) AS mse, vy FROM k)"""


def _global_model(t):
    return M.fit_linear(_li_y(t), OLS_FEATURES, "y")


@query("score_linear", f"""
WITH {_OLS_SQL}
SELECT l_orderkey, l_linenumber, round(b0 + b1 * l_quantity + b2 * l_discount, 6) AS prediction FROM d, mdl
""")
def score_linear(spark, sf_dir):
    t = Tables(spark, sf_dir)
    model = _global_model(t)
    li = _li_y(t)
    # model as a column function over a struct of every column; id and label fields are ignored
    scored = li.withColumn("prediction", model.score_struct(F.struct(*[F.col(c) for c in li.columns])))
    return scored.select("l_orderkey", "l_linenumber", _r6("prediction").alias("prediction"))


@query("regression_report", f"""
WITH {_OLS_SQL},
p AS (SELECT l_returnflag, y, b0 + b1 * l_quantity + b2 * l_discount AS pred FROM d, mdl)
SELECT l_returnflag, round(avg((y - pred) * (y - pred)), 6) AS metric_mse,
       round(sqrt(avg((y - pred) * (y - pred))), 6) AS metric_rmse, round(avg(abs(y - pred)), 6) AS metric_mae,
       round(1 - avg((y - pred) * (y - pred)) / var_pop(y), 6) AS metric_r2, count(*) AS n
FROM p GROUP BY l_returnflag
""")
def regression_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    scored = _global_model(t).score(_li_y(t), "pred")
    r = EV.regression_report(scored, "y", "pred", ["l_returnflag"])
    return r.select("l_returnflag", *[_r6(c).alias(c) for c in r.columns if c.startswith("metric_")], "n")


@query("linear_attribution", f"""
WITH {_OLS_SQL}
SELECT l_orderkey, l_linenumber, round(b1 * (l_quantity - m1), 6) AS attr_l_quantity,
       round(b2 * (l_discount - m2), 6) AS attr_l_discount
FROM d, mdl
""")
def linear_attribution(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = _li_y(t)
    model = _global_model(t)
    means = li.agg(*[F.avg(f).alias(f) for f in OLS_FEATURES]).first().asDict()
    out = M.linear_attribution(li, model, means)
    return out.select("l_orderkey", "l_linenumber", *[_r6(f"attr_{f}").alias(f"attr_{f}") for f in OLS_FEATURES])


def _grouped_models(t):
    return M.fit_grouped_ols(_li_y(t), ["l_suppkey"], OLS_FEATURES, "y")


@query("grouped_ols", f"""
WITH {_GOLS_SQL}
SELECT l_suppkey, round(b0, 6) AS intercept, round(b1, 6) AS coef_l_quantity, round(b2, 6) AS coef_l_discount,
       n, round(mse, 6) AS metric_mse, round(sqrt(mse), 6) AS metric_rmse, round(1 - mse / vy, 6) AS metric_r2
FROM g
""")
def grouped_ols(spark, sf_dir):
    m = _grouped_models(Tables(spark, sf_dir))
    return m.select("l_suppkey", _r6("intercept").alias("intercept"),
                    _r6(F.col("coef")[0]).alias("coef_l_quantity"), _r6(F.col("coef")[1]).alias("coef_l_discount"),
                    "n", _r6("metric_mse").alias("metric_mse"), _r6("metric_rmse").alias("metric_rmse"),
                    _r6("metric_r2").alias("metric_r2"))


_GMETRICS_SQL = f"""
{_GOLS_SQL},
p AS (SELECT d.l_suppkey, d.y, g.b0 + g.b1 * d.l_quantity + g.b2 * d.l_discount AS pred FROM d JOIN g USING (l_suppkey)),
r AS (SELECT l_suppkey, avg((y - pred) * (y - pred)) AS mse, avg(abs(y - pred)) AS mae, var_pop(y) AS vy, count(*) AS n
      FROM p GROUP BY l_suppkey)"""


@query("grouped_ols_metrics", f"""
WITH {_GMETRICS_SQL}
SELECT l_suppkey, round(mse, 6) AS metric_mse, round(sqrt(mse), 6) AS metric_rmse, round(mae, 6) AS metric_mae,
       round(1 - mse / vy, 6) AS metric_r2, n
FROM r
""")
def grouped_ols_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = M.grouped_ols_metrics(_li_y(t), _grouped_models(t), ["l_suppkey"], OLS_FEATURES, "y")
    return r.select("l_suppkey", *[_r6(c).alias(c) for c in r.columns if c.startswith("metric_")], "n")


@query("avg_model_metrics", f"""
WITH {_GMETRICS_SQL}
SELECT round(avg(mse), 6) AS metric_mse, round(avg(sqrt(mse)), 6) AS metric_rmse, round(avg(mae), 6) AS metric_mae,
       round(avg(1 - mse / vy), 6) AS metric_r2, count(*) AS n_models
FROM r
""")
def avg_model_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = M.grouped_ols_metrics(_li_y(t), _grouped_models(t), ["l_suppkey"], OLS_FEATURES, "y")
    return r.agg(*[_r6(F.avg(c)).alias(c) for c in ("metric_mse", "metric_rmse", "metric_mae", "metric_r2")],
                 F.count(F.lit(1)).alias("n_models"))


@query("grouped_predict", f"""
WITH {_GOLS_SQL}
SELECT d.l_orderkey, d.l_linenumber, d.l_suppkey,
       round(g.b0 + g.b1 * d.l_quantity + g.b2 * d.l_discount, 6) AS prediction
FROM d LEFT JOIN g USING (l_suppkey)
""")
def grouped_predict(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = _li_y(t).select("l_orderkey", "l_linenumber", "l_suppkey", *OLS_FEATURES)
    M.check_features(rows, OLS_FEATURES)
    s = M.score_grouped(rows, _grouped_models(t), ["l_suppkey"], OLS_FEATURES)
    return s.select("l_orderkey", "l_linenumber", "l_suppkey", _r6("prediction").alias("prediction"))


@query("missing_models", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_returnflag = 'R')
""")
def missing_models(spark, sf_dir):
    """Models per (part, supplier) trained on returned lines only; lines whose pair has none are listed."""
    li = _li_y(Tables(spark, sf_dir))
    keys = ["l_partkey", "l_suppkey"]
    models = M.fit_grouped_ols(li.where(F.col("l_returnflag") == "R"), keys, OLS_FEATURES, "y")
    rows = li.select("l_orderkey", "l_linenumber", *keys)
    return M.missing_models(rows, models, keys)


SUBSET_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("feature_subset", f"""
WITH g AS (SELECT DISTINCT l_suppkey FROM lineitem),
f AS (SELECT * FROM (VALUES {", ".join(f"('{x}')" for x in SUBSET_FEATURES)}) v(feature_name)),
r AS (SELECT l_suppkey, feature_name,
             row_number() OVER (PARTITION BY l_suppkey
                                ORDER BY md5('{SEED}|' || CAST(l_suppkey AS VARCHAR) || '|' || feature_name),
                                         feature_name) AS feature_rank
      FROM g CROSS JOIN f)
SELECT l_suppkey, feature_rank, feature_name FROM r WHERE feature_rank <= 3
""")
def feature_subset_q(spark, sf_dir):
    g = Tables(spark, sf_dir).lineitem.select("l_suppkey").distinct()
    chosen = g.select("l_suppkey", M.feature_subset(F.col("l_suppkey"), SUBSET_FEATURES, 0.75, SEED).alias("f"))
    return chosen.select("l_suppkey", F.posexplode("f").alias("pos", "feature_name")).select(
        "l_suppkey", (F.col("pos") + 1).cast("long").alias("feature_rank"), "feature_name")


@query("model_size", f"""
WITH {_GOLS_SQL}
SELECT count(*) AS n_models,
       sum(8 * 3 + length('l_quantity') + length('l_discount')) AS size_bytes,
       round(sum(8 * 3 + length('l_quantity') + length('l_discount')) / (1024.0 * 1024.0), 6) AS size_mb
FROM g
""")
def model_size(spark, sf_dir):
    """Bytes of the model table: 8 per coefficient and intercept plus the feature-name text."""
    m = _grouped_models(Tables(spark, sf_dir))
    per = (F.lit(8) * (F.size("coef") + 1)
           + F.aggregate(F.transform("feature_names", lambda n: F.length(n)), F.lit(0), lambda a, b: a + b))
    return m.agg(F.count(F.lit(1)).alias("n_models"), F.sum(per.cast("long")).alias("size_bytes"),
                 _r6(F.sum(per) / F.lit(1024.0 * 1024.0)).alias("size_mb"))
