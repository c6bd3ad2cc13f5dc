"""Registered queries: profiles and drift on the events stream (daily windows, 7-day baseline)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import profile as PR
from ..operators import sketches as SK
from ..session import new_table_path
from ..sources.tables import write_parquet
from ..streaming.monitor import land, refresh_stored_profile
from .registry import Tables, query

NUMERIC = ["value", "k"]
CATEGORICAL = ["event_type"]
BASELINE_END = "2024-01-08 00:00:00"
REBASELINE_START = "2024-01-24 00:00:00"
REFRESH_FROM = "2024-01-20 00:00:00"


def monitored(t):
    """events with the numeric JSON property k extracted."""
    return t.events.select("ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_type")


def baseline(t, start=None, end=BASELINE_END):
    d = monitored(t)
    if start:
        d = d.where(F.col("ts") >= F.to_timestamp_ntz(F.lit(start)))
    if end:
        d = d.where(F.col("ts") < F.to_timestamp_ntz(F.lit(end)))
    return d


def _r6(c):
    return F.round(c, 6)


def _flat_profile(p):
    return p.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "log_type", "granularity", "column_name", "data_type", "count", "num_nulls",
                    _r6(F.col("avg")).alias("avg"), _r6(F.col("median")).alias("median"),
                    *[_r6(F.col("quantiles")[i]).alias(f"q{10 * (i + 1)}") for i in range(9)],
                    _r6(F.col("min")).alias("min"), _r6(F.col("max")).alias("max"), "num_zeros", "num_nan",
                    _r6(F.col("percent_nan")).alias("percent_nan"), _r6(F.col("percent_null")).alias("percent_null"),
                    "distinct_count", _r6(F.col("percent_distinct")).alias("percent_distinct"))


_LONG_SQL = """
m AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events),
cl AS (SELECT date_trunc('day', ts) AS w, 'value' AS column_name, value AS v FROM m
       UNION ALL SELECT date_trunc('day', ts), 'k', k FROM m)"""


def _profile_sql(where: str = "TRUE") -> str:
    qs = ", ".join(f"round(quantile_cont(v, {p / 10}), 6) AS q{p * 10}" for p in range(1, 10))
    return f"""
WITH {_LONG_SQL}
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, 'INPUT' AS log_type, '1 day' AS granularity,
       column_name, 'double' AS data_type, count(v) AS count, count(*) - count(v) AS num_nulls,
       round(avg(v), 6) AS avg, round(quantile_cont(v, 0.5), 6) AS median, {qs},
       round(min(v), 6) AS min, round(max(v), 6) AS max, count(*) FILTER (WHERE v = 0) AS num_zeros,
       CAST(0 AS BIGINT) AS num_nan, round(0.0, 6) AS percent_nan,
       round(100.0 * (count(*) - count(v)) / count(*), 6) AS percent_null,
       count(DISTINCT v) AS distinct_count, round(100.0 * count(DISTINCT v) / count(v), 6) AS percent_distinct
FROM cl WHERE {where} GROUP BY w, column_name
"""


def _profile(t):
    return PR.profile_metrics(monitored(t), NUMERIC, [], "ts", "1 day", "INPUT")


@query("profile_numeric", _profile_sql())
def profile_numeric(spark, sf_dir):
    return _flat_profile(_profile(Tables(spark, sf_dir)))


@query("profile_categorical", """
SELECT date_trunc('day', ts) AS window_start, 'event_type' AS column_name, 'string' AS data_type,
       count(event_type) AS count, count(*) - count(event_type) AS num_nulls,
       count(DISTINCT event_type) AS distinct_count,
       round(100.0 * count(DISTINCT event_type) / count(event_type), 6) AS percent_distinct,
       round(100.0 * (count(*) - count(event_type)) / count(*), 6) AS percent_null
FROM events GROUP BY 1
""")
def profile_categorical(spark, sf_dir):
    p = PR.profile_metrics(monitored(Tables(spark, sf_dir)), [], CATEGORICAL, "ts", "1 day", "INPUT",
                           quantiles=False)
    return p.select(F.col("window.start").alias("window_start"), "column_name", "data_type", "count", "num_nulls",
                    "distinct_count", _r6(F.col("percent_distinct")).alias("percent_distinct"),
                    _r6(F.col("percent_null")).alias("percent_null"))


@query("profile_null_time", """
WITH m AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts, value FROM events)
SELECT date_trunc('day', ts) AS window_start, count(value) AS count, count(*) - count(value) AS num_nulls,
       round(avg(value), 6) AS avg, round(quantile_cont(value, 0.5), 6) AS median, count(DISTINCT value) AS distinct_count
FROM m GROUP BY 1
""")
def profile_null_time(spark, sf_dir):
    """A late or broken clock: events without a time keep a window of their own."""
    d = Tables(spark, sf_dir).events.select(F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"), "value")
    p = PR.profile_metrics(d, ["value"], [], "ts", "1 day", "INPUT")
    return p.select(F.col("window.start").alias("window_start"), "count", "num_nulls", _r6(F.col("avg")).alias("avg"),
                    _r6(F.col("median")).alias("median"), "distinct_count")


@query("tumbling_profile", """
WITH m AS (SELECT ts, value FROM events),
g AS (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS ws, '1 day' AS granularity, value FROM m
      UNION ALL
      SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01'), '1 week', value FROM m)
SELECT ws AS window_start, granularity, count(value) AS count, round(avg(value), 6) AS avg,
       round(min(value), 6) AS min, round(max(value), 6) AS max
FROM g GROUP BY ws, granularity
""")
def tumbling_profile(spark, sf_dir):
    """Several granularities: one aggregation pass each, unioned."""
    d = monitored(Tables(spark, sf_dir))
    parts = [PR.profile_metrics(d, ["value"], [], "ts", g, "INPUT", quantiles=False) for g in ("1 day", "1 week")]
    p = parts[0].unionByName(parts[1])
    return p.select(F.col("window.start").alias("window_start"), "granularity", "count",
                    _r6(F.col("avg")).alias("avg"), _r6(F.col("min")).alias("min"), _r6(F.col("max")).alias("max"))


@query("profile_filter", """
SELECT date_trunc('day', ts) AS window_start, 'value' AS column_name, count(value) AS count,
       round(avg(value), 6) AS avg
FROM events GROUP BY 1
""")
def profile_filter(spark, sf_dir):
    t = Tables(spark, sf_dir)
    prof, _ = PR.monitor(monitored(t), "ts", NUMERIC, CATEGORICAL, "1 day", baseline(t))
    f = prof.where((F.col("log_type") == "INPUT") & F.col("column_name").isin(["value"]))
    return f.select(F.col("window.start").alias("window_start"), "column_name", "count", _r6(F.col("avg")).alias("avg"))


def _drift_sql(base_where: str) -> str:
    return f"""
{_LONG_SQL},
bl AS (SELECT column_name, v FROM (SELECT 'value' AS column_name, value AS v, ts FROM m
                                   UNION ALL SELECT 'k', k, ts FROM m) WHERE {base_where}),
cc AS (SELECT w, column_name, v, count(*) AS c FROM cl WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL),
bc AS (SELECT column_name, v, count(*) AS c FROM bl WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL),
wins AS (SELECT DISTINCT w, column_name FROM cc),
grid AS (SELECT w, column_name, v, sum(a) AS a, sum(b) AS b FROM (
           SELECT w, column_name, v, c AS a, 0 AS b FROM cc
           UNION ALL SELECT wins.w, bc.column_name, bc.v, 0, bc.c FROM wins JOIN bc USING (column_name))
         GROUP BY ALL),
e AS (SELECT w, column_name, v,
             CAST(sum(a) OVER p AS DOUBLE) / sum(a) OVER q AS fa, CAST(sum(b) OVER p AS DOUBLE) / sum(b) OVER q AS fb,
             lead(v) OVER p AS nv, CAST(sum(a) OVER q AS DOUBLE) AS na, CAST(sum(b) OVER q AS DOUBLE) AS nb
      FROM grid
      WINDOW p AS (PARTITION BY w, column_name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             q AS (PARTITION BY w, column_name)),
ks AS (SELECT w, column_name, max(abs(fa - fb)) AS d, sum(abs(fa - fb) * coalesce(nv - v, 0)) AS w1,
              any_value(na) AS na, any_value(nb) AS nb FROM e GROUP BY w, column_name),
ksp AS (SELECT *, (sqrt(na * nb / (na + nb)) + 0.12 + 0.11 / sqrt(na * nb / (na + nb))) * d AS lam FROM ks),
kso AS (SELECT w, column_name, d, w1,
               CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
                    lambda j: pow(-1, j - 1) * exp(-2 * j * j * lam * lam))), 0), 1) END AS pv FROM ksp),
edges AS (SELECT column_name, list_sort(list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])))
                 AS edges FROM bl WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY column_name),
cb AS (SELECT w, column_name, len(list_filter(edges, lambda x: x < v)) AS bin, count(*) AS c
       FROM cl JOIN edges USING (column_name) WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL),
bb AS (SELECT column_name, len(list_filter(edges, lambda x: x < v)) AS bin, count(*) AS c
       FROM bl JOIN edges USING (column_name) WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL),
cs AS (SELECT w, column_name, bin, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY w, column_name) AS p FROM cb),
bs AS (SELECT column_name, bin, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY column_name) AS q FROM bb),
pj AS (SELECT coalesce(x.w, y.w) AS w, coalesce(x.column_name, y.column_name) AS column_name,
              greatest(coalesce(x.p, 0), 1e-4) AS p, greatest(coalesce(y.q, 0), 1e-4) AS q
       FROM cs x FULL OUTER JOIN (SELECT wins.w, bs.* FROM wins JOIN bs USING (column_name)) y
       ON x.w = y.w AND x.column_name = y.column_name AND x.bin = y.bin),
psi AS (SELECT w, column_name, sum((p - q) * ln(p / q)) AS psi FROM pj GROUP BY w, column_name),
cnt AS (SELECT w, column_name, count(v) - (SELECT count(b.v) FROM bl b WHERE b.column_name = cl.column_name) AS count_delta
        FROM cl GROUP BY w, column_name),
res AS (SELECT cnt.w AS window_start, cnt.column_name, cnt.count_delta, round(kso.d, 6) AS ks_statistic,
               round(kso.pv, 6) AS ks_pvalue, round(kso.w1, 6) AS wasserstein_distance,
               round(psi.psi, 6) AS population_stability_index
        FROM cnt LEFT JOIN kso USING (w, column_name) LEFT JOIN psi USING (w, column_name))"""


_BASE_WHERE = f"ts < TIMESTAMP '{BASELINE_END}'"


def _drift(t, metrics=("count_delta", "ks", "wasserstein", "psi")):
    return PR.drift_metrics(monitored(t), baseline(t), NUMERIC, [], "ts", "1 day", "BASELINE", metrics)


def _flat_drift(d):
    return d.select(F.col("window.start").alias("window_start"), "column_name", "count_delta",
                    _r6(F.col("ks_test.statistic")).alias("ks_statistic"), _r6(F.col("ks_test.pvalue")).alias("ks_pvalue"),
                    _r6(F.col("wasserstein_distance")).alias("wasserstein_distance"),
                    _r6(F.col("population_stability_index")).alias("population_stability_index"))


@query("drift_ks", f"WITH {_drift_sql(_BASE_WHERE)} SELECT window_start, column_name, ks_statistic, ks_pvalue FROM res")
def drift_ks(spark, sf_dir):
    d = _drift(Tables(spark, sf_dir), ("ks",))
    return _flat_drift(d).select("window_start", "column_name", "ks_statistic", "ks_pvalue")


@query("drift_wasserstein",
       f"WITH {_drift_sql(_BASE_WHERE)} SELECT window_start, column_name, wasserstein_distance FROM res")
def drift_wasserstein(spark, sf_dir):
    d = _drift(Tables(spark, sf_dir), ("wasserstein",))
    return _flat_drift(d).select("window_start", "column_name", "wasserstein_distance")


@query("drift_psi",
       f"WITH {_drift_sql(_BASE_WHERE)} SELECT window_start, column_name, population_stability_index FROM res")
def drift_psi(spark, sf_dir):
    return _flat_drift(_drift(Tables(spark, sf_dir), ("psi",))).select("window_start", "column_name",
                                                                       "population_stability_index")


@query("drift_count_delta", f"WITH {_drift_sql(_BASE_WHERE)} SELECT window_start, column_name, count_delta FROM res")
def drift_count_delta(spark, sf_dir):
    return _flat_drift(_drift(Tables(spark, sf_dir), ("count_delta",))).select("window_start", "column_name",
                                                                               "count_delta")


@query("drift_severity", f"""
WITH {_drift_sql(_BASE_WHERE)}
SELECT window_start, column_name, population_stability_index,
       CASE WHEN population_stability_index IS NULL THEN NULL WHEN population_stability_index < 0.1 THEN 'none'
            WHEN population_stability_index <= 0.25 THEN 'moderate' ELSE 'significant' END AS severity
FROM res
""")
def drift_severity(spark, sf_dir):
    d = _drift(Tables(spark, sf_dir), ("psi",))
    return d.select(F.col("window.start").alias("window_start"), "column_name",
                    _r6(F.col("population_stability_index")).alias("population_stability_index"),
                    D.psi_severity(F.col("population_stability_index")).alias("severity"))


@query("drift_alerts", f"""
WITH {_drift_sql(_BASE_WHERE)}
SELECT window_start, column_name, ks_statistic, ks_pvalue, wasserstein_distance FROM res
WHERE window_start = (SELECT max(window_start) FROM res)
  AND ((ks_pvalue < 0.05 AND ks_statistic > 0.2) OR wasserstein_distance >= 0.1)
""")
def drift_alerts(spark, sf_dir):
    a = D.drift_alerts(_drift(Tables(spark, sf_dir))).select(
        F.col("window.start").alias("window_start"), "column_name", F.col("ks_test.statistic").alias("ks_statistic"),
        F.col("ks_test.pvalue").alias("ks_pvalue"), "wasserstein_distance")
    return a.select("window_start", "column_name", *[_r6(F.col(c)).alias(c) for c in
                                                     ("ks_statistic", "ks_pvalue", "wasserstein_distance")])


@query("drift_rebaseline", f"""
WITH {_drift_sql(f"ts >= TIMESTAMP '{REBASELINE_START}'")}
SELECT window_start, column_name, ks_statistic, wasserstein_distance, population_stability_index FROM res
""")
def drift_rebaseline(spark, sf_dir):
    """After retraining, the baseline is the newest week; drift is recomputed against it."""
    t = Tables(spark, sf_dir)
    d = PR.drift_metrics(monitored(t), baseline(t, start=REBASELINE_START, end=None), NUMERIC, [], "ts")
    return _flat_drift(d).select("window_start", "column_name", "ks_statistic", "wasserstein_distance",
                                 "population_stability_index")


@query("drift_consecutive", """
WITH m AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
cl AS (SELECT date_trunc('day', ts) AS w, 'value' AS column_name, value AS v FROM m
       UNION ALL SELECT date_trunc('day', ts), 'k', k FROM m),
cc AS (SELECT w, column_name, v, count(*) AS c FROM cl WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL),
wl AS (SELECT w, lead(w) OVER (ORDER BY w) AS nw FROM (SELECT DISTINCT w FROM cc)),
rc AS (SELECT wl.nw AS w, cc.column_name, cc.v, cc.c FROM cc JOIN wl ON cc.w = wl.w WHERE wl.nw IS NOT NULL),
grid AS (SELECT w, column_name, v, sum(a) AS a, sum(b) AS b FROM (
           SELECT w, column_name, v, c AS a, 0 AS b FROM cc WHERE w IN (SELECT w FROM rc)
           UNION ALL SELECT w, column_name, v, 0, c FROM rc) GROUP BY ALL),
e AS (SELECT w, column_name, v,
             CAST(sum(a) OVER p AS DOUBLE) / sum(a) OVER q AS fa, CAST(sum(b) OVER p AS DOUBLE) / sum(b) OVER q AS fb,
             lead(v) OVER p AS nv
      FROM grid
      WINDOW p AS (PARTITION BY w, column_name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             q AS (PARTITION BY w, column_name))
SELECT w AS window_start, column_name, round(max(abs(fa - fb)), 6) AS ks_statistic,
       round(sum(abs(fa - fb) * coalesce(nv - v, 0)), 6) AS wasserstein_distance
FROM e GROUP BY w, column_name
""")
def drift_consecutive(spark, sf_dir):
    d = PR.drift_metrics(monitored(Tables(spark, sf_dir)), None, NUMERIC, [], "ts", "1 day", "CONSECUTIVE",
                         ("ks", "wasserstein"))
    return d.select(F.col("window.start").alias("window_start"), "column_name",
                    _r6(F.col("ks_test.statistic")).alias("ks_statistic"),
                    _r6(F.col("wasserstein_distance")).alias("wasserstein_distance"))


@query("drift_psi_categorical", f"""
WITH b AS (SELECT event_type AS bin, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS q
           FROM events WHERE ts < TIMESTAMP '{BASELINE_END}' GROUP BY 1),
c AS (SELECT date_trunc('day', ts) AS w, event_type AS bin,
             CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)) AS p
      FROM events GROUP BY 1, 2),
wins AS (SELECT DISTINCT w FROM c),
j AS (SELECT coalesce(c.w, y.w) AS w, greatest(coalesce(c.p, 0), 1e-4) AS p, greatest(coalesce(y.q, 0), 1e-4) AS q
      FROM c FULL OUTER JOIN (SELECT wins.w, b.* FROM wins, b) y ON c.w = y.w AND c.bin = y.bin)
SELECT w AS window_start, 'event_type' AS column_name, round(sum((p - q) * ln(p / q)), 6) AS population_stability_index
FROM j GROUP BY w
""")
def drift_psi_categorical(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = PR.drift_metrics(monitored(t), baseline(t), [], CATEGORICAL, "ts", "1 day", "BASELINE", ("psi",))
    return d.select(F.col("window.start").alias("window_start"), "column_name",
                    _r6(F.col("population_stability_index")).alias("population_stability_index"))


@query("monitor_summary", """
SELECT 'profile' AS metric_table, 'INPUT' AS kind, count(*) AS n
FROM (SELECT DISTINCT date_trunc('day', ts) FROM events) d, (VALUES ('value'), ('k'), ('event_type')) c(x)
UNION ALL SELECT 'profile', 'BASELINE', 3
UNION ALL SELECT 'drift', 'BASELINE', 3 * count(DISTINCT date_trunc('day', ts)) FROM events
UNION ALL SELECT 'drift', 'CONSECUTIVE', 3 * (count(DISTINCT date_trunc('day', ts)) - 1) FROM events
""")
def monitor_summary(spark, sf_dir):
    """Rows of the two metric tables by log type and by drift type (the same rows whichever metrics are asked for)."""
    t = Tables(spark, sf_dir)
    prof, drift = PR.monitor(monitored(t), "ts", NUMERIC, CATEGORICAL, "1 day", baseline(t), metrics=("count_delta",))
    a = prof.groupBy(F.lit("profile").alias("metric_table"), F.col("log_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"))
    b = drift.groupBy(F.lit("drift").alias("metric_table"), F.col("drift_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@query("incremental_refresh", _profile_sql())
def incremental_refresh(spark, sf_dir):
    """A stored metric table by day: new rows land, their days are profiled again and replaced, other days stay as
    they were written. Equals a full recompute."""
    d = monitored(Tables(spark, sf_dir))
    cut = F.to_timestamp_ntz(F.lit(REFRESH_FROM))
    source, metrics = new_table_path(spark, "monitor-source"), new_table_path(spark, "monitor-metrics")
    days = land(d.where((F.col("ts") < cut) | F.col("ts").isNull()), source, "ts")
    refresh_stored_profile(spark, source, metrics, days, NUMERIC, "ts")
    days = land(d.where(F.col("ts") >= cut), source, "ts")
    return _flat_profile(refresh_stored_profile(spark, source, metrics, days, NUMERIC, "ts"))


_WITHIN = ", ".join(f"TRUE AS {c}_within" for c in ("p10", "median", "p90", "distinct"))


@query("profile_numeric_sketch", f"""
WITH {_LONG_SQL}
SELECT time_bucket(INTERVAL 7 DAY, w, TIMESTAMP '1970-01-01') AS window_start, column_name, count(v) AS count,
       count(*) - count(v) AS num_nulls, round(avg(v), 6) AS avg, round(min(v), 6) AS min, round(max(v), 6) AS max, {_WITHIN}
FROM cl GROUP BY 1, 2
""")
def profile_numeric_sketch(spark, sf_dir):
    """Weekly profiles merged from stored daily sketches, checked against the exact ranks and distinct counts: the error
    bounds of ``operators.sketches`` hold for every window and column."""
    d = monitored(Tables(spark, sf_dir))
    path = new_table_path(spark, "day-sketches")
    write_parquet(SK.sketch_profile(d, NUMERIC, "ts", "1 day"), path)
    weeks = SK.read_profile(SK.merge_profiles(spark.read.parquet(path), "1 week"))
    exact = (PR.value_table(d, NUMERIC, "ts", "1 week", "double").where("c > 0")
             .withColumnRenamed("__dw_wk", "window_start"))
    at = {"p10": F.col("quantiles")[0], "median": F.col("median"), "p90": F.col("quantiles")[8]}
    below = [F.sum(F.when(F.col("v") < q, F.col("c")).otherwise(0)).alias(f"{n}_lt") for n, q in at.items()]
    upto = [F.sum(F.when(F.col("v") <= q, F.col("c")).otherwise(0)).alias(f"{n}_le") for n, q in at.items()]
    ranks = (exact.join(weeks.select("window_start", "column_name", "median", "quantiles"), ["window_start", "column_name"])
             .groupBy("window_start", "column_name").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("values"), *below, *upto))
    e, n = SK.RANK_ERROR, F.col("n")
    within = [((F.col(f"{c}_lt") / n <= p + e) & (F.col(f"{c}_le") / n >= p - e)).alias(f"{c}_within")
              for c, p in (("p10", 0.1), ("median", 0.5), ("p90", 0.9))]
    close = (F.abs(F.col("distinct_count") - F.col("values")) <= SK.DISTINCT_ERROR * F.col("values")).alias("distinct_within")
    return (weeks.join(ranks, ["window_start", "column_name"])
            .select("window_start", "column_name", "count", "num_nulls", *[_r6(F.col(c)).alias(c) for c in ("avg", "min", "max")], *within, close))
