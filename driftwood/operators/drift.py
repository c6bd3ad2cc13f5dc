"""Drift between a current sample and a reference: KS, Wasserstein-1, PSI, count delta, alerts.

All of it is computed from value counts, lazily: nothing runs while a plan is built, and the reference is never copied for
each window.

* Current and reference counts of one reference key K (the column, or (window, column) for window-to-previous-window) are
  one table in value order. One pass of running sums over it gives every current value the
  reference ECDF ``F`` at and just below it and its integral ``G(x) = int_{-inf}^x F = (x * R - S) / n``, with R and S the
  running count and sum of the reference.
* A second pass, within each current group, gives its own ECDF a_i, constant on [v_i, v_{i+1}). KS needs only F at v_i and
  just below v_{i+1}; W1 needs ``int |a_i - F|`` = differences of G, split where F passes a_i. Only where that is strictly inside
  an interval is the reference value looked up, by an as-of join on integer ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_join
from .prefix import LEVEL, PART, in_ranges, running

PSI_FLOOR = 1e-4
# Fixed severity bounds for the population stability index.
PSI_MODERATE = 0.1
PSI_SIGNIFICANT = 0.25
# Fixed alert thresholds: p-value below, KS statistic above, Wasserstein distance at least.
ALERT_P, ALERT_KS, ALERT_W1 = 0.05, 0.2, 0.1


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided KS p-value (Kolmogorov series, Stephens' small-sample correction).
    For lambda < 0.2 the series does not converge in 100 terms and the p-value is 1."""
    ne = n.cast("double") * m.cast("double") / (n + m).cast("double")
    lam = (F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * lam * lam))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(d.isNull(), F.lit(None)).when(lam < 0.2, F.lit(1.0)).otherwise(p)


def value_counts(long: DataFrame, keys: Sequence[str], value_col: str = "value") -> DataFrame:
    """One row per (keys, value) with its count; NULL and NaN dropped."""
    return (long.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))
            .groupBy(*keys, F.col(value_col).alias("v")).agg(F.count(F.lit(1)).alias("c")))


def with_reference(cur: DataFrame, ref: DataFrame, cur_keys: Sequence[str], ref_keys: Sequence[str]) -> DataFrame:
    """Rows of both tables (keys, v, c; one a value) with the reference's running sums over their common key.

    Reference rows (``r`` > 0) have NULL in the keys that only ``cur`` has. Adds f_lt, f_le (reference ECDF below and at v), g (its
    integral), n_ref, vmax_ref and g_max; keeps the ranges for another pass.
    """
    C, K = list(cur_keys), list(ref_keys)
    none = F.lit(0).cast("long")
    both = (cur.select(*C, "v", "c", none.alias("r"))
            .unionByName(ref.select(*K, *[F.lit(None).cast(cur.schema[k].dataType).alias(k) for k in C if k not in K],
                                    "v", none.alias("c"), F.col("c").alias("r"))))
    v, r = F.col("v"), F.col("r")
    d = running(in_ranges(both, K, "v"), K, "v", {"r": r, "s": v * r}, totals=True, most={"vmax_ref": F.when(r > 0, v)})
    n = F.col("all_r").cast("double")
    at_v = F.sum("r").over(Window.partitionBy(*K, LEVEL, PART).orderBy("v").rangeBetween(Window.currentRow, Window.currentRow))
    return (d.withColumn("r_lt", F.col("cum_r") - at_v)
            .select(*C, "v", "c", "r", "r_lt", LEVEL, PART, F.col("all_r").alias("n_ref"), "vmax_ref",
                    F.when(n > 0, F.col("cum_r") / n).alias("f_le"), F.when(n > 0, F.col("r_lt") / n).alias("f_lt"),
                    F.when(n > 0, (v * F.col("cum_r") - F.col("cum_s")) / n).alias("g"),
                    F.when(n > 0, (F.col("vmax_ref") * n - F.col("all_s")) / n).alias("g_max")))


def ecdf_distances(cur: DataFrame, ref: DataFrame, cur_keys: Sequence[str], ref_keys: Sequence[str],
                   wasserstein: bool = True) -> DataFrame:
    """KS statistic and W1 between current groups and their reference.

    cur: (cur_keys..., v, c); ref: (ref_keys..., v, c), one row per distinct value; ref_keys is
    a subset of cur_keys. Returns cur_keys + n_cur, n_ref, ks_statistic, wasserstein_distance (NULL without reference rows).
    """
    C, K = list(cur_keys), list(ref_keys)
    rows = with_reference(cur, ref, C, K).persist()  # read by both passes and the lookup; nothing runs yet
    w = running(rows.where("c > 0"), C, "v", {"c": "c"}, totals=True, ahead=["v", "f_lt", "g"])
    w = w.withColumnRenamed("all_c", "n_cur").withColumn("a", F.col("cum_c") / F.col("n_cur"))
    p, a, last = F.col("v"), F.col("a"), F.col("next_v").isNull()
    first = F.col("cum_c") == F.col("c")
    d = F.greatest(F.abs(a - F.col("f_le")), F.when(~last, F.abs(a - F.col("next_f_lt"))), F.when(first, F.col("f_lt")))
    w = w.withColumn("d", d)
    sizes = [F.first("n_cur").alias("n_cur"), F.first("n_ref").alias("n_ref")]
    if not wasserstein:
        return w.groupBy(*C).agg(F.max("d").alias("ks_statistic"),
                                 F.lit(None).cast("double").alias("wasserstein_distance"), *sizes)

    # Interval [p, q) with constant current ECDF a; the last interval (a = 1) runs to the reference's greatest value.
    beyond = F.col("vmax_ref") > p
    w = w.withColumns({"q": F.when(~last, F.col("next_v")).when(beyond, F.col("vmax_ref")).otherwise(p),
                       "g_q": F.when(~last, F.col("next_g")).when(beyond, F.col("g_max")).otherwise(F.col("g")),
                       "head": F.when(first, F.col("g")).otherwise(0.0),
                       "inside": ~last & (F.col("f_le") < a) & (F.col("next_f_lt") >= a) & (F.col("n_ref") > 0)})
    area = F.col("g_q") - F.col("g") - a * (F.col("q") - p)  # int (F - a) over [p, q)
    out = [*C, "d", "n_cur", "n_ref"]
    plain = w.where(~F.coalesce("inside", F.lit(False))).select(*out, (F.abs(area) + F.col("head")).alias("w1"))
    # F passes a at c inside (p, q): c is the reference value at rank ceil(a * n_ref)
    bucket = lambda rank: F.floor(rank / F.greatest(F.lit(1), F.ceil(F.col("n_ref") / 1024))).cast("long")
    rank = F.ceil(F.col("cum_c").cast("double") * F.col("n_ref") / F.col("n_cur"))
    split = (w.where("inside").select(*out, "v", "a", "q", "g", "g_q", "head", rank.alias("__dw_rank"))
             .withColumn("__dw_rb", bucket(F.col("__dw_rank"))))
    starts = (rows.where("r > 0").select(*K, (F.col("r_lt") + 1).alias("start"), F.col("v").alias("c_val"), F.col("g").alias("g_c"),
                                         bucket(F.col("r_lt") + 1).alias("__dw_sb")))
    split = asof_join(split, starts, K, K, "__dw_rank", "start", ["c_val", "g_c"],
                      spine_bucket="__dw_rb", feature_bucket="__dw_sb")
    m = F.least(F.greatest(F.col("c_val"), p), F.col("q"))
    g_m = (F.when(F.col("c_val") <= p, F.col("g")).when(F.col("c_val") >= F.col("q"), F.col("g_q")).otherwise(F.col("g_c")))
    below = a * (m - p) - (g_m - F.col("g"))  # int (a - F) over [p, c)
    split = split.select(*out, (area + F.lit(2.0) * below + F.col("head")).alias("w1"))
    return plain.unionByName(split).groupBy(*C).agg(F.max("d").alias("ks_statistic"), F.sum("w1").alias("wasserstein_distance"), *sizes)


def psi_numeric(cur_long: DataFrame, ref_long: DataFrame, cur_keys: Sequence[str], ref_keys: Sequence[str],
                edges: DataFrame, value_col: str = "value") -> DataFrame:
    """PSI of raw values, see ``psi_of_counts``; NULL and NaN form no bin."""
    return psi_of_counts(value_counts(cur_long, cur_keys, value_col), value_counts(ref_long, ref_keys, value_col),
                         cur_keys, ref_keys, edges)


def psi_of_counts(cur: DataFrame, ref: DataFrame, cur_keys: Sequence[str], ref_keys: Sequence[str], edges: DataFrame) -> DataFrame:
    """PSI of value counts (keys, v, c) over bins at the reference deciles (``edges``: ref_keys + ``edges`` array,
    duplicates merged, outer bins open). Shares floored at 1e-4."""
    def binned(counts, keys):
        d = counts.join(edges, list(ref_keys))
        b = F.size(F.filter("edges", lambda e: e < F.col("v")))
        return d.groupBy(*keys, b.alias("bin")).agg(F.sum("c").alias("c"))
    return _psi(binned(cur, cur_keys), binned(ref, ref_keys), cur_keys, ref_keys)


def psi_categorical(cur: DataFrame, ref: DataFrame, cur_keys: Sequence[str], ref_keys: Sequence[str]) -> DataFrame:
    """PSI of value counts (keys, v, c) with one bin per category."""
    return _psi(cur.withColumnRenamed("v", "bin"), ref.withColumnRenamed("v", "bin"), cur_keys, ref_keys)


def _psi(cur: DataFrame, ref: DataFrame, cur_keys, ref_keys) -> DataFrame:
    C, K = list(cur_keys), list(ref_keys)
    cur = cur.join(cur.groupBy(*C).agg(F.sum("c").alias("n")), C).withColumn("p", F.col("c") / F.col("n"))
    ref = ref.join(ref.groupBy(*K).agg(F.sum("c").alias("n")), K).withColumn("q", F.col("c") / F.col("n"))
    # bins present in the reference, for every current group under the same K ...
    groups = cur.select(*C).distinct()
    ref_side = groups.join(ref.select(*K, "bin", "q"), K)
    both = ref_side.join(cur.select(*C, "bin", "p"), [*C, "bin"], "full")
    p = F.greatest(F.coalesce(F.col("p"), F.lit(0.0)), F.lit(PSI_FLOOR))
    q = F.greatest(F.coalesce(F.col("q"), F.lit(0.0)), F.lit(PSI_FLOOR))
    return both.groupBy(*C).agg(F.sum((p - q) * F.log(p / q)).alias("population_stability_index"))


def psi_severity(psi: Column) -> Column:
    return (F.when(psi.isNull(), F.lit(None)).when(psi < PSI_MODERATE, F.lit("none"))
            .when(psi <= PSI_SIGNIFICANT, F.lit("moderate")).otherwise(F.lit("significant")))


def drift_alerts(drift: DataFrame, p_threshold: float = ALERT_P, ks_threshold: float = ALERT_KS,
                 w1_threshold: float = ALERT_W1, drift_type: str = "BASELINE") -> DataFrame:
    """Rows of the newest window, of one drift type, that pass the thresholds: p and KS together, or W1."""
    latest = drift.where(F.col("drift_type") == drift_type).agg(F.max("window.end").alias("__dw_end"))
    d = drift.where(F.col("drift_type") == drift_type).join(F.broadcast(latest),
                                                            F.col("window.end") == F.col("__dw_end"))
    cond = (((F.col("ks_test.pvalue") < p_threshold) & (F.col("ks_test.statistic") > ks_threshold))
            | (F.col("wasserstein_distance") >= w1_threshold))
    return d.where(cond).drop("__dw_end")
