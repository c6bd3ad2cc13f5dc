"""Monitor tables: profile metrics per time window x column, and drift metrics per window x column.

``monitor(df, ts, numeric, categorical, granularity, baseline)`` returns the two long tables the
monitoring service would write. Everything is computed from one table of value counts per (window, column): one
shuffle of the data, partially aggregated; counts, moments, distinct values, exact quantiles, KS, W1 and PSI all read it, and Spark
reuses its exchange within a plan. Nothing runs while the tables are built.

Rows without a time are kept: they form a window of their own, shown as a NULL window with log type ``INPUT``. They take no part in
window-to-window drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import drift as D
from .prefix import in_ranges, quantile_aggs, quantiles_of_counts, running, unpivot

DECILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
_WK = "__dw_wk"
#: Window key of rows without a time, and of a whole-table profile.
_NO_TIME = "0001-01-01 00:00:00"


_NUMBERS = ("count", "num_nulls", "avg", "min", "max", "num_zeros", "num_nan", "distinct_count")


def _no_time() -> Column:
    return F.to_timestamp_ntz(F.lit(_NO_TIME))


def _stamped(df: DataFrame, ts_col: str | None, granularity: str) -> DataFrame:
    """``df`` with the start of each row's window (never NULL)."""
    if ts_col is None:
        return df.withColumn(_WK, _no_time())
    kind = dict(df.dtypes)[ts_col]
    # F.window leaves out rows without a time, so these get one and lose it again
    whole = df.withColumn("__dw_t", F.coalesce(F.col(ts_col), F.lit("2000-01-01 00:00:00").cast(kind)))
    return (whole.withColumn("__dw_w", F.window("__dw_t", granularity))
            .withColumn(_WK, F.coalesce(F.when(F.col(ts_col).isNotNull(), F.col("__dw_w.start").cast("timestamp_ntz")), _no_time()))
            .drop("__dw_t", "__dw_w"))


def _with_window(df: DataFrame, granularity: str) -> DataFrame:
    """The window struct of each window key; NULL where there is no time."""
    d = df.withColumn("__dw_w", F.window(_WK, granularity))
    return d.withColumn("window", F.when(F.col(_WK) != _no_time(), F.col("__dw_w"))).drop("__dw_w")


def value_table(df: DataFrame, cols: Sequence[str], ts_col: str | None, granularity: str, cast: str) -> DataFrame:
    """(window key, column_name, v, n rows, c rows with a usable value): a row a value, NULL and NaN included with c = 0."""
    d = unpivot(_stamped(df, ts_col, granularity).select(_WK, *cols), [_WK], list(cols), value_col="v", cast=cast)
    usable = F.col("v").isNotNull() if cast == "string" else F.col("v").isNotNull() & ~F.isnan("v")
    return d.groupBy(_WK, "column_name", "v").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(usable, 1)).alias("c"))


def _usable(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    # the condition is on an aggregate, so it stays above the shuffle that all users of the counts share
    return counts.where("c > 0").select(*keys, "v", "c")


def profile_metrics(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                    ts_col: str | None = None, granularity: str = "1 day", log_type: str = "INPUT",
                    quantiles: bool = True) -> DataFrame:
    """One row per window x column (window NULL for a whole-table profile, e.g. the baseline, and for rows without a time)."""
    types, keys = dict(df.dtypes), [_WK, "column_name"]
    nul, long_nul = F.lit(None).cast("double"), F.lit(None).cast("long")
    parts = []
    if numeric:
        counts = value_table(df, numeric, ts_col, granularity, "double")
        v, n, c = F.col("v"), F.col("n"), F.col("c")
        aggs = [
            F.sum(F.when(v.isNotNull(), n).otherwise(0)).alias("count"), F.sum(F.when(v.isNull(), n).otherwise(0)).alias("num_nulls"),
            (F.sum(F.when(c > 0, v * c)) / F.sum(c)).alias("avg"), F.min(F.when(c > 0, v)).alias("min"),
            F.max(F.when(c > 0, v)).alias("max"), F.sum(F.when(v == 0, n).otherwise(0)).alias("num_zeros"),
            F.sum(F.when(v.isNotNull() & (c == 0), n).otherwise(0)).alias("num_nan"),
            F.count(F.when(c > 0, 1)).alias("distinct_count")]
        if quantiles:  # NULL and NaN are rows with c = 0: they have their place in the order and change no running count
            ranked = running(in_ranges(counts, keys, "v"), keys, "v", {"dw_c": "c"}, totals=True).withColumn(
                "__dw_u", F.when(c > 0, v))
            more, q = quantile_aggs("__dw_u", "cum_dw_c", "all_dw_c", [0.5, *DECILES])
            p = (ranked.groupBy(*keys).agg(*aggs, *more).withColumn("__dw_q", q)
                 .withColumn("median", F.col("__dw_q")[0])
                 .withColumn("quantiles", F.when(F.col("__dw_all") > 0, F.slice("__dw_q", 2, len(DECILES)))))
            p = p.select(*keys, *_NUMBERS, "median", "quantiles")
        else:
            p = counts.groupBy(*keys).agg(*aggs).withColumn("median", nul).withColumn("quantiles", F.lit(None).cast("array<double>"))
        parts.append(p)
    if categorical:
        counts = value_table(df, categorical, ts_col, granularity, "string")
        n, c = F.col("n"), F.col("c")
        parts.append(counts.groupBy(*keys).agg(
            F.sum("c").alias("count"), F.sum(n - c).alias("num_nulls"), nul.alias("avg"), nul.alias("min"), nul.alias("max"),
            long_nul.alias("num_zeros"), F.lit(0).cast("long").alias("num_nan"), F.count(F.when(c > 0, 1)).alias("distinct_count"))
            .withColumn("median", nul).withColumn("quantiles", F.lit(None).cast("array<double>")))
    long = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    total = (F.col("count") + F.col("num_nulls")).cast("double")
    dtype = F.create_map(*[x for name in (*numeric, *categorical) for x in (F.lit(name), F.lit(types[name]))])
    long = (_with_window(long, granularity)
            .withColumn("data_type", dtype[F.col("column_name")])
            .withColumn("percent_null", F.lit(100.0) * F.col("num_nulls") / total)
            .withColumn("percent_nan", F.lit(100.0) * F.col("num_nan") / total)
            .withColumn("percent_distinct", F.when(F.col("count") > 0,
                                                   F.lit(100.0) * F.col("distinct_count") / F.col("count")))
            .withColumn("log_type", F.lit(log_type)).withColumn("granularity", F.lit(granularity if ts_col else None)))
    return long.select("window", "log_type", "granularity", "column_name", "data_type", "count", "num_nulls",
                       "avg", "median", "quantiles", "min", "max", "num_zeros", "num_nan", "percent_nan",
                       "percent_null", "distinct_count", "percent_distinct")


def drift_metrics(df: DataFrame, baseline: DataFrame | None, numeric: Sequence[str],
                  categorical: Sequence[str] = (), ts_col: str = "ts", granularity: str = "1 day",
                  drift_type: str = "BASELINE",
                  metrics: Sequence[str] = ("count_delta", "ks", "wasserstein", "psi")) -> DataFrame:
    """drift_type BASELINE: every window against ``baseline``; CONSECUTIVE: against the previous
    window. Output: window, granularity, column_name, data_type, drift_type, count_delta,
    ks_test{statistic,pvalue}, wasserstein_distance, population_stability_index. Metrics left
    out of ``metrics`` are NULL and cost nothing."""
    numeric, categorical = list(numeric), list(categorical)
    types, want = dict(df.dtypes), set(metrics)
    null = F.lit(None).cast("double")
    C = [_WK, "column_name"]
    K = {"BASELINE": ["column_name"], "CONSECUTIVE": C}.get(drift_type)
    if K is None:
        raise ValueError(drift_type)

    def sides(cols: Sequence[str], cast: str) -> tuple[DataFrame, DataFrame]:
        cur = value_table(df, cols, ts_col, granularity, cast).persist()  # lazy: filled when a drift table is first read
        if drift_type == "BASELINE":
            return cur, value_table(baseline, cols, None, granularity, cast).drop(_WK).persist()
        order = Window.orderBy(_WK)  # over the distinct window list only (one row per window)
        cur = cur.where(F.col(_WK) != _no_time())
        nxt = cur.select(_WK).distinct().select(F.col(_WK).alias("__dw_prev"), F.lead(_WK).over(order).alias("__dw_next"))
        ref = cur.join(nxt, cur[_WK] == nxt["__dw_prev"]).where(F.col("__dw_next").isNotNull())
        return cur, ref.select(F.col("__dw_next").alias(_WK), "column_name", "v", "n", "c")

    parts = []
    for cols, cast in ((numeric, "double"), (categorical, "string")):
        if not cols:
            continue
        cur, ref = sides(cols, cast)
        held = F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0))
        part = cur.groupBy(*C).agg(held.alias("n_cur")).join(ref.groupBy(*K).agg(held.alias("n_ref")), K, "left")
        part = part.withColumn("n_ref", F.coalesce("n_ref", F.lit(0))).withColumn("count_delta", F.col("n_cur") - F.col("n_ref"))
        cur, ref = _usable(cur, C), _usable(ref, K)
        if cast == "double" and want & {"ks", "wasserstein"}:
            part = part.join(D.ecdf_distances(cur, ref, C, K, "wasserstein" in want).drop("n_cur", "n_ref"), C, "left")
        else:
            part = part.withColumn("ks_statistic", null).withColumn("wasserstein_distance", null)
        if "psi" not in want:
            part = part.withColumn("population_stability_index", null)
        elif cast == "string":
            part = part.join(D.psi_categorical(cur, ref, C, K), C, "left")
        else:
            edges = quantiles_of_counts(ref, K, "v", "c", DECILES).select(*K, F.array_distinct("quantiles").alias("edges"))
            part = part.join(D.psi_of_counts(cur, ref, C, K, edges), C, "left")
        parts.append(part)
    out = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    if drift_type == "CONSECUTIVE":
        out = out.where(F.col("n_ref") > 0)
    dtype = F.create_map(*[x for c in numeric + categorical for x in (F.lit(c), F.lit(types[c]))])
    return _with_window(out, granularity).select(
        "window", F.lit(granularity).alias("granularity"), "column_name", dtype[F.col("column_name")].alias("data_type"),
        F.lit(drift_type).alias("drift_type"), "count_delta",
        F.struct(F.col("ks_statistic").alias("statistic"),
                 D.ks_pvalue(F.col("ks_statistic"), F.col("n_cur"), F.col("n_ref")).alias("pvalue")).alias("ks_test"),
        "wasserstein_distance", "population_stability_index")


def monitor(df: DataFrame, ts_col: str, numeric: Sequence[str], categorical: Sequence[str] = (),
            granularity: str = "1 day", baseline: DataFrame | None = None,
            metrics: Sequence[str] = ("count_delta", "ks", "wasserstein", "psi")) -> tuple[DataFrame, DataFrame]:
    """(profile_metrics, drift_metrics) - INPUT windows plus the BASELINE profile; drift against
    the baseline (if given) and between consecutive windows."""
    prof = profile_metrics(df, numeric, categorical, ts_col, granularity, "INPUT")
    drifts = drift_metrics(df, None, numeric, categorical, ts_col, granularity, "CONSECUTIVE", metrics)
    if baseline is not None:
        prof = prof.unionByName(profile_metrics(baseline, numeric, categorical, None, granularity, "BASELINE"))
        drifts = drift_metrics(df, baseline, numeric, categorical, ts_col, granularity, "BASELINE", metrics).unionByName(drifts)
    return prof, drifts
