"""Mergeable window profiles: KLL and HLL sketches kept per window and column, merged to longer windows without the data.

A profile of sketches is one aggregation with small partial states: no value is shuffled. Its rows can be stored, and a
week is the merge of its days. Counts, sums, extremes and averages stay exact; quantiles have a normalised rank error of
at most ``RANK_ERROR`` and distinct counts a relative error of at most ``DISTINCT_ERROR`` (both over three times the
sketches' standard errors). Use ``profile.profile_metrics`` where exact quantiles are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import DECILES

KLL_K, HLL_LG_K = 400, 14
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.04
_STATE = ("rows", "count", "num_nan", "num_zeros", "total", "min", "max", "kll", "hll")


def sketch_profile(df: DataFrame, numeric: Sequence[str], ts_col: str, granularity: str = "1 day") -> DataFrame:
    """window_start, column_name and the mergeable state of each column; rows without a time have a NULL window_start."""
    known = df.where(F.col(ts_col).isNotNull()).select(F.window(ts_col, granularity)["start"].alias("window_start"), *numeric)
    lost = df.where(F.col(ts_col).isNull()).select(F.lit(None).cast(known.schema["window_start"].dataType).alias("window_start"), *numeric)

    def state(c: str) -> Column:
        v = F.col(c).cast("double")
        ok = F.when(~F.isnan(v), v)
        return F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count(v).alias("count"),
                        F.count(F.when(F.isnan(v), 1)).alias("num_nan"), F.count(F.when(v == 0, 1)).alias("num_zeros"),
                        F.sum(ok).alias("total"), F.min(ok).alias("min"), F.max(ok).alias("max"),
                        F.kll_sketch_agg_double(ok, KLL_K).alias("kll"), F.hll_sketch_agg(F.when(ok.isNotNull(), F.xxhash64(ok + 0.0)), HLL_LG_K).alias("hll"))
    wide = known.unionByName(lost).groupBy("window_start").agg(F.array(*[state(c) for c in numeric]).alias("__dw_s"))
    return wide.select("window_start", F.inline("__dw_s"))


def merge_profiles(sketches: DataFrame, granularity: str) -> DataFrame:
    """Sketch rows of longer windows from those of shorter ones that make them up."""
    d = sketches.withColumn("__dw_t", F.coalesce("window_start", F.lit("2000-01-01 00:00:00").cast(sketches.schema["window_start"].dataType)))
    d = d.withColumn("__dw_w", F.window("__dw_t", granularity))
    start = F.when(F.col("window_start").isNotNull(), F.col("__dw_w.start"))
    add = [F.sum(c).alias(c) for c in ("rows", "count", "num_nan", "num_zeros", "total")]
    return (d.groupBy(start.alias("window_start"), "column_name")
            .agg(*add, F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("kll", KLL_K).alias("kll"),
                 F.hll_union_agg("hll").alias("hll")).select("window_start", "column_name", *_STATE))


def read_profile(sketches: DataFrame) -> DataFrame:
    """Profile columns of sketch rows: exact counts and moments, approximate median, deciles and distinct counts."""
    used = F.col("count") - F.col("num_nan")
    q = F.when(used > 0, F.kll_sketch_get_quantile_double("kll", F.array(*[F.lit(p) for p in (0.5, *DECILES)])))
    return (sketches.withColumn("__dw_q", q)
            .select("window_start", "column_name", "count", (F.col("rows") - F.col("count")).alias("num_nulls"),
                    F.when(used > 0, F.col("total") / used).alias("avg"), F.col("__dw_q")[0].alias("median"),
                    F.slice("__dw_q", 2, len(DECILES)).alias("quantiles"), "min", "max", "num_zeros", "num_nan",
                    F.when(used > 0, F.hll_sketch_estimate("hll")).otherwise(0).alias("distinct_count")))
