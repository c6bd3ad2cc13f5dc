"""Seeded synthetic data grown from real keys: per-group regression rows, clusters, drifted snapshots.

Every value is a pure function of (seed, key, index) through md5-based uniforms/normals, so a
recomputed task reproduces it exactly and no generator state is shared between tasks. Row
counts follow the key table (groups x samples, or one row per key), generated with
``sequence`` + ``explode`` on the executors - nothing is built on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_normal, hash_text, hash_uniform


def padded_key(prefix: str, c: Column, width: int = 2) -> Column:
    """'sku_07'-style names; keys longer than ``width`` keep all digits (no truncation)."""
    s = c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.lit(width), F.length(s)), "0"))


def group_regression(keys: DataFrame, key_col: str, n_samples: int = 100, n_features: int = 10,
                     noise: float = 1.0, seed: int = 42, prefix: str = "sku_") -> DataFrame:
    """Per group: ``n_samples`` rows of N(0,1) features and target = sum(beta_gj * x_j) + noise,
    with beta_gj ~ N(0,1) fixed per (group, feature). Columns: sku, sample, features_0.., target."""
    g = keys.select(F.col(key_col).alias("__dw_g")).distinct()
    rows = g.select("__dw_g", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("sample"))
    feats = [hash_normal(seed, F.lit("x"), "__dw_g", "sample", F.lit(j)).alias(f"features_{j}")
             for j in range(n_features)]
    rows = rows.select("__dw_g", "sample", *feats)
    target = F.lit(0.0)
    for j in range(n_features):
        target = target + hash_normal(seed, F.lit("beta"), "__dw_g", F.lit(j)) * F.col(f"features_{j}")
    target = target + F.lit(float(noise)) * hash_normal(seed, F.lit("eps"), "__dw_g", "sample")
    return rows.select(padded_key(prefix, F.col("__dw_g")).alias("sku"), "sample",
                       *[f"features_{j}" for j in range(n_features)], target.alias("target"))


def blobs(keys: DataFrame, key_col: str, n_features: int = 20, n_centers: int = 4, cluster_std: float = 1.0,
          seed: int = 42, timestamp: str = "2026-02-01 00:00:00", box: tuple[float, float] = (-10.0, 10.0)) -> DataFrame:
    """One row per key: cluster = seeded bucket, centre coordinates uniform in ``box``,
    features = centre + N(0, cluster_std). Columns: customer_id, timestamp, feature_*, cluster."""
    k = keys.select(F.col(key_col).alias("__dw_k")).distinct()
    cluster = hash_bucket(seed, n_centers, F.lit("cluster"), "__dw_k")
    k = k.withColumn("cluster", cluster)
    lo, hi = box
    feats = []
    for j in range(n_features):
        centre = F.lit(lo) + F.lit(hi - lo) * hash_uniform(seed, F.lit("centre"), "cluster", F.lit(j))
        feats.append((centre + F.lit(float(cluster_std)) * hash_normal(seed, F.lit("x"), "__dw_k", F.lit(j)))
                     .alias(f"feature_{j}"))
    return k.select(hash_text(seed, F.lit("id"), "__dw_k").alias("customer_id"),
                    F.to_timestamp_ntz(F.lit(timestamp)).alias("timestamp"), *feats, "cluster")


def _step(c: str, seed: int, loc: float, scale: float, cluster_std: float, id_col: str, cluster_col: str):
    def add(acc: Column, s: Column) -> Column:
        return (acc + hash_normal(seed, F.lit("shift"), s, F.col(cluster_col), F.lit(c), mean=loc, std=scale)
                + hash_normal(seed, F.lit("noise"), s, F.col(id_col), F.lit(c), std=cluster_std))
    return add


def drift_snapshots(base: DataFrame, timestamps: Sequence[str], drift_columns: Sequence[str],
                    loc: float = 2.0, scale: float = 2.0, cluster_std: float = 2.0, seed: int = 42,
                    id_col: str = "customer_id", cluster_col: str = "cluster") -> DataFrame:
    """Snapshot k (1-based) = base + sum over steps s <= k of (cluster shift N(loc, scale) per
    (s, cluster, column) + row noise N(0, cluster_std) per (s, id, column)). The cumulative walk is
    one expression per row (unrolled over the fixed step list): no loop of jobs, ids and
    clusters unchanged. The step list is a fixed, tiny broadcast frame."""
    spark = base.sparkSession
    steps = spark.createDataFrame([(i + 1, t) for i, t in enumerate(timestamps)], "__dw_step int, __dw_ts string")
    x = base.crossJoin(F.broadcast(steps))
    out = []
    for c in base.columns:
        if c in drift_columns:
            # the step list is fixed and short: unrolled, the walk stays a plain codegen expression
            add = _step(c, seed, loc, scale, cluster_std, id_col, cluster_col)
            walk = F.lit(0.0)
            for s in range(1, len(timestamps) + 1):
                walk = walk + F.when(F.col("__dw_step") >= s, add(F.lit(0.0), F.lit(s))).otherwise(F.lit(0.0))
            out.append((F.col(c) + walk).alias(c))
        elif c == "timestamp":
            out.append(F.to_timestamp_ntz("__dw_ts").alias("timestamp"))
        else:
            out.append(F.col(c))
    return x.select(*out)
