"""Registered queries: seeded generators keyed by driver-table keys (suppliers, customers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import synth as S
from .registry import Tables, query

SEED = 42
N_FEATURES_GROUPS = 10
N_FEATURES_BLOBS = 20
DRIFT_TIMESTAMPS = [f"2024-{day} 12:00:00" for day in ("03-04", "03-11", "03-18", "03-25", "04-01")]
DRIFT_COLUMNS = ["feature_5", "feature_7", "feature_9"]


def _u(parts: str, first: int = 1) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(concat_ws('|', {parts})), {first}, 8)) AS BIGINT) AS DOUBLE)"
            " / CAST(4294967296 AS DOUBLE)")


def _n(parts: str, mean: float = 0.0, std: float = 1.0) -> str:
    h = f"md5(concat_ws('|', {parts}))"
    u1 = (f"((CAST(CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))"
          " / CAST(4294967296 AS DOUBLE))")
    u2 = f"(CAST(CAST(('0x' || substr({h}, 9, 8)) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))"
    z = f"(sqrt(-2.0 * ln({u1})) * cos(CAST(6.283185307179586 AS DOUBLE) * {u2}))"
    return f"(CAST({mean!r} AS DOUBLE) + CAST({std!r} AS DOUBLE) * {z})"


def _groups_sql() -> str:
    feats = ",\n       ".join(
        f"round({_n(f"'{SEED}', 'x', CAST(g AS VARCHAR), CAST(sample AS VARCHAR), '{j}'")}, 6) AS features_{j}"
        for j in range(N_FEATURES_GROUPS))
    target = " + ".join(
        f"{_n(f"'{SEED}', 'beta', CAST(g AS VARCHAR), '{j}'")} * "
        f"{_n(f"'{SEED}', 'x', CAST(g AS VARCHAR), CAST(sample AS VARCHAR), '{j}'")}"
        for j in range(N_FEATURES_GROUPS))
    eps = _n(f"'{SEED}', 'eps', CAST(g AS VARCHAR), CAST(sample AS VARCHAR)")
    return f"""
WITH k AS (SELECT DISTINCT l_suppkey AS g FROM lineitem),
r AS (SELECT g, CAST(unnest(range(0, 100)) AS INTEGER) AS sample FROM k)
SELECT 'sku_' || lpad(CAST(g AS VARCHAR), CAST(greatest(2, length(CAST(g AS VARCHAR))) AS INTEGER), '0') AS sku, sample,
       {feats},
       round({target} + 1.0 * {eps}, 6) AS target
FROM r"""


@query("synthetic_groups", _groups_sql())
def synthetic_groups(spark, sf_dir):
    d = S.group_regression(Tables(spark, sf_dir).lineitem, "l_suppkey", 100, N_FEATURES_GROUPS, 1.0, SEED)
    return d.select("sku", "sample", *[F.round(c, 6).alias(c) for c in d.columns if c.startswith("features_")],
                    F.round("target", 6).alias("target"))


def _blobs_cte() -> str:
    feats = ",\n       ".join(
        f"-10.0 + 20.0 * {_u(f"'{SEED}', 'centre', CAST(cluster AS VARCHAR), '{j}'")}"
        f" + 1.0 * {_n(f"'{SEED}', 'x', CAST(k AS VARCHAR), '{j}'")} AS feature_{j}"
        for j in range(N_FEATURES_BLOBS))
    return f"""
k AS (SELECT DISTINCT c_custkey AS k FROM customer),
kc AS (SELECT k, CAST(floor({_u(f"'{SEED}', 'cluster', CAST(k AS VARCHAR)")} * 4) AS INTEGER) AS cluster FROM k),
b AS (SELECT md5(concat_ws('|', '{SEED}', 'id', CAST(k AS VARCHAR))) AS customer_id,
             TIMESTAMP '2026-02-01 00:00:00' AS timestamp, {feats}, cluster FROM kc)"""


@query("synthetic_clusters", f"""
WITH {_blobs_cte()}
SELECT customer_id, timestamp, {", ".join(f"round(feature_{j}, 6) AS feature_{j}" for j in range(N_FEATURES_BLOBS))},
       cluster FROM b
""")
def synthetic_clusters(spark, sf_dir):
    b = S.blobs(Tables(spark, sf_dir).customer, "c_custkey", N_FEATURES_BLOBS, 4, 1.0, SEED)
    return b.select("customer_id", "timestamp",
                    *[F.round(f"feature_{j}", 6).alias(f"feature_{j}") for j in range(N_FEATURES_BLOBS)], "cluster")


def _drift_sql() -> str:
    steps = ", ".join(f"({i + 1}, TIMESTAMP '{t}')" for i, t in enumerate(DRIFT_TIMESTAMPS))

    def walk(c: str) -> str:
        shift = _n(f"'{SEED}', 'shift', CAST(s AS VARCHAR), CAST(cluster AS VARCHAR), '{c}'", 2.0, 2.0)
        noise = _n(f"'{SEED}', 'noise', CAST(s AS VARCHAR), customer_id, '{c}'", 0.0, 2.0)
        return f"list_sum(list_transform(range(1, step + 1), lambda s: {shift} + {noise}))"
    cols = ", ".join(f"round({c} + {walk(c)}, 6) AS {c}" for c in DRIFT_COLUMNS)
    return f"""
WITH {_blobs_cte()},
st AS (SELECT * FROM (VALUES {steps}) v(step, ts))
SELECT customer_id, st.ts AS timestamp, {cols}, round(feature_3, 6) AS feature_3, cluster
FROM b, st"""


@query("inject_drift", _drift_sql())
def inject_drift(spark, sf_dir):
    b = S.blobs(Tables(spark, sf_dir).customer, "c_custkey", N_FEATURES_BLOBS, 4, 1.0, SEED)
    d = S.drift_snapshots(b, DRIFT_TIMESTAMPS, DRIFT_COLUMNS, 2.0, 2.0, 2.0, SEED)
    return d.select("customer_id", "timestamp", *[F.round(c, 6).alias(c) for c in DRIFT_COLUMNS],
                    F.round("feature_3", 6).alias("feature_3"), "cluster")
