"""Point-in-time (as-of) join: for each spine row, the newest feature row with ts <= as-of time.

Spark has no public as-of join (the private ``_joinAsOf`` plans a nested-loop join), so it is
expressed with a union + running ``last`` window. The window runs per (key, time bucket, part): a bucket that holds more than
1 / HOT_SHARE of all rows, as one busy week of one key may, is cut evenly by time into parts, by its own row count.
There are at most HOT_SHARE such buckets, so their list is broadcast. The last feature of earlier ranges is carried forward on a
small table with a row a range and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PAYLOAD = "__dw_payload"
_SIDE = "__dw_side"
_T = "__dw_t"
_BKT = "__dw_bkt"
_PART = "__dw_part"
#: Rows below which a bucket is never cut, and the share of all rows (one in so many) above which it is.
PART_ROWS, HOT_SHARE = 1 << 16, 1000


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def time_bucket(ts: Column, bucket_days: int) -> Column:
    """Monotone day-number bucket; works for TIMESTAMP and TIMESTAMP_NTZ without time-zone shifts."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return F.floor(days / F.lit(bucket_days)).cast("long")


def _position(df: DataFrame, t: str) -> Column:
    """A number that never falls as the time (or other order value) grows."""
    kind = dict(df.dtypes)[t]
    if kind == "timestamp_ntz":  # without going through a zone, whose clock changes would break the order
        day = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("double")
        return day * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    if kind == "date":
        return F.datediff(t, F.lit("1970-01-01").cast("date")).cast("double")
    return F.col(t).cast("double")


def cut_busy_buckets(rows: DataFrame, keys: Sequence[str], bucket: str, t: str, part: str = _PART) -> DataFrame:
    """Adds ``part`` (0, 1, ... in order of ``t``): 0 but in the (keys, bucket) groups with the most rows, which are cut by time."""
    g = [*keys, bucket]
    at = _position(rows, t)
    known = F.col(t).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    sizes = rows.where(known).groupBy(*g).agg(F.count(F.lit(1)).alias("__dw_n"), F.min(at).alias("__dw_lo"), F.max(at).alias("__dw_hi"))
    most = sizes.agg(F.greatest(F.lit(PART_ROWS), F.floor(F.sum("__dw_n") / HOT_SHARE)).alias("__dw_most"))
    busy = sizes.crossJoin(F.broadcast(most)).where((F.col("__dw_n") > F.col("__dw_most")) & (F.col("__dw_hi") > F.col("__dw_lo")))
    share = (at - F.col("__dw_lo")) / (F.col("__dw_hi") - F.col("__dw_lo"))
    cut = F.floor(share * F.ceil(F.col("__dw_n") / F.col("__dw_most"))).cast("int")
    return (rows.join(F.broadcast(busy), g, "left").withColumn(part, F.coalesce(cut, F.lit(0)))
            .drop("__dw_n", "__dw_lo", "__dw_hi", "__dw_most"))


def asof_join(spine: DataFrame, features: DataFrame,
              spine_keys: str | Sequence[str], feature_keys: str | Sequence[str] | None,
              spine_ts: str, feature_ts: str,
              feature_names: Sequence[str] | None = None,
              prefix: str = "", bucket_days: int = 7,
              spine_bucket: str | None = None, feature_bucket: str | None = None) -> DataFrame:
    """Left as-of join. Equality counts (feature ts == as-of ts matches).

    NULL key or NULL as-of time in the spine gives NULL features; feature rows with NULL key or
    time never match. Duplicate spine rows survive. The feature table's own time column is not
    returned. ``feature_names`` defaults to every non-key, non-time feature column.
    ``spine_bucket``/``feature_bucket`` name precomputed, order-compatible bucket columns to use
    instead of day buckets (for non-time order keys such as ranks).
    """
    skeys = _as_list(spine_keys)
    fkeys = _as_list(feature_keys) if feature_keys is not None else skeys
    if len(skeys) != len(fkeys):
        raise ValueError("spine and feature key lists differ in length")
    if feature_names is None:
        feature_names = [c for c in features.columns if c not in fkeys and c != feature_ts]
    out_names = [prefix + c for c in feature_names]
    clash = set(out_names) & set(spine.columns)
    if clash:
        raise ValueError(f"feature columns clash with spine columns: {sorted(clash)}")

    key_cols = [f"__dw_k{i}" for i in range(len(skeys))]
    payload = F.struct(*[F.col(c).alias(o) for c, o in zip(feature_names, out_names)])

    feat = (features
            .where(F.col(feature_ts).isNotNull())
            .where(F.lit(True) if not fkeys else
                   F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in fkeys)))
            .select(*[F.col(k).alias(kc) for k, kc in zip(fkeys, key_cols)],
                    F.col(feature_ts).alias(_T), payload.alias(_PAYLOAD),
                    (F.col(feature_bucket) if feature_bucket else time_bucket(F.col(feature_ts), bucket_days))
                    .cast("long").alias(_BKT)))

    spine_cols = spine.columns
    sp = spine.select(*[F.col(k).alias(kc) for k, kc in zip(skeys, key_cols)],
                      F.col(spine_ts).alias(_T), F.struct(*[F.col(c) for c in spine_cols]).alias("__dw_row"),
                      (F.col(spine_bucket) if spine_bucket else time_bucket(F.col(spine_ts), bucket_days))
                      .cast("long").alias(_BKT))
    # rows without a key or time match nothing: spread them, they must not meet in one window
    lost = F.col(_T).isNull()
    for k in key_cols:
        lost = lost | F.col(k).isNull()
    sp = sp.withColumn(_BKT, F.when(lost, F.xxhash64("__dw_row")).otherwise(F.col(_BKT)))

    # Level 1: running last feature inside each range, features before spine on equal time.
    unioned = (feat.select(*key_cols, _BKT, _T, F.lit(0).alias(_SIDE), _PAYLOAD,
                           F.lit(None).cast(sp.schema["__dw_row"].dataType).alias("__dw_row"))
               .unionByName(sp.select(*key_cols, _BKT, _T, F.lit(1).alias(_SIDE),
                                      F.lit(None).cast(feat.schema[_PAYLOAD].dataType).alias(_PAYLOAD),
                                      "__dw_row")))
    ready = spine_bucket and feature_bucket
    unioned = unioned.withColumn(_PART, F.lit(0)) if ready else cut_busy_buckets(unioned, key_cols, _BKT, _T)
    ranges = [*key_cols, _BKT, _PART]
    w1 = (Window.partitionBy(*ranges).orderBy(F.col(_T), F.col(_SIDE), F.col(_PAYLOAD))  # equal times: the greatest row
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (unioned.withColumn("__dw_local", F.last(_PAYLOAD, ignorenulls=True).over(w1))
             .where(F.col(_SIDE) == 1)
             .select(*ranges, "__dw_row", "__dw_local"))

    # Level 2: last feature of each range (partial aggregation, small), carried to the later ranges of the key.
    w2 = Window.partitionBy(*key_cols).orderBy(_BKT, _PART).rowsBetween(Window.unboundedPreceding, -1)
    known = F.col(_T).isNotNull()
    for k in key_cols:
        known = known & F.col(k).isNotNull()
    newest = F.max_by(_PAYLOAD, F.when(F.col(_SIDE) == 0, F.struct(_T, _PAYLOAD)))
    carry = (unioned.where(known).groupBy(*ranges).agg(newest.alias(_PAYLOAD))
             .withColumn("__dw_carry", F.last(_PAYLOAD, ignorenulls=True).over(w2)).where(F.col("__dw_carry").isNotNull())
             .select(*ranges, "__dw_carry"))

    joined = local.join(carry, on=ranges, how="left")
    best = F.coalesce(F.col("__dw_local"), F.col("__dw_carry"))
    return joined.select(*[F.col("__dw_row")[c].alias(c) for c in spine_cols],
                         *[best[o].alias(o) for o in out_names])


def asof_join_plain(spine: DataFrame, features: DataFrame, spine_keys, feature_keys,
                    spine_ts: str, feature_ts: str, feature_names=None, prefix: str = "") -> DataFrame:
    """Unbucketed form (one window partition per key). Kept as the test reference for asof_join."""
    skeys = _as_list(spine_keys)
    fkeys = _as_list(feature_keys) if feature_keys is not None else skeys
    if feature_names is None:
        feature_names = [c for c in features.columns if c not in fkeys and c != feature_ts]
    out_names = [prefix + c for c in feature_names]
    key_cols = [f"__dw_k{i}" for i in range(len(skeys))]
    payload = F.struct(*[F.col(c).alias(o) for c, o in zip(feature_names, out_names)])
    feat = (features.where(F.col(feature_ts).isNotNull())
            .select(*[F.col(k).alias(kc) for k, kc in zip(fkeys, key_cols)],
                    F.col(feature_ts).alias(_T), F.lit(0).alias(_SIDE), payload.alias(_PAYLOAD)))
    sp = spine.select(*[F.col(k).alias(kc) for k, kc in zip(skeys, key_cols)],
                      F.col(spine_ts).alias(_T), F.lit(1).alias(_SIDE),
                      F.struct(*[F.col(c) for c in spine.columns]).alias("__dw_row"))
    u = (feat.withColumn("__dw_row", F.lit(None).cast(sp.schema["__dw_row"].dataType))
         .unionByName(sp.withColumn(_PAYLOAD, F.lit(None).cast(feat.schema[_PAYLOAD].dataType))))
    w = (Window.partitionBy(*key_cols).orderBy(_T, _SIDE, _PAYLOAD)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = u.withColumn("__dw_m", F.last(_PAYLOAD, ignorenulls=True).over(w)).where(F.col(_SIDE) == 1)
    return r.select(*[F.col("__dw_row")[c].alias(c) for c in spine.columns],
                    *[F.col("__dw_m")[o].alias(o) for o in out_names])
