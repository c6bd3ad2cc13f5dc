"""Keyed-table operators: key checks, merge upsert, change feed, snapshot expansion, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parse_timestamp


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def split_features(df: DataFrame, key: str | Sequence[str],
                   groups: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One projection per feature group, each carrying the key columns (pruned at the scan)."""
    keys = _as_list(key)
    return {name: df.select(*keys, *cols) for name, cols in groups.items()}


def snapshot_expand(df: DataFrame, timestamps: Sequence[str], ts_col: str = "ts",
                    fmt: str = "MM/dd/yyyy") -> DataFrame:
    """Every row once per timestamp: one scan crossed with a fixed, tiny broadcast list
    (its size is the length of ``timestamps``), instead of n unions of n scans."""
    spark = df.sparkSession
    ts = spark.createDataFrame([(s,) for s in timestamps], "s string").select(
        parse_timestamp("s", fmt).alias(ts_col))
    return df.crossJoin(F.broadcast(ts))


def primary_key_violations(df: DataFrame, keys: str | Sequence[str], count_col: str = "n") -> DataFrame:
    """Key groups that break the primary key: NULL in a key column, or more than one row."""
    ks = _as_list(keys)
    null_any = F.lit(False)
    for k in ks:
        null_any = null_any | F.col(k).isNull()
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_col))
            .where((F.col(count_col) > 1) | null_any))


def assert_primary_key(df: DataFrame, keys: str | Sequence[str]) -> None:
    """Strict mode: raise if any key is NULL or duplicated (one aggregation job, no collect of data)."""
    bad = primary_key_violations(df, keys).limit(1).count()
    if bad:
        raise ValueError(f"primary key {list(_as_list(keys))} violated")


def merge_frames(target: DataFrame, updates: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Upsert by key: matched rows take the update's values (an explicit NULL overwrites),
    columns missing from the update keep the target's value, unmatched updates are inserted,
    target-only rows stay, new columns are added (NULL where the row was not updated).

    A match flag decides, never ``coalesce`` (which would drop explicit NULLs).
    """
    ks = _as_list(keys)
    tcols, ucols = target.columns, updates.columns
    for k in ks:
        if k not in tcols or k not in ucols:
            raise ValueError(f"key {k} missing")
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    for f in updates.schema.fields:
        if f.name in ttypes and ttypes[f.name] != f.dataType:
            raise TypeError(f"column {f.name}: target {ttypes[f.name].simpleString()} "
                            f"vs update {f.dataType.simpleString()}")
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in tcols], F.lit(True).alias("__dw_in_t"))
    u = updates.select(*[F.col(c).alias(f"u__{c}") for c in ucols], F.lit(True).alias("__dw_in_u"))
    cond = None
    for k in ks:
        c = F.col(f"t__{k}") == F.col(f"u__{k}")
        cond = c if cond is None else cond & c
    j = t.join(u, cond, "full")
    matched_u = F.col("__dw_in_u").isNotNull()
    out = []
    for c in tcols:
        if c in ks:
            out.append(F.when(matched_u, F.col(f"u__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        elif c in ucols:
            out.append(F.when(matched_u, F.col(f"u__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        else:
            out.append(F.col(f"t__{c}").alias(c))
    out += [F.col(f"u__{c}").alias(c) for c in ucols if c not in tcols]
    return j.select(*out)


CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")


def change_feed(before: DataFrame, after: DataFrame, keys: str | Sequence[str],
                change_col: str = "_change_type") -> DataFrame:
    """Row-level changes between two versions of a keyed table (NULL-safe comparison).

    insert (after only), delete (before only), and for changed rows a pre-image and a
    post-image row. One full outer join on the keys; the change rows are generated with
    ``inline`` from a per-row array, no second pass.
    """
    ks = _as_list(keys)
    cols = before.columns
    if sorted(cols) != sorted(after.columns):
        raise ValueError("versions must have the same columns")
    vals = [c for c in cols if c not in ks]
    b = before.select(*[F.col(c).alias(f"b__{c}") for c in cols], F.lit(True).alias("__dw_b"))
    a = after.select(*[F.col(c).alias(f"a__{c}") for c in cols], F.lit(True).alias("__dw_a"))
    cond = None
    for k in ks:
        c = F.col(f"b__{k}") == F.col(f"a__{k}")
        cond = c if cond is None else cond & c
    j = b.join(a, cond, "full")
    changed = F.lit(False)
    for c in vals:
        changed = changed | ~F.col(f"b__{c}").eqNullSafe(F.col(f"a__{c}"))

    def image(prefix: str, kind: str):
        return F.struct(*[F.col(f"{prefix}__{c}").alias(c) for c in cols], F.lit(kind).alias(change_col))

    in_b, in_a = F.col("__dw_b").isNotNull(), F.col("__dw_a").isNotNull()
    rows = (F.when(in_b & ~in_a, F.array(image("b", "delete")))
            .when(~in_b & in_a, F.array(image("a", "insert")))
            .when(changed, F.array(image("b", "update_preimage"), image("a", "update_postimage"))))
    # unchanged rows get a NULL array, which inline turns into no rows
    return j.select(F.inline(rows))
