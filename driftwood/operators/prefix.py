"""Running sums over sorted values, in ranges with carried totals, and exact quantiles built on them.

A plain ``sum(...) OVER (ORDER BY v)`` without a partition puts every row in one task. Here the values of a group are
cut into ranges by the values alone, so that every use of them in a plan cuts alike and nothing is sampled: a
level is a sixteenth of a factor of two (by sign and logarithm), and a level of many rows is cut evenly
between its least and greatest value into parts of about PART_ROWS rows. Range totals are prefixed on a small table, and the
window runs inside a range. Nothing runs while a plan is built.

Inputs should hold few rows per (group, order value) - aggregate counts first - so a value that holds a third of all rows
is one row here, not a hot range. Results are exact; ranges only decide where the work is done.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Levels that a factor of two is cut into, and rows that a part of a level aims at.
OCTAVE, PART_ROWS = 16, 1 << 16
#: Level beyond every number: NULL comes before all values, NaN after.
_BEYOND = 4096 * OCTAVE
LEVEL, PART = "__dw_level", "__dw_part"


def unpivot(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
            name_col: str = "column_name", value_col: str = "value", cast: str | None = "double") -> DataFrame:
    """Wide -> long with one generator (no union of n scans)."""
    vals = [F.col(c).cast(cast) if cast else F.col(c) for c in value_cols]
    pairs = F.array(*[F.struct(F.lit(c).alias(name_col), v.alias(value_col)) for c, v in zip(value_cols, vals)])
    return df.select(*id_cols, F.inline(pairs))


def _level(v: Column) -> Column:
    """A whole number that never falls as the value grows."""
    d = v.cast("double")
    size = F.floor(F.least(F.log2(F.abs(d)), F.lit(1025.0)) * OCTAVE) + 1100 * OCTAVE
    return (F.when(d.isNull(), -_BEYOND).when(F.isnan(d), _BEYOND).when(d > 0, size).when(d < 0, -size)
            .otherwise(0).cast("int"))


def in_ranges(df: DataFrame, group_cols: Sequence[str], order_col: str, n_buckets: int = 4096) -> DataFrame:
    """Adds the range (``LEVEL``, ``PART``) of each row; ``n_buckets`` is the most parts of a level."""
    g = [*group_cols, LEVEL]
    d = df.withColumn(LEVEL, _level(F.col(order_col)))
    v = F.col(order_col).cast("double")
    spans = (d.groupBy(*g).agg(F.min(v).alias("__dw_lo"), F.max(v).alias("__dw_hi"), F.count(F.lit(1)).alias("__dw_n"))
             .where((F.col("__dw_n") > PART_ROWS) & (F.col("__dw_hi") > F.col("__dw_lo"))))
    share = (v - F.col("__dw_lo")) / (F.col("__dw_hi") - F.col("__dw_lo"))
    parts = F.least(F.lit(n_buckets), F.ceil(F.col("__dw_n") / PART_ROWS))
    return (d.join(spans, g, "left").withColumn(PART, F.coalesce(F.floor(share * parts).cast("int"), F.lit(0)))
            .drop("__dw_lo", "__dw_hi", "__dw_n"))


def running(df: DataFrame, group_cols: Sequence[str], order_col: str, sums: Mapping[str, str | Column],
            totals: bool = False, most: Mapping[str, Column] | None = None, ahead: Sequence[str] = ()) -> DataFrame:
    """Running sums of the rows in ``in_ranges``: ``cum_<name>`` over all rows of the group whose order value is no greater.

    ``totals`` adds ``all_<name>`` over the whole group; ``most`` columns with the greatest value in the group;
    ``ahead`` adds ``next_<c>`` for columns of the next row (for groups with one row an order value). ``sums`` names
    what is added up; the ranges' columns stay, for another pass.
    """
    g, b, most = list(group_cols), [*group_cols, LEVEL, PART], dict(most or {})
    names = list(sums)
    val = {n: F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    aggs = [F.sum(val[n]).alias(f"__dw_t_{n}") for n in names] + [F.max(c).alias(f"__dw_m_{n}") for n, c in most.items()]
    if ahead:
        aggs.append(F.min_by(F.struct(*ahead), order_col).alias("__dw_first"))
    tot = df.groupBy(*b).agg(*aggs)
    part = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    w = part.orderBy(LEVEL, PART)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(f"__dw_t_{n}").over(before), F.lit(0)).alias(f"__dw_o_{n}") for n in names]
    if totals:
        cols += [F.sum(f"__dw_t_{n}").over(part).alias(f"all_{n}") for n in names]
    cols += [F.max(f"__dw_m_{n}").over(part).alias(n) for n in most]
    if ahead:
        cols.append(F.lead("__dw_first").over(w).alias("__dw_then"))
    d = df.join(tot.select(*b, *cols), b)
    inside = Window.partitionBy(*b).orderBy(order_col)
    so_far = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    new = {f"cum_{n}": F.col(f"__dw_o_{n}") + F.sum(val[n]).over(so_far) for n in names}
    if ahead:
        new["__dw_ahead"] = F.coalesce(F.lead(F.struct(*ahead)).over(inside), F.col("__dw_then"))
    d = d.withColumns(new)
    if ahead:
        d = d.withColumns({f"next_{c}": F.col("__dw_ahead")[c] for c in ahead})
    return d.drop(*[f"__dw_o_{n}" for n in names], "__dw_ahead", "__dw_then")


def running_sums(df: DataFrame, group_cols: Sequence[str], order_col: str, sum_cols: Sequence[str],
                 n_buckets: int = 4096, with_next: bool = False) -> DataFrame:
    """Adds ``cum_<c>`` = sum of c over rows with order value <= this row's, per group, and
    (``with_next``) ``next_<order_col>`` = the next larger order value in the group or NULL."""
    d = in_ranges(df, group_cols, order_col, n_buckets)
    return running(d, group_cols, order_col, {c: c for c in sum_cols}, ahead=[order_col] if with_next else ()).drop(LEVEL, PART)


def quantiles_of_counts(counts: DataFrame, group_cols: Sequence[str], value_col: str, count_col: str,
                        probs: Sequence[float], n_buckets: int = 4096) -> DataFrame:
    """Exact linear-interpolation quantiles of (group, value, count) rows, one a value: group cols, ``quantiles``, ``n``."""
    g = list(group_cols)
    ranked = running(in_ranges(counts, g, value_col, n_buckets), g, value_col, {"dw_c": count_col}, totals=True)
    aggs, quantiles = quantile_aggs(value_col, "cum_dw_c", "all_dw_c", probs)
    r = ranked.groupBy(*g).agg(*aggs) if g else ranked.agg(*aggs)
    return r.select(*g, quantiles.alias("quantiles"), F.col("__dw_all").alias("n"))


def quantile_aggs(value_col: str, cum_col: str, all_col: str, probs: Sequence[float]) -> tuple[list[Column], Column]:
    """Aggregates over rows with running and total counts, and the array of quantiles made from them."""
    def pos(p, n):  # 0-based position; the value at rank r is the smallest with a running count over r
        return F.lit(float(p)) * (n - 1)

    aggs = [F.first(all_col).alias("__dw_all")]
    for i, p in enumerate(probs):
        at = pos(p, F.col(all_col))
        aggs += [F.min(F.when(F.col(cum_col) > f(at), F.col(value_col))).alias(f"__dw_q{i}{x}") for x, f in (("lo", F.floor), ("hi", F.ceil))]

    def value(i, p):
        at, lo, hi = pos(p, F.col("__dw_all")), F.col(f"__dw_q{i}lo"), F.col(f"__dw_q{i}hi")
        return lo + (at - F.floor(at)) * (hi - lo)
    return aggs, F.array(*[value(i, p) for i, p in enumerate(probs)])


def exact_quantiles(long: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], n_buckets: int = 4096) -> DataFrame:
    """Exact linear-interpolation quantiles (same as SQL ``percentile`` / ``quantile_cont``)
    per group; NULL and NaN values are ignored. Returns group cols + ``quantiles`` array<double>
    + ``n`` (count of values used)."""
    clean = long.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))
    counts = clean.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("__dw_c"))
    return quantiles_of_counts(counts, group_cols, value_col, "__dw_c", probs, n_buckets)
