"""Linear models (one, or one per group), native scoring, attributions, MLlib tree models.

Grouped OLS: one shuffle. Per group the JVM aggregates the co-moments (``covar_pop`` of every
feature pair and with the target, means, ``var_pop`` of the target, count) - mergeable,
numerically stable sums, p*p numbers per group. A numpy pseudo-inverse of all small systems of
an Arrow batch then solves them inside ``mapInArrow`` (no extra shuffle, never on the driver, no Python step a group).
Models stay a table (group, intercept, coef[], feature_names[], metrics); scoring is a join
plus a flat native sum, inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_text
from ..session import ship_package
from .evaluate import regression_report


def _moment_aggs(features: Sequence[str], target: str) -> list[Column]:
    """Moments over the complete rows: all features and the target are there and are numbers."""
    p = len(features)
    y = F.col(target).cast("double")
    xs = [F.col(f).cast("double") for f in features]
    whole = F.lit(True)
    for c in [*xs, y]:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    y, xs = F.when(whole, y), [F.when(whole, x) for x in xs]
    return [F.count(F.when(whole, 1)).alias("__dw_n"),
            F.array(*[F.avg(x) for x in xs]).alias("__dw_mx"),
            F.avg(y).alias("__dw_my"),
            F.var_pop(y).alias("__dw_vy"),
            # the same two columns in the same order are one aggregate
            F.array(*[F.covar_pop(xs[min(i, j)], xs[max(i, j)]) for i in range(p) for j in range(p)]).alias("__dw_cxx"),
            F.array(*[F.covar_pop(x, y) for x in xs]).alias("__dw_cxy")]


def _solve(cxx: np.ndarray, cxy: np.ndarray, mx: np.ndarray, my: float, vy: float, idx: np.ndarray):
    sub = cxx[np.ix_(idx, idx)]
    beta = np.linalg.pinv(sub) @ cxy[idx]
    intercept = my - float(beta @ mx[idx])
    mse = max(vy - float(beta @ cxy[idx]), 0.0)
    r2 = 1.0 - mse / vy if vy > 0 else None
    return intercept, beta, mse, r2


def _solve_groups(b: pa.RecordBatch, keys: Sequence[str], features: Sequence[str], names: Sequence[str]) -> pa.RecordBatch:
    """The models of a batch of groups, a row of moments each; all have equally many features. A group without a complete row has
    a row without coefficients."""
    n, p = b.num_rows, len(features)

    def numbers(c: str, *shape: int) -> np.ndarray:
        col = b.column(c).flatten() if shape else b.column(c)
        return col.to_numpy(zero_copy_only=False).astype(float).reshape(n, *shape)

    def rows(values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.float64(), from_pandas=True)

    idx = pc.index_in(b.column("feature_names").flatten(), pa.array(features)).to_numpy().reshape(n, -1)
    cxx = numbers("__dw_cxx", p, p)[np.arange(n)[:, None, None], idx[:, :, None], idx[:, None, :]]
    cxy, mx = (np.take_along_axis(numbers(c, p), idx, axis=1) for c in ("__dw_cxy", "__dw_mx"))
    my, vy = numbers("__dw_my"), numbers("__dw_vy")
    none = numbers("__dw_n") == 0
    cxx[none] = 0
    beta = (np.linalg.pinv(cxx) @ cxy[:, :, None])[:, :, 0]
    mse = np.maximum(vy - (beta * cxy).sum(axis=1), 0.0)
    r2 = 1.0 - np.divide(mse, vy, out=np.full(n, np.nan), where=vy > 0)
    ends = pa.array(np.arange(n + 1) * idx.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [*[b.column(k) for k in keys], rows(my - (beta * mx).sum(axis=1)), pa.ListArray.from_arrays(ends, rows(beta.ravel())),
         b.column("feature_names"), b.column("__dw_n"), rows(mse), rows(np.sqrt(mse)), rows(r2)], names=list(names))


@dataclass
class LinearModel:
    """y = intercept + sum(coef_i * x_i) over named feature columns."""
    features: list[str]
    coef: list[float]
    intercept: float

    def expr(self) -> Column:
        out = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coef):
            out = out + F.lit(float(c)) * F.col(f).cast("double")
        return out

    def score(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise ValueError(f"missing features {missing}")
        return df.withColumn(output, self.expr())

    def score_struct(self, row: Column) -> Column:
        """Model as a column function over a struct of all columns; extra fields are ignored."""
        out = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coef):
            out = out + F.lit(float(c)) * row.getField(f).cast("double")
        return out


def fit_linear(df: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Ordinary least squares with intercept; the p*p moment row is the only thing collected."""
    features = list(features)
    r = df.agg(*_moment_aggs(features, target)).first()
    p = len(features)
    cxx = np.array(r["__dw_cxx"], dtype=float).reshape(p, p)
    intercept, beta, _, _ = _solve(cxx, np.array(r["__dw_cxy"], dtype=float), np.array(r["__dw_mx"], dtype=float),
                                   float(r["__dw_my"]), float(r["__dw_vy"]), np.arange(p))
    return LinearModel(features, [float(b) for b in beta], float(intercept))


def feature_subset(group_key: Column, features: Sequence[str], fraction: float | None, seed: int = 42) -> Column:
    """Each group's own part of the features: so many of them, rounded down but one at least, as ``fraction`` says, in order of
    md5(seed|group|feature). Without a fraction every group has all."""
    names = F.array(*[F.lit(f) for f in features])
    if fraction is None:
        return names
    if fraction <= 0 or fraction > 1:
        raise ValueError(f"a fraction of {fraction} of the features: it must be over 0 and up to 1")
    k = max(math.floor(fraction * len(features)), 1)
    keyed = F.transform(names, lambda n: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), group_key.cast("string"), n)).alias("h"),
                                                  n.alias("n")))
    return F.slice(F.transform(F.array_sort(keyed), lambda s: s["n"]), 1, k)


def fit_grouped_ols(df: DataFrame, group_cols: Sequence[str], features: Sequence[str], target: str,
                    sample_fraction: float | None = None, seed: int = 42) -> DataFrame:
    """One OLS model per group. Output: group cols, intercept, coef, feature_names, n,
    metric_mse, metric_rmse, metric_r2 (training fit). Groups with n <= p still get a row
    (minimum-norm solution)."""
    g, features = list(group_cols), list(features)
    p = len(features)
    gkey = g[0] if len(g) == 1 else F.concat_ws("|", *[F.col(c).cast("string") for c in g])
    stats = (df.groupBy(*g).agg(*_moment_aggs(features, target))
             .withColumn("feature_names", feature_subset(F.col(gkey) if isinstance(gkey, str) else gkey,
                                                         features, sample_fraction, seed)))
    key_fields = [f for f in stats.schema.fields if f.name in g]
    out_schema = T.StructType([*key_fields,
                               T.StructField("intercept", T.DoubleType()),
                               T.StructField("coef", T.ArrayType(T.DoubleType())),
                               T.StructField("feature_names", T.ArrayType(T.StringType())),
                               T.StructField("n", T.LongType()),
                               T.StructField("metric_mse", T.DoubleType()),
                               T.StructField("metric_rmse", T.DoubleType()),
                               T.StructField("metric_r2", T.DoubleType())])
    ship_package(df.sparkSession)
    own = [f.name for f in key_fields]

    def solve_batches(batches):
        for b in batches:
            if b.num_rows:
                yield _solve_groups(b, own, features, out_schema.names)

    return stats.mapInArrow(solve_batches, out_schema)


def score_grouped(df: DataFrame, models: DataFrame, group_cols: Sequence[str], features: Sequence[str],
                  output: str = "prediction", strict: bool = False) -> DataFrame:
    """Per-key model lookup (equi-join on the group) and a flat sum over the features, inside code generation.

    Coefficients are put in the order of ``features`` once a model, before the join. Rows whose group has no model get
    NULL (list them with ``missing_models``), as do rows that lack a feature of their model, and models with a feature that is not
    in ``features``. ``strict`` raises an error from the task instead, naming the key.
    """
    g, features = list(group_cols), list(features)
    coef = [F.get("coef", F.array_position("feature_names", F.lit(f)).cast("int") - 1).alias(f"__dw_c{i}") for i, f in enumerate(features)]
    other = F.size(F.array_except("feature_names", F.array(*[F.lit(f) for f in features]))) > 0
    m = models.select(*g, F.col("intercept").alias("__dw_b0"), other.alias("__dw_other"), *coef)
    j = df.join(m, on=g, how="left")
    total, lacks = F.col("__dw_b0"), F.lit(False)
    for i, f in enumerate(features):
        c, x = F.col(f"__dw_c{i}"), F.col(f).cast("double")
        total = total + F.when(c.isNull(), 0.0).otherwise(c * x)
        lacks = lacks | (c.isNotNull() & (x.isNull() | F.isnan(x)))
    if strict:
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in g])
        stop = lambda why: F.raise_error(F.concat(F.lit(f"{why} "), key)).cast("double")
        pred = (F.when(F.col("__dw_b0").isNull(), stop("no model for")).when(F.col("__dw_other"), stop("unknown model feature for"))
                .when(lacks, stop("missing feature for")).otherwise(total))
    else:
        pred = F.when(~F.col("__dw_other"), total)
    return j.withColumn(output, pred).drop("__dw_b0", "__dw_other", *[f"__dw_c{i}" for i in range(len(features))])


def missing_models(df: DataFrame, models: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Rows whose group key has no model (left anti join)."""
    return df.join(models.select(*group_cols), on=list(group_cols), how="left_anti")


def check_features(df: DataFrame, features: Sequence[str]) -> None:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"scoring frame lacks model features {missing}")


def grouped_ols_metrics(df: DataFrame, models: DataFrame, group_cols: Sequence[str],
                        features: Sequence[str], target: str) -> DataFrame:
    """Training-fit metrics per group including MAE (a second pass over the rows)."""
    scored = score_grouped(df, models, group_cols, features, "__dw_pred")
    return regression_report(scored, target, "__dw_pred", group_cols)


def linear_attribution(df: DataFrame, model: LinearModel, means: dict[str, float],
                       prefix: str = "attr_") -> DataFrame:
    """Exact Shapley values of a linear model with independent features: coef_i * (x_i - mean_i)."""
    out = df
    for f, c in zip(model.features, model.coef):
        out = out.withColumn(f"{prefix}{f}", F.lit(float(c)) * (F.col(f).cast("double") - F.lit(float(means[f]))))
    return out


def permuted_column(df: DataFrame, col: str, id_col: str, seed: int = 7, n_buckets: int = 4096) -> DataFrame:
    """Replace ``col`` with a seeded permutation of its values: the row of rank r in one hash order gets the value of the
    row of rank r in another. Ranks are global; the hash is cut into ``n_buckets`` ranges only to spread the sorting, so the
    result does not depend on their number or on the size or partitioning of the table."""
    from pyspark.sql import Window

    def ranked(kind: str) -> DataFrame:
        h = hash_text(seed, id_col, F.lit(kind))
        bucket = F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * F.lit(n_buckets)).cast("int")
        d = df.withColumn("__dw_h", h).withColumn("__dw_b", bucket)
        before = Window.orderBy("__dw_b").rowsBetween(Window.unboundedPreceding, -1)
        sizes = d.groupBy("__dw_b").agg(F.count(F.lit(1)).alias("__dw_c"))  # n_buckets rows at most
        starts = sizes.select("__dw_b", F.coalesce(F.sum("__dw_c").over(before), F.lit(0)).alias("__dw_s"))
        w = Window.partitionBy("__dw_b").orderBy("__dw_h", id_col)
        return (d.withColumn("__dw_r", F.row_number().over(w)).join(F.broadcast(starts), "__dw_b")
                .withColumn("__dw_r", F.col("__dw_r") + F.col("__dw_s")).drop("__dw_h", "__dw_b", "__dw_s"))

    rows = ranked("row").drop(col)
    return rows.join(ranked("val").select("__dw_r", F.col(col)), "__dw_r").drop("__dw_r")
