"""Data preparation: seeded splits, imputation, scaling, one-hot encoding, a column transformer.

Fitted state (medians, means, deviations, modes) is a one-row DataFrame joined back with a
broadcast cross join - its size is one row by construction. Category vocabularies are
distinct values of one column: a list for an encoder that makes a column each, a table for sparse vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_text, hash_uniform
from .prefix import exact_quantiles, unpivot

# -- splits -----------------------------------------------------------------------------

_HIST_HEX = 4  # 16 bits of the md5 order key -> 65,536 buckets per label


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """Per label, rows ordered by md5(seed|id); the first round(test_fraction * n_label) are 'test'.

    A histogram of the first 16 hash bits per label (small) finds the bucket of each label's cut, and only the rows of that bucket
    are ranked, to find the last test row. The table itself is then split in one pass against one cut a label: it is never
    shuffled. Rows of one label and id fall on one side of the cut; rows without a label are a label of their own.
    """
    h = hash_text(seed, id_col)
    d = df.withColumn("__dw_h", h).withColumn(
        "__dw_b", F.conv(F.substring("__dw_h", 1, _HIST_HEX), 16, 10).cast("int"))
    label = F.struct(F.col(label_col)).alias("__dw_l")  # a struct is never NULL, so a NULL label can be joined
    hist = d.groupBy(label, "__dw_b").agg(F.count(F.lit(1)).alias("__dw_c"))
    w = Window.partitionBy("__dw_l").orderBy("__dw_b")
    hist = (hist.withColumn("__dw_cum", F.sum("__dw_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("__dw_n", F.sum("__dw_c").over(Window.partitionBy("__dw_l")))
            .withColumn("__dw_k", F.floor(F.lit(float(test_fraction)) * F.col("__dw_n") + F.lit(0.5))))
    before = F.col("__dw_cum") - F.col("__dw_c")
    whole = hist.groupBy("__dw_l").agg(F.max(F.when(F.col("__dw_cum") <= F.col("__dw_k"), F.col("__dw_b"))).alias("__dw_whole"))
    part = hist.where((before < F.col("__dw_k")) & (F.col("__dw_cum") > F.col("__dw_k"))).select(
        "__dw_l", "__dw_b", (F.col("__dw_k") - before).alias("__dw_need"))
    wc = Window.partitionBy("__dw_l").orderBy("__dw_h", id_col)
    last = (d.select(label, "__dw_b", "__dw_h", id_col).join(part, ["__dw_l", "__dw_b"])
            .withColumn("__dw_r", F.row_number().over(wc)).where(F.col("__dw_r") == F.col("__dw_need"))
            .select("__dw_l", F.col("__dw_h").alias("__dw_last"), F.col(id_col).alias("__dw_id")))
    cuts = whole.join(last, "__dw_l", "left")  # a row a label
    j = d.withColumn("__dw_l", label).join(cuts, "__dw_l")
    up_to = (F.col("__dw_h") < F.col("__dw_last")) | ((F.col("__dw_h") == F.col("__dw_last")) & (F.col(id_col) <= F.col("__dw_id")))
    test = F.coalesce(F.col("__dw_b") <= F.col("__dw_whole"), F.lit(False)) | F.coalesce(up_to, F.lit(False))
    return j.select(*df.columns, F.when(test, F.lit("test")).otherwise(F.lit("train")).alias(split_col))


def random_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """'test' when the seeded hash uniform of the id is below test_fraction; stable on recompute."""
    return df.withColumn(split_col, F.when(hash_uniform(seed, id_col) < F.lit(float(test_fraction)),
                                           F.lit("test")).otherwise(F.lit("train")))


# -- imputation / scaling ---------------------------------------------------------------------

def median_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: exact median of each column (NULL/NaN ignored), named after the column."""
    long = unpivot(df, [], list(cols))
    q = exact_quantiles(long, ["column_name"], "value", [0.5])
    return q.groupBy().pivot("column_name", list(cols)).agg(F.first(F.col("quantiles")[0]))


def mode_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: most frequent non-NULL value of each column; ties go to the smallest value."""
    long = unpivot(df, [], list(cols), cast="string")
    counts = (long.where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c")))
    top = counts.groupBy("column_name").agg(F.max("c").alias("top"))
    modes = (counts.join(top, "column_name").where(F.col("c") == F.col("top"))
             .groupBy("column_name").agg(F.min("value").alias("mode")))
    return modes.groupBy().pivot("column_name", list(cols)).agg(F.first("mode"))


def impute(df: DataFrame, values: DataFrame, cols: Sequence[str], nan_as_missing: bool = True) -> DataFrame:
    """Replace NULL (and NaN for numbers) with the fitted value of a one-row ``values`` frame."""
    v = values.select(*[F.col(c).alias(f"__dw_fill_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(v))
    out = []
    types = dict(df.dtypes)
    for c in df.columns:
        if c in cols:
            fill = F.col(f"__dw_fill_{c}").cast(types[c])
            missing = F.col(c).isNull()
            if nan_as_missing and types[c] in ("double", "float"):
                missing = missing | F.isnan(c)
            out.append(F.when(missing, fill).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation per column (the scaler's fitted state)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std_pop; a constant column (std 0) is only centred."""
    j = df.crossJoin(F.broadcast(stats))
    out = []
    for c in df.columns:
        if c in cols:
            std = F.col(f"{c}__std")
            out.append(((F.col(c) - F.col(f"{c}__mean")) /
                        F.when(std == 0, F.lit(1.0)).otherwise(std)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# -- one-hot ----------------------------------------------------------------------------------

#: Categories up to which an encoder makes a column each.
MOST_COLUMNS = 10_000


def fit_vocabulary(df: DataFrame, col: str, most: int = MOST_COLUMNS) -> list[str]:
    """Sorted distinct non-NULL categories (the encoder's fitted state; one value per output column). More than ``most``
    are refused, before they are collected: such a column wants ``vocabulary`` and ``one_hot_sparse``."""
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} categories: use one_hot_sparse")
    return sorted(r[0] for r in rows)


def number_rows(df: DataFrame, order_cols: Sequence[str], name: str = "index") -> DataFrame:
    """Adds 0, 1, 2, ... without gaps, in order of (first 12 bits of the MD5 of the columns, the columns): unique by
    construction. Rows are ranked inside 4,096 ranges of the digest, whose sizes are prefixed on a table of as many rows."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in order_cols]))
    d = df.withColumn("__dw_r", F.substring(digest, 1, 3))
    before = Window.partitionBy(F.lit(0)).orderBy("__dw_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = (d.groupBy("__dw_r").agg(F.count(F.lit(1)).alias("__dw_n"))
              .select("__dw_r", F.coalesce(F.sum("__dw_n").over(before), F.lit(0)).alias("__dw_s")))
    inside = Window.partitionBy("__dw_r").orderBy(*order_cols)
    return (d.withColumn("__dw_i", F.row_number().over(inside) - 1).join(F.broadcast(starts), "__dw_r")
            .withColumn(name, F.col("__dw_s") + F.col("__dw_i")).drop("__dw_r", "__dw_i", "__dw_s"))


def vocabulary(df: DataFrame, col: str) -> DataFrame:
    """(category, index) of the distinct non-NULL values of a column, as a table: any number of them."""
    return number_rows(df.where(F.col(col).isNotNull()).select(F.col(col).alias("category")).distinct(), ["category"])


def one_hot_sparse(df: DataFrame, col: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """One-hot vectors as (indices, values) arrays against a vocabulary table; unknown or NULL gives empty arrays."""
    at = vocab.select(F.col("category").alias(col), F.col("index").alias("__dw_i"))
    name, none = out or f"{col}_vector", F.array().cast("array<double>")
    known = F.col("__dw_i").isNotNull()
    pair = F.struct(F.when(known, F.array("__dw_i")).otherwise(F.array().cast("array<bigint>")).alias("indices"),
                    F.when(known, F.array(F.lit(1.0))).otherwise(none).alias("values"))
    return df.join(at, col, "left").withColumn(name, pair).select(*df.columns, name)


def one_hot(df: DataFrame, col: str, vocabulary: Sequence[str], drop_input: bool = True) -> DataFrame:
    """One 0/1 integer column per known category; unknown or NULL gives all zeros."""
    new = [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{col}_{v}") for v in vocabulary]
    keep = [c for c in df.columns if not (drop_input and c == col)]
    return df.select(*keep, *new)


# -- column transformer -----------------------------------------------------------------------

@dataclass
class Preprocessor:
    """Numeric: median impute then standard scale. Categorical: mode impute then one-hot."""
    numeric: list[str]
    categorical: list[str]
    medians: DataFrame
    scale: DataFrame
    modes: DataFrame | None
    vocab: dict[str, list[str]]

    def transform(self, df: DataFrame) -> DataFrame:
        out = impute(df, self.medians, self.numeric)
        out = standard_scale(out, self.scale, self.numeric)
        if self.categorical:
            out = impute(out, self.modes, self.categorical)
            for c in self.categorical:
                out = one_hot(out, c, self.vocab[c])
        return out

    def feature_names(self) -> list[str]:
        return self.numeric + [f"{c}_{v}" for c in self.categorical for v in self.vocab[c]]


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocessor:
    numeric, categorical = list(numeric), list(categorical)
    medians = median_values(df, numeric)
    imputed = impute(df, medians, numeric)
    scale = scaler_stats(imputed, numeric)
    modes = mode_values(df, categorical) if categorical else None
    filled = impute(df.select(*categorical), modes, categorical) if categorical else None
    vocab = {c: fit_vocabulary(filled, c) for c in categorical}
    return Preprocessor(numeric, categorical, medians, scale, modes, vocab)


@dataclass
class SparsePreprocessor:
    """As ``Preprocessor``, with vocabularies of any size: rows become (indices, values) of their non-zero features. Numeric
    features come first, then the categories of each column in turn (``offsets``)."""
    numeric: list[str]
    categorical: list[str]
    medians: DataFrame
    scale: DataFrame
    modes: DataFrame | None
    vocabs: dict[str, DataFrame]
    offsets: dict[str, int]
    size: int

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with imputed, scaled and encoded columns in one sparse vector; its other columns stay."""
        d = standard_scale(impute(df, self.medians, self.numeric), self.scale, self.numeric)
        if self.categorical:
            d = impute(d, self.modes, self.categorical)
        for c in self.categorical:
            d = one_hot_sparse(d, c, self.vocabs[c], f"__dw_{c}")
        at = [F.array(*[F.lit(i).cast("long") for i in range(len(self.numeric))])]
        at += [F.transform(F.col(f"__dw_{c}.indices"), lambda i: i + F.lit(self.offsets[c])) for c in self.categorical]  # noqa: B023
        values = [F.array(*[F.col(c).cast("double") for c in self.numeric]), *[F.col(f"__dw_{c}.values") for c in self.categorical]]
        keep = [c for c in df.columns if c not in self.numeric and c not in self.categorical]
        return d.select(*keep, F.struct(F.lit(self.size).alias("size"), F.concat(*at).alias("indices"), F.concat(*values).alias("values")).alias(out))


def fit_sparse_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SparsePreprocessor:
    numeric, categorical = list(numeric), list(categorical)
    medians = median_values(df, numeric)
    scale = scaler_stats(impute(df, medians, numeric), numeric)
    modes = mode_values(df, categorical) if categorical else None
    vocabs = {c: vocabulary(impute(df.select(*categorical), modes, categorical), c) for c in categorical}
    offsets, size = {}, len(numeric)
    for c in categorical:
        offsets[c], size = size, size + vocabs[c].count()
    return SparsePreprocessor(numeric, categorical, medians, scale, modes, vocabs, offsets, size)
