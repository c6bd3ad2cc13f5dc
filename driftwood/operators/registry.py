"""Model-version bookkeeping as tables: promotion aliases, latest version, run logs, schema contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def promote(versions: DataFrame, name_col: str = "name", version_col: str = "version",
            score_col: str = "val_auc_score") -> DataFrame:
    """Champion/challenger replay over versions registered in order.

    The first version becomes 'production'. Each later version is 'staging'; if its score is
    >= the current champion's it takes 'production', the old champion gets 'archived',
    staging is cleared and version (old champion - 1) is deleted if registered. The champion
    after version k is therefore the newest version holding the running maximum score, which
    a window computes per model name without replaying step by step.
    Output: name, version, score, alias (production / archived / staging / NULL), deleted.
    """
    v = versions.select(F.col(name_col).alias("name"), F.col(version_col).cast("int").alias("version"),
                        F.col(score_col).cast("double").alias("score"))
    w = Window.partitionBy("name").orderBy("version")
    prev_best = F.max("score").over(w.rowsBetween(Window.unboundedPreceding, -1))
    is_first = F.row_number().over(w) == 1
    v = v.withColumn("swap", is_first | (F.col("score") >= prev_best))
    v = v.withColumn("champ", F.last(F.when(F.col("swap"), F.col("version")), ignorenulls=True)
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = v.withColumn("old_champ", F.lag("champ").over(w))
    v = v.withColumn("is_last", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("version"))) == 1)
    final = v.where("is_last").select("name", F.col("champ").alias("f_champ"),
                                      F.col("version").alias("f_last"), F.col("swap").alias("f_last_swap"))
    archived = v.where(F.col("swap") & F.col("old_champ").isNotNull()).select(
        "name", F.col("version").alias("swap_version"), F.col("old_champ").alias("arch"))
    deleted = v.where(F.col("swap") & F.col("old_champ").isNotNull()).select(
        "name", (F.col("old_champ") - 1).alias("version")).withColumn("deleted", F.lit(True))
    j = (v.join(final, "name")
         .join(archived.withColumnRenamed("swap_version", "f_champ"), ["name", "f_champ"], "left")
         .join(deleted, ["name", "version"], "left"))
    alias = (F.when(F.col("version") == F.col("f_champ"), F.lit("production"))
             .when(F.col("version") == F.col("arch"), F.lit("archived"))
             .when((F.col("version") == F.col("f_last")) & ~F.col("f_last_swap"), F.lit("staging")))
    return j.select("name", "version", "score", alias.alias("alias"),
                    F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted"))


def latest_version(versions: DataFrame, name_col: str = "name", version_col: str = "version") -> DataFrame:
    """Highest version per model; versions are text holding integers, so compare as int."""
    return versions.groupBy(name_col).agg(F.max(F.col(version_col).cast("int")).alias("latest_version"))


def runs_long(frames: Mapping[str, tuple[DataFrame, Sequence[str]]], run_col: str) -> DataFrame:
    """Run log rows (run_id, kind, key, value) from per-kind frames holding run_col + value columns."""
    parts = []
    for kind, (df, cols) in frames.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in cols])
        parts.append(df.select(F.col(run_col).alias("run_id"), F.lit(kind).alias("kind"), F.inline(pairs)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def runs_pivot(runs: DataFrame, keys: Sequence[str], metric_keys: Sequence[str] = ()) -> DataFrame:
    """One row per run, one column per logged key (metrics cast back to double)."""
    wide = runs.groupBy("run_id").pivot("key", list(keys)).agg(F.first("value"))
    return wide.select("run_id", *[(F.col(k).cast("double") if k in metric_keys else F.col(k)).alias(k)
                                   for k in keys])


def schema_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Compare a frame with a (name -> type) contract: one row per missing, extra or
    type-mismatched column; for mismatches, how many values fail to cast to the contract type."""
    actual = dict(df.dtypes)
    spark = df.sparkSession
    rows, bad_counts = [], []
    for name, typ in contract.items():
        if name not in actual:
            rows.append((name, typ, None, "missing"))
        elif actual[name] != typ:
            rows.append((name, typ, actual[name], "type_mismatch"))
            bad_counts.append(F.sum((F.col(name).isNotNull() & F.col(name).try_cast(typ).isNull())
                                    .cast("long")).alias(name))
    for name, typ in actual.items():
        if name not in contract:
            rows.append((name, None, typ, "extra"))
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("expected_type", T.StringType()),
                           T.StructField("actual_type", T.StringType()),
                           T.StructField("status", T.StringType())])
    report = spark.createDataFrame(rows, schema)
    if not bad_counts:
        return report.withColumn("bad_values", F.lit(None).cast("long"))
    counts = df.agg(*bad_counts)  # one row, one pass over the data
    names = [r[0] for r in rows if r[3] == "type_mismatch"]
    long = counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("bad_values"))
                                            for n in names])))
    return report.join(F.broadcast(long), "column_name", "left")
