"""Incremental monitoring: recompute only touched windows, and a Structured Streaming profile.

Source rows and metric rows are tables partitioned by day (``land``, ``store_profile``): a refresh scans the days that
received new rows and replaces the metric rows of those days, by dynamic partition overwrite; files of other days are neither
read nor written. Replacing whole days makes a repeated refresh harmless.

Per-window statistics are independent, so a refresh recomputes the windows that received new
rows and keeps the rest. The streaming form keeps mergeable per-window sums in state
(watermark + window aggregation) and upserts each micro-batch into a window-keyed table via
an idempotent ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import profile_metrics
from ..session import new_table_path
from ..sources.feature_store import FeatureStore
from ..sources.tables import write_parquet


def refresh_profile(existing: DataFrame, full: DataFrame, new_rows: DataFrame, numeric: Sequence[str],
                    ts_col: str, granularity: str = "1 day") -> DataFrame:
    """existing profile rows for untouched windows + recomputed rows for windows with new data.
    The semi-join on touched windows lets a day-partitioned source prune to those days."""
    touched = new_rows.select(F.window(ts_col, granularity)["start"].alias("__dw_ws")).distinct()
    affected = (full.withColumn("__dw_fs", F.window(ts_col, granularity)["start"])
                .join(touched, F.col("__dw_fs") == F.col("__dw_ws"), "left_semi").drop("__dw_fs"))
    fresh = profile_metrics(affected, numeric, [], ts_col, granularity, "INPUT")
    kept = (existing.withColumn("__dw_es", F.col("window.start"))
            .join(touched, F.col("__dw_es") == F.col("__dw_ws"), "left_anti").drop("__dw_es"))
    return kept.unionByName(fresh)


def land(rows: DataFrame, path: str, ts_col: str) -> list[str]:
    """Append rows to the source table at ``path``, partitioned by ``day``; returns the days they touch, as text."""
    stamped = rows.withColumn("day", F.to_date(ts_col))
    days = [r[0] for r in stamped.select(F.col("day").cast("string")).distinct().collect()]  # at most one row a calendar day
    write_parquet(stamped.repartition("day"), path, "append", ["day"])
    return days


def source_days(spark: SparkSession, path: str, days: Sequence[str | None]) -> DataFrame:
    """Rows of some days of a landed table: a partition filter, so other days' files are not opened."""
    table = spark.read.parquet(path)
    known = [F.lit(d).cast("date") for d in days if d is not None]
    keep = F.col("day").isin(*known) if known else F.lit(False)
    return table.where(keep | F.col("day").isNull() if None in days else keep)


def store_profile(profile: DataFrame, path: str) -> None:
    """Write profile rows by the day of their window; days that are written are replaced, all others stay."""
    (profile.withColumn("day", F.to_date("window.start")).repartition("day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def refresh_stored_profile(spark: SparkSession, source_path: str, metric_path: str, days: Sequence[str | None],
                           numeric: Sequence[str], ts_col: str, categorical: Sequence[str] = ()) -> DataFrame:
    """Recompute the daily profile of ``days`` from the landed source and replace these days of the stored metric table."""
    rows = source_days(spark, source_path, days).drop("day")
    store_profile(profile_metrics(rows, numeric, categorical, ts_col, "1 day", "INPUT"), metric_path)
    return spark.read.parquet(metric_path).drop("day")


def _session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def ntz_as_instant(c: Column, spark: SparkSession) -> Column:
    """Zone-less wall clock -> the instant whose UTC rendering is that wall clock (watermarks
    need TIMESTAMP; this keeps windows aligned to the wall-clock day in any session zone)."""
    return F.to_utc_timestamp(c.cast("timestamp"), _session_tz(spark))


def instant_as_ntz(c: Column, spark: SparkSession) -> Column:
    return F.from_utc_timestamp(c, _session_tz(spark)).cast("timestamp_ntz")


def stream_profile(spark: SparkSession, source_dir: str, file_glob: str, schema, ts_col: str, value_col: str,
                   granularity: str = "1 day", watermark: str = "1 day", table: str | None = None,
                   store: FeatureStore | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a streaming per-window profile of ``value_col`` over ``file_glob`` files in ``source_dir`` with
    ``availableNow`` (process what is there, then stop) and return the window-keyed result table.
    Rows later than the watermark are dropped by Spark's state eviction [decision]. With a ``checkpoint`` folder of
    the caller's (and the same ``table``) a later run takes up where the last one stopped; without one every run starts anew."""
    store = store or FeatureStore(spark)
    table = table or f"stream_profile_{new_table_path(spark, 'x').rsplit('-', 1)[-1]}"
    src = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(source_dir)
    t = ntz_as_instant(F.col(ts_col), spark)
    agg = (src.withColumn("__dw_t", t).withWatermark("__dw_t", watermark)
           .groupBy(F.window("__dw_t", granularity).alias("w"))
           .agg(F.count(value_col).alias("count"), F.sum(value_col).alias("sum"),
                F.min(value_col).alias("min"), F.max(value_col).alias("max")))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(instant_as_ntz(F.col("w.start"), spark).alias("window_start"),
                            instant_as_ntz(F.col("w.end"), spark).alias("window_end"),
                            "count", "sum", "min", "max")
        if not store.table_exists(table):
            store.create_table(table, primary_keys="window_start", df=rows)
        else:
            # update mode re-emits whole window rows, so a merge by window key is idempotent per batch id
            store.write_table(table, rows, mode="merge")

    q = (agg.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", checkpoint or new_table_path(spark, "stream_profile_ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return store.read_table(table)
