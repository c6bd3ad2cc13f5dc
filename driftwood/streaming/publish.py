"""Publish a feature table to its serving copy: the latest row per key, batch or streaming.

Batch: ``max_by(struct(row), ts)`` per key - a partial aggregation, so a hot key is reduced
map-side before the shuffle - then an upsert into the serving table. Streaming: the same per
micro-batch in ``foreachBatch``; combining the stored row and the batch rows with the same
``max_by`` makes a replayed batch harmless (idempotent by construction).
``trigger='availableNow'`` is the triggered mode; a processing-time trigger is the continuous mode.

The serving table of a stream is partitioned by a hash of the key: a batch reads and rewrites the partitions of its own keys
only. With a checkpoint folder of the caller's, a restarted stream takes up where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path
from ..sources.feature_store import FeatureStore


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    keys = list(keys)
    vals = [c for c in df.columns if c not in keys]
    r = df.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.struct(ts_col, *vals)).alias("__dw_r"))
    return r.select(*keys, *[F.col("__dw_r")[c].alias(c) for c in vals])


def publish_batch(store: FeatureStore, table: str, df: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    latest = latest_per_key(df, keys, ts_col)
    if not store.table_exists(table):
        store.create_table(table, primary_keys=list(keys), df=latest)
    else:
        combined = latest_per_key(store.read_table(table).unionByName(latest), keys, ts_col)
        store.write_table(table, combined, mode="overwrite")
    return store.read_table(table)


BUCKET = "__dw_bucket"


def publish_partitions(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str], ts_col: str, buckets: int = 64) -> list[int]:
    """Merge the latest rows per key into the serving table at ``path``; returns the partitions it rewrote.

    The first call makes the table; later calls must name the same number of ``buckets``.
    """
    keys = list(keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    rows = latest_per_key(df, keys, ts_col).select("*", bucket).persist()
    try:
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # ``buckets`` rows at most
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        merged = rows
        if fs.exists(p):
            held = spark.read.schema(rows.schema).parquet(path).where(F.col(BUCKET).isin(touched))
            merged = latest_per_key(held.unionByName(rows), [*keys, BUCKET], ts_col)
        if touched:
            (merged.select(rows.columns).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET).parquet(path))
    finally:
        rows.unpersist()
    return touched


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def publish_stream_to(spark: SparkSession, source_dir: str, file_glob: str, schema, keys: Sequence[str], ts_col: str, path: str,
                      checkpoint: str, trigger: str = "availableNow", processing_time: str = "1 minute", buckets: int = 64):
    """Stream new files into the serving table at ``path``, one merge a micro-batch. ``checkpoint`` is a lasting folder: a later
    run with it reads new files only. Triggered mode returns when all is published; continuous mode returns the running query."""
    src = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(source_dir)

    def merge(batch: DataFrame, batch_id: int) -> None:
        publish_partitions(batch.sparkSession, path, batch, keys, ts_col, buckets)

    w = src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=processing_time)).start()
    if trigger == "availableNow":
        q.awaitTermination()
    return q


def publish_stream(spark: SparkSession, source_dir: str, file_glob: str, schema, keys: Sequence[str], ts_col: str,
                   table: str, store: FeatureStore | None = None, trigger: str = "availableNow",
                   processing_time: str = "1 minute") -> DataFrame:
    """Stream new ``file_glob`` files in ``source_dir`` into the serving table (one merge per micro-batch)."""
    store = store or FeatureStore(spark)
    src = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(source_dir)

    def merge(batch: DataFrame, batch_id: int) -> None:
        publish_batch(store, table, batch, keys, ts_col)

    w = (src.writeStream.foreachBatch(merge)
         .option("checkpointLocation", new_table_path(spark, f"{table}_ckpt")))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=processing_time)
    q = w.start()
    if trigger == "availableNow":
        q.awaitTermination()
        return store.read_table(table)
    return q  # continuous mode: caller owns the running query
