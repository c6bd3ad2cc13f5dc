"""Registered queries driven by Structured Streaming (availableNow) over the events files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_table_path
from ..streaming.monitor import stream_profile as run_stream_profile
from ..streaming.publish import publish_stream_to, read_published
from .registry import Tables, query


def _events_source(spark, sf_dir):
    return sf_dir.rstrip("/"), "events.parquet", Tables(spark, sf_dir).events.schema


@query("publish_latest", """
SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
FROM events GROUP BY user_id
""")
def publish_latest(spark, sf_dir):
    """Triggered publish: stream the events into a serving table holding the latest row per user."""
    src_dir, glob, schema = _events_source(spark, sf_dir)
    path = new_table_path(spark, "serving_user_latest")
    publish_stream_to(spark, src_dir, glob, schema, ["user_id"], "ts", path, f"{path}-checkpoint", buckets=16)
    return read_published(spark, path).select("user_id", "ts", "event_type", "value")


@query("stream_profile", """
SELECT date_trunc('day', ts) AS window_start, count(value) AS count, round(avg(value), 6) AS avg,
       round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events GROUP BY 1
""")
def stream_profile(spark, sf_dir):
    src_dir, glob, schema = _events_source(spark, sf_dir)
    t = run_stream_profile(spark, src_dir, glob, schema, "ts", "value")
    return t.select("window_start", "count", F.round(F.col("sum") / F.col("count"), 6).alias("avg"),
                    F.round("min", 6).alias("min"), F.round("max", 6).alias("max"))
