import datetime as dt
import time
import uuid

import pytest
from pyspark.sql import functions as F

from driftwood.sources.catalog import FeatureCatalog, append_partitioned
from driftwood.streaming.publish import BUCKET, publish_stream_to, read_published


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_catalog_merge_reads_the_table_where_it_lies(spark):
    store, name = FeatureCatalog(spark, buckets=8), f"t_{uuid.uuid4().hex[:8]}"
    first = spark.createDataFrame([(i, float(i), "a") for i in range(50)], "k long, v double, s string")
    store.create(name, first, "k", description="it's a test")
    assert store.properties(name)["primary_keys"] == ["k"] and store.properties(name)["description"] == "it's a test"
    with pytest.raises(ValueError):
        store.create(name, first, "k")
    store.merge(name, spark.createDataFrame([(1, None, 7), (99, 5.0, 8)], "k long, v double, n int"))
    store.merge(name, spark.createDataFrame([(2, -2.0)], "k long, v double"))
    got = {r.k: r for r in spark.table(name).collect()}
    assert len(got) == 51 and spark.table(name).columns == ["k", "v", "s", "n"]
    assert (got[1].v, got[1].s, got[1].n) == (None, "a", 7) and (got[99].v, got[99].s) == (5.0, None) and got[2].v == -2.0
    with pytest.raises(TypeError):
        store.merge(name, spark.createDataFrame([(1, "x")], "k long, v string"))
    with pytest.raises(ValueError):
        store.merge(name, spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, v double"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        spine = spark.range(200).withColumnRenamed("id", "k")
        plan = spine.join(spark.table(name), "k", "left")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the spine only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not store.exists(f"{name}__v0") and store.exists(f"{name}__v1")
    store.drop(name)
    assert not store.exists(name)


def test_catalog_table_from_columns(spark):
    store, name = FeatureCatalog(spark, buckets=4), f"t_{uuid.uuid4().hex[:8]}"
    store.create_empty(name, "k BIGINT, ts TIMESTAMP_NTZ, v DOUBLE", "k", "ts")
    assert spark.table(name).count() == 0
    store.merge(name, spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2.0)], "k long, ts timestamp_ntz, v double"))
    assert spark.table(name).first().v == 2.0
    with pytest.raises(KeyError):
        store.properties(f"{name}__v0")


def test_append_partitioned_log(spark):
    name = f"log_{uuid.uuid4().hex[:8]}"
    for run in ("a", "b"):
        append_partitioned(spark, name, spark.createDataFrame([(1.0, run)], "mse double, run_id string"), ["run_id"])
    assert rows_of(spark.table(name)) == [(1.0, "a"), (1.0, "b")]


def _drop_file(spark, folder, name, rows):
    """One parquet file of events, as a producer would land it."""
    spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double").coalesce(1).write.parquet(str(folder / name))


def test_restarted_publish_reads_new_files_only(spark, tmp_path):
    t = lambda d: dt.datetime(2024, 1, d)
    source, path, ckpt = tmp_path / "in", str(tmp_path / "serving"), str(tmp_path / "ckpt")
    schema = "k long, ts timestamp_ntz, v double"
    run = lambda **kw: publish_stream_to(spark, f"{source}/*", "*.parquet", schema, ["k"], "ts", path, ckpt, buckets=16, **kw)
    _drop_file(spark, source, "one", [(k, t(1), float(k)) for k in range(40)] + [(3, t(5), 3.5)])
    assert sum(p["numInputRows"] for p in run().recentProgress) == 41
    files = {p.parent.name: p.name for p in (tmp_path / "serving").rglob("part-*.parquet")}
    _drop_file(spark, source, "two", [(7, t(2), 70.0), (3, t(2), 30.0)])
    assert sum(p["numInputRows"] for p in run().recentProgress) == 2
    after = {p.parent.name: p.name for p in (tmp_path / "serving").rglob("part-*.parquet")}
    touched = {f"{BUCKET}={r[0]}" for r in spark.createDataFrame([(7,), (3,)], "k long").select(F.pmod(F.xxhash64("k"), F.lit(16))).collect()}
    assert {k for k in after if files.get(k) != after[k]} == touched
    got = {r.k: r.v for r in read_published(spark, path).collect()}
    assert len(got) == 40 and got[3] == 3.5 and got[7] == 70.0
    q = run(trigger="processingTime", processing_time="1 second")  # continuous mode
    _drop_file(spark, source, "three", [(1000, t(3), 1.0)])
    for _ in range(60):
        time.sleep(1)
        if sum(p["numInputRows"] for p in q.recentProgress):
            break
    q.stop()
    assert read_published(spark, path).count() == 41
