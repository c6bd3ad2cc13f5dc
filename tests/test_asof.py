import datetime as dt
import random

from pyspark.sql import functions as F

from driftwood.operators.asof import asof_join, asof_join_plain


def T(d, h=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)


def _rows(df, key):
    return sorted(df.collect(), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_edge_cases(spark):
    feats = spark.createDataFrame(
        [(1, T(0), 10.0), (1, T(2), 12.0), (1, T(9), 19.0), (2, T(1), 21.0), (None, T(0), 99.0), (3, None, 31.0)],
        "k long, ts timestamp_ntz, f double")
    spine = spark.createDataFrame(
        [(1, T(2), "eq"), (1, T(1), "mid"), (1, T(-1), "before"), (1, T(30), "after"), (1, T(30), "after"),
         (2, T(0), "before2"), (None, T(5), "nullkey"), (1, None, "nullts"), (3, T(5), "nofeat")],
        "k long, t timestamp_ntz, tag string")
    out = {r["tag"]: r["f"] for r in asof_join(spine, feats, "k", "k", "t", "ts", bucket_days=1).collect()}
    assert out == {"eq": 12.0, "mid": 10.0, "before": None, "after": 19.0, "before2": None,
                   "nullkey": None, "nullts": None, "nofeat": None}
    assert asof_join(spine, feats, "k", "k", "t", "ts").count() == spine.count()


def test_hot_key_across_buckets_matches_plain(spark):
    rnd = random.Random(3)
    feats = [(rnd.choice([1, 1, 1, 2, 3]), T(rnd.randint(0, 60), rnd.randint(0, 23)), float(i)) for i in range(400)]
    feats = list({(k, t): (k, t, f) for k, t, f in feats}.values())
    spine = [(rnd.choice([1, 1, 2, 3, 4]), T(rnd.randint(-5, 70), rnd.randint(0, 23)), i) for i in range(300)]
    f = spark.createDataFrame(feats, "k long, ts timestamp_ntz, f double")
    s = spark.createDataFrame(spine, "k long, t timestamp_ntz, i long")
    want = _rows(asof_join_plain(s, f, "k", "k", "t", "ts"), "i")
    for days in (1, 3, 100):
        assert _rows(asof_join(s, f, "k", "k", "t", "ts", bucket_days=days), "i") == want


def test_one_busy_week_of_one_key_is_cut(spark, monkeypatch):
    """A third of all rows have one key and one week: ranges stay within four times the median, results stay the same."""
    import statistics

    from driftwood.operators import asof
    rnd = random.Random(8)
    other = [(k, T(rnd.randint(0, 60), rnd.randint(0, 23)), float(i)) for i, k in enumerate([*range(40)] * 50)]
    busy = [(99, T(17) + dt.timedelta(seconds=rnd.randint(0, 6 * 86400)), float(i)) for i in range(1000)]
    feats = list({(k, t): (k, t, f) for k, t, f in other + busy}.values())
    f = spark.createDataFrame(feats, "k long, ts timestamp_ntz, f double")
    s = spark.createDataFrame([(rnd.choice([99, 99, *range(45)]), T(rnd.randint(-5, 70), rnd.randint(0, 23)), i) for i in range(400)],
                              "k long, t timestamp_ntz, i long")
    want = _rows(asof_join_plain(s, f, "k", "k", "t", "ts"), "i")
    monkeypatch.setattr(asof, "PART_ROWS", 8)
    monkeypatch.setattr(asof, "HOT_SHARE", 300)
    assert _rows(asof_join(s, f, "k", "k", "t", "ts"), "i") == want
    rows = f.withColumn("week", asof.time_bucket(f["ts"], 7))
    sizes = [r["count"] for r in asof.cut_busy_buckets(rows, ["k"], "week", "ts").groupBy("k", "week", asof._PART).count().collect()]
    assert max(r["count"] for r in rows.groupBy("k", "week").count().collect()) >= 900
    assert max(sizes) <= 4 * statistics.median(sizes)
    kinds = f.select("k", F.col("ts").cast("timestamp").alias("ts"), "f"), s.select("k", F.col("t").cast("timestamp").alias("t"), "i")
    got = asof_join(kinds[1], kinds[0], "k", "k", "t", "ts").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert _rows(got, "i") == want
