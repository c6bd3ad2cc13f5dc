import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwood.operators.prefix import exact_quantiles, running_sums


def test_running_sums_match_plain_window(spark):
    rnd = random.Random(1)
    rows = {(rnd.choice("ab"), rnd.randint(0, 5000)): rnd.randint(1, 9) for _ in range(3000)}
    df = spark.createDataFrame([(g, float(v), c) for (g, v), c in rows.items()], "g string, v double, c long")
    got = running_sums(df, ["g"], "v", ["c"], n_buckets=16, with_next=True)
    w = Window.partitionBy("g").orderBy("v")
    want = df.withColumn("cum_c", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
             .withColumn("next_v", F.lead("v").over(w))
    key = lambda r: (r["g"], r["v"])
    assert sorted(got.select("g", "v", "cum_c", "next_v").collect(), key=key) == \
        sorted(want.select("g", "v", "cum_c", "next_v").collect(), key=key)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = np.round(rng.normal(size=2001), 3)
    rows = [("x", float(v)) for v in vals] + [("x", None), ("x", float("nan"))] + [("y", 5.0)]
    df = spark.createDataFrame(rows, "g string, value double")
    probs = [0.1, 0.5, 0.9]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["g"], "value", probs, n_buckets=32).collect()}
    assert np.allclose(got["x"], np.percentile(vals, [10, 50, 90]), rtol=0, atol=1e-12)
    assert got["y"] == [5.0, 5.0, 5.0]
