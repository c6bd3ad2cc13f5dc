"""Inputs the driver's tables do not hold: gaps, ties, other partitionings."""

import pytest
from pyspark.sql import functions as F

from driftwood.functions.columns import normalize_name
from driftwood.operators.asof import asof_join
from driftwood.operators.models import _moment_aggs, permuted_column
from driftwood.streaming.publish import latest_per_key


@pytest.mark.parametrize("name, want", [("CustomerID", "customer_i_d"), ("StreamingTV", "streaming_t_v"), ("a b-c", "a_b_c"),
                                        ("Total (sum)", "total_sum"), ("x_Y", "x_y"), ("", "")])
def test_normalize_name(name, want):
    assert normalize_name(name) == want


def test_moments_use_complete_rows(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(5)] + [(None, 1000.0), (float("nan"), 7.0), (3.0, None)],
                               "x double, y double")
    m = df.agg(*_moment_aggs(["x"], "y")).first()
    assert m["__dw_n"] == 5 and m["__dw_mx"] == [2.0] and m["__dw_my"] == 5.0
    assert m["__dw_cxy"][0] / m["__dw_cxx"][0] == pytest.approx(2.0)


def test_permutation_ignores_partitioning_and_buckets(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") * 3).alias("v"))
    a = {r.id: r.v for r in permuted_column(df, "v", "id").collect()}
    b = {r.id: r.v for r in permuted_column(df.repartition(7), "v", "id", n_buckets=5).collect()}
    assert a == b and sorted(a.values()) == [3 * i for i in range(500)] and a != {i: 3 * i for i in range(500)}


def test_ties_take_the_greatest_row_whatever_the_order(spark):
    rows = [(1, 10, 1.0), (1, 10, 2.0)]
    for order in (rows, rows[::-1]):
        f = spark.createDataFrame(order, "k int, t int, v double").withColumn("t", F.timestamp_seconds("t"))
        s = spark.createDataFrame([(1, 20), (None, 20)], "k int, t int").withColumn("t", F.timestamp_seconds("t"))
        got = {r.k: r.v for r in asof_join(s, f, ["k"], ["k"], "t", "t", ["v"]).collect()}
        assert got == {1: 2.0, None: None}
        assert latest_per_key(f, ["k"], "t").first().v == 2.0
