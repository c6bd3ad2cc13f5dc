import __spark_entry__ as E


def test_drift_covers_five_snapshots_of_three_columns(spark):
    d = E.queries()["inject_drift"](spark, "/root/testdata/sf0.001")
    moved = [c for c in d.columns if c.startswith("feature_") and c != "feature_3"]
    keys = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey").distinct().count()
    assert len(moved) == 3 and d.select("timestamp").distinct().count() == 5 and d.count() == 5 * keys
