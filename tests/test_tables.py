import pytest

from driftwood.operators.tables import change_feed, merge_frames, primary_key_violations


def test_merge_semantics(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k long, s string, x double")
    u = spark.createDataFrame([(2, None, "new"), (4, 40.0, "ins")], "k long, x double, extra string")
    got = {r["k"]: r.asDict() for r in merge_frames(t, u, "k").collect()}
    assert got[1] == {"k": 1, "s": "a", "x": 1.0, "extra": None}
    assert got[2] == {"k": 2, "s": "b", "x": None, "extra": "new"}   # explicit NULL overwrites
    assert got[4] == {"k": 4, "s": None, "x": 40.0, "extra": "ins"}
    once = merge_frames(t, u, "k")
    twice = merge_frames(once, u, "k")
    assert sorted(once.collect()) == sorted(twice.collect())        # idempotent
    assert primary_key_violations(twice, "k").count() == 0


def test_merge_type_conflict(spark):
    t = spark.createDataFrame([(1, 1.0)], "k long, x double")
    u = spark.createDataFrame([(1, "1")], "k long, x string")
    with pytest.raises(TypeError):
        merge_frames(t, u, "k")


def test_change_feed(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    a = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (3, None)], "k long, v string")
    got = sorted((r["k"], r["v"], r["_change_type"]) for r in change_feed(b, a, "k").collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "insert")]
    got = sorted((r["k"], r["_change_type"]) for r in change_feed(a, b, "k").collect())
    assert (4, "delete") in got


def test_pk_violations(spark):
    d = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 3)], "a long, b long")
    got = sorted((r["a"], r["b"], r["n"]) for r in primary_key_violations(d, ["a", "b"]).collect())
    assert got == [(1, 1, 2), (2, None, 1)]
