import random

from pyspark.sql import functions as F

from driftwood.operators import payload as PL
from driftwood.operators import prep as P
from driftwood.operators.registry import promote


def test_stratified_split_counts_and_stability(spark):
    df = spark.range(0, 5003).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = P.stratified_split(df, "y", "id")
    counts = {(r["y"], r["split"]): r["count"] for r in a.groupBy("y", "split").count().collect()}
    for y in (0, 1):
        n = counts[(y, "test")] + counts[(y, "train")]
        assert counts[(y, "test")] == int(0.2 * n + 0.5)
    b = P.stratified_split(df.repartition(17), "y", "id")
    assert sorted(a.collect()) == sorted(b.collect())


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert P.mode_values(df, ["s"]).first()["s"] == "a"


def _replay(scores):
    prod, aliases, deleted, versions = None, {}, set(), []
    for v, s in enumerate(scores, start=1):
        if not versions:
            prod = v
            aliases = {"production": v}
        else:
            aliases["staging"] = v
            if s >= scores[prod - 1]:
                aliases["archived"] = prod
                aliases["production"] = v
                aliases.pop("staging")
                if prod - 1 in versions and prod - 1 not in deleted:
                    deleted.add(prod - 1)
                prod = v
        versions.append(v)
    return {v: k for k, v in aliases.items()}, deleted


def test_promotion_matches_step_replay(spark):
    rnd = random.Random(11)
    for trial in range(6):
        scores = [round(rnd.random(), 1) for _ in range(rnd.randint(1, 9))]
        df = spark.createDataFrame([("m", str(i + 1), s) for i, s in enumerate(scores)],
                                   "name string, version string, val_auc_score double")
        got = {r["version"]: (r["alias"], r["deleted"]) for r in promote(df).collect()}
        alias, deleted = _replay(scores)
        for v in range(1, len(scores) + 1):
            assert got[v] == (alias.get(v), v in deleted), (scores, v)


def test_payload_roundtrip_nan_as_null(spark):
    df = spark.createDataFrame([(1, 0, "a", float("nan")), (2, 0, "b", 2.5), (3, 1, None, 1.0)],
                               "id long, b long, s string, x double")
    enc = PL.encode_split(df, "b", "id", ["id", "s", "x"])
    assert "NaN" not in "".join(r["request"] for r in enc.collect())
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    got = sorted(tuple(r) for r in PL.decode_split(enc, "request", schema).drop("index").collect())
    assert got == [(1, "a", None), (2, "b", 2.5), (3, None, 1.0)]
    rec = PL.decode_records(PL.encode_records(df, "b", "id", ["id", "s", "x"]), "request", schema)
    assert sorted(tuple(r) for r in rec.collect()) == got


def test_stratified_split_keeps_rows_without_a_label(spark):
    from driftwood.operators.prep import stratified_split
    rows = [(i, "ab"[i % 2] if i % 5 else None) for i in range(500)]
    got = stratified_split(spark.createDataFrame(rows, "id int, label string"), "label", "id", 0.3)
    assert got.count() == 500
    for label in ("a", "b", None):
        own = [r for r in got.collect() if r.label == label]
        assert sum(r.split == "test" for r in own) == int(0.3 * len(own) + 0.5)
    assert stratified_split(spark.createDataFrame([], "id int, label string"), "label", "id").count() == 0
    few = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, label string")
    assert [stratified_split(few, "label", "id", f).where("split = 'test'").count() for f in (0.0, 0.5, 1.0)] == [0, 2, 3]
