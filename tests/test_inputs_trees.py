import os
import subprocess
import sys
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driftwood.operators import models as M
from driftwood.operators import payload as PL
from driftwood.operators import prep as P
from driftwood.operators import trees as TR
from driftwood.sources.tables import read_csv_permissive, schema_from_pairs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def brute_value(nodes, x, known):
    """The forest's expectation with only the known features, by walking the nodes."""
    held = {(r.tree, r.node): r for r in nodes}

    def walk(t, n):
        r = held[t, n]
        if r.feature is None:
            return r.value
        if r.feature in known:
            return walk(t, r.left if x[r.feature] <= r.threshold else r.right)
        return sum(held[t, c].cover / r.cover * walk(t, c) for c in (r.left, r.right)) if r.cover else 0.0
    return sum(walk(t, 0) for t in {r.tree for r in nodes})


def brute_shapley(nodes, x):
    n, out = len(x), []
    for j in range(n):
        rest, total = [k for k in range(n) if k != j], 0.0
        for size in range(n):
            for s in combinations(rest, size):
                w = factorial(size) * factorial(n - size - 1) / factorial(n)
                total += w * (brute_value(nodes, x, {*s, j}) - brute_value(nodes, x, set(s)))
        out.append(total)
    return out


def test_forest_contributions_add_up_and_match_the_definition(spark):
    from driftwood.operators.mllib import fit_rf_regressor
    r = np.random.default_rng(1)
    x = np.round(r.normal(0, 1, (400, 4)), 2)
    y = x[:, 0] * 2 + (x[:, 1] > 0) * x[:, 2] + r.normal(0, 0.1, 400)
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *map(float, row), float(t)) for i, (row, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, y double")
    model = fit_rf_regressor(df, cols, "y", max_depth=3, num_trees=5)
    nodes = TR.forest_nodes(model.stages[-1])
    scored = TR.tree_attribution(model.transform(df).select("id", *cols, "prediction"), nodes, cols).orderBy("id").collect()
    held = nodes.collect()
    for row in scored:
        parts = [row[f"attr_{c}"] for c in cols]
        assert row["attr_base"] + sum(parts) == pytest.approx(row["prediction"], abs=1e-9)
        if row["id"] < 12:
            assert parts == pytest.approx(brute_shapley(held, [row[c] for c in cols]), abs=1e-9)


def test_fixed_tree_with_empty_leaves_and_a_repeated_feature(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 3), float(i)) for i in range(60)], "a double, b double, y double")
    nodes = TR.fit_fixed_tree(df, [("a", 2.0), ("a", 4.0), ("b", 0.5)], ["a", "b"], "y")
    held = nodes.collect()
    assert min(r.cover for r in held) == 0
    for row in TR.tree_attribution(df.limit(10), nodes, ["a", "b"]).collect():
        assert [row.attr_a, row.attr_b] == pytest.approx(brute_shapley(held, [row.a, row.b]), abs=1e-9)
    gaps = TR.tree_attribution(spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "a double, b double"), nodes, ["a", "b"]).collect()
    assert gaps[0].attr_a == gaps[1].attr_a


def test_strict_scoring_stops(spark):
    models = spark.createDataFrame([("x", 1.0, [2.0], ["a"]), ("y", 0.0, [1.0, 1.0], ["b", "a"]), ("z", 0.0, [1.0], ["gone"])],
                                   "g string, intercept double, coef array<double>, feature_names array<string>")
    rows = lambda *r: spark.createDataFrame(list(r), "g string, a double, b double")
    good = rows(("x", 3.0, None), ("y", 1.0, 5.0))
    assert sorted((r.g, r.prediction) for r in M.score_grouped(good, models, ["g"], ["a", "b"], strict=True).collect()) == [("x", 7.0), ("y", 6.0)]
    bad = [rows(("q", 1.0, 1.0)), rows(("y", 1.0, None)), rows(("x", float("nan"), 1.0)), rows(("z", 1.0, 1.0)), rows((None, 1.0, 1.0))]
    for d, why in zip(bad, ("no model for q", "missing feature for y", "missing feature for x", "unknown model feature for z", "no model for NULL")):
        with pytest.raises(PySparkException, match=why):
            M.score_grouped(d, models, ["g"], ["a", "b"], strict=True).collect()
    assert [r.prediction for r in M.score_grouped(bad[0].union(bad[1]).union(bad[3]), models, ["g"], ["a", "b"]).collect()] == [None] * 3


def test_many_categories_stay_off_the_driver(spark):
    df = spark.range(100_000).select(F.concat(F.lit("cat"), "id").alias("c"))
    with pytest.raises(ValueError):
        P.fit_vocabulary(df, "c")
    vocab = P.vocabulary(df, "c")
    s = vocab.agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("lo"), F.max("index").alias("hi"), F.count_distinct("index").alias("d")).first()
    assert (s.n, s.lo, s.hi, s.d) == (100_000, 0, 99_999, 100_000)
    odd = spark.createDataFrame([("cat5",), ("unseen",), (None,)], "c string")
    got = {r.c: r.c_vector for r in P.one_hot_sparse(odd, "c", vocab).collect()}
    assert len(got["cat5"].indices) == 1 and got["cat5"]["values"] == [1.0]
    assert got["unseen"].indices == got[None].indices == [] and got[None]["values"] == []


def test_sparse_rows_equal_dense_rows(spark):
    rows = [(i, float(i % 5) if i % 4 else None, "abc"[i % 3] if i % 7 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, c string")
    dense = {r.id: r for r in P.fit_preprocessor(df, ["x"], ["c"]).transform(df).collect()}
    pre = P.fit_sparse_preprocessor(df, ["x"], ["c"])
    names = {r["index"] + pre.offsets["c"]: f"c_{r.category}" for r in pre.vocabs["c"].collect()} | {0: "x"}
    for r in pre.transform(df).collect():
        got = {names[i]: v for i, v in zip(r.features.indices, r.features["values"])}
        want = {n: dense[r.id][n] for n in names.values()}
        assert r.features.size == 4 and {n: got.get(n, 0) for n in want} == pytest.approx(want)


def test_numbers_have_no_gaps(spark):
    df = spark.createDataFrame([(i % 50, "a") for i in range(120)] + [(None, "b")], "k int, s string")
    assert sorted(r["index"] for r in P.number_rows(df, ["k", "s"]).collect()) == list(range(121))


def test_malformed_requests_are_counted(spark, tmp_path):
    lines = ['{"dataframe_split":{"columns":["b","a"],"index":[0,1],"data":[["x",1],[null,"no number"]]}}', '{"dataframe_split":{"columns":["a"]',
             "", "[1,2]", '{"inputs":{"a":[1]}}', '{"dataframe_split":{"columns":["a"],"data":[[7]]}}']
    (tmp_path / "log.txt").write_text("\n".join(lines))
    log = PL.read_log(spark, str(tmp_path))
    got = PL.decode_log(log, schema_from_pairs([("a", "long"), ("b", "string")])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "x"), (None, None), (7, None)], key=repr)
    assert PL.malformed(log).count() == 4


def test_corrupt_csv_lines_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n1;2.5\nx;3\n4;\n")
    d = read_csv_permissive(spark, str(tmp_path), schema_from_pairs([("a", "int"), ("b", "double")]), sep=";").cache()
    assert [(r.a, r.b, r["_corrupt_record"]) for r in d.collect()] == [(1, 2.5, None), (None, 3.0, "x;3"), (4, None, None)]


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from driftwood.session import build_session
from driftwood.operators.models import fit_grouped_ols
spark = build_session("local[2]", 2, driver_memory="1g")
df = spark.createDataFrame([(i % 2, float(i), 2.0 * i) for i in range(20)], "g int, x double, y double")
print(sorted(round(r.coef[0], 6) for r in fit_grouped_ols(df, ["g"], ["x"], "y").collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "[2.0, 2.0]" in done.stdout, done.stderr[-2000:]


def test_lookup_refuses_a_key_held_twice(spark):
    from driftwood.operators.lookup import FeatureLookup
    spine = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    table = spark.createDataFrame([(1, "a", None), (1, "b", 1.0), (2, "c", 2.0)], "k int, f string, g double")
    assert FeatureLookup(table, "k").apply(spine).count() == 4
    with pytest.raises(PySparkException, match="twice the key 1"):
        FeatureLookup(table, "k", unique_keys=True).apply(spine).collect()
    good = FeatureLookup(table.where("f != 'b'"), "k", unique_keys=True, rename={"f": "h"}).apply(spine)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, "a", None), (2, "c", 2.0), (None, None, None)], key=repr)
