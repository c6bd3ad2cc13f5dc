import numpy as np
from pyspark.sql import functions as F

from driftwood.operators import models as M
from driftwood.operators.synth import group_regression


def test_grouped_ols_with_subset_matches_numpy(spark):
    keys = spark.range(1, 7).withColumnRenamed("id", "g")
    data = group_regression(keys, "g", n_samples=40, n_features=4, seed=9)
    feats = [f"features_{j}" for j in range(4)]
    models = M.fit_grouped_ols(data, ["sku"], feats, "target", sample_fraction=0.75, seed=9).collect()
    pdf = data.toPandas()
    assert len(models) == 6
    for m in models:
        assert len(m["feature_names"]) == 3
        g = pdf[pdf.sku == m["sku"]]
        X = np.column_stack([np.ones(len(g)), g[list(m["feature_names"])].to_numpy()])
        beta = np.linalg.lstsq(X, g["target"].to_numpy(), rcond=None)[0]
        assert np.allclose([m["intercept"], *m["coef"]], beta, atol=1e-8)


def test_tiny_group_still_gets_a_model_and_scoring(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 1.0), ("b", 2.0, 3.0), ("b", 3.0, 5.0)],
                               "g string, x double, y double")
    models = M.fit_grouped_ols(df, ["g"], ["x"], "y")
    assert {r["g"] for r in models.collect()} == {"a", "b"}
    scored = {(r["g"], r["x"]): r["prediction"] for r in M.score_grouped(df, models, ["g"], ["x"]).collect()}
    assert abs(scored[("b", 2.0)] - 3.0) < 1e-9
    extra = spark.createDataFrame([("c", 1.0, 0.0)], "g string, x double, y double")
    assert M.missing_models(df.unionByName(extra), models, ["g"]).count() == 1
    lm = M.fit_linear(df.where(F.col("g") == "b"), ["x"], "y")
    assert abs(lm.coef[0] - 2.0) < 1e-9 and abs(lm.intercept + 1.0) < 1e-9


def test_groups_of_a_batch_are_solved_at_once(spark, monkeypatch):
    rows = [(k, float(x), float(x * x % 7), float(3 * x + k % 5)) for k in range(40) for x in range(k % 6 + 1)]
    df = spark.createDataFrame(rows, "g long, a double, b double, y double")
    stats = (df.groupBy("g").agg(*M._moment_aggs(["a", "b"], "y"))
             .withColumn("feature_names", M.feature_subset(F.col("g"), ["a", "b"], 0.5)))
    calls, pinv = [], np.linalg.pinv
    monkeypatch.setattr(M.np.linalg, "pinv", lambda x: calls.append(len(x)) or pinv(x))
    names = ["g", "intercept", "coef", "feature_names", "n", "metric_mse", "metric_rmse", "metric_r2"]
    got = [r for b in stats.toArrow().to_batches() for r in M._solve_groups(b, ["g"], ["a", "b"], names).to_pylist()]
    assert len(got) == 40 == sum(calls) and len(calls) <= 8
    for m in got:
        own = [r for r in rows if r[0] == m["g"]]
        x = np.array([r[1 + ["a", "b"].index(m["feature_names"][0])] for r in own])
        y = np.array([r[3] for r in own])
        slope = np.cov(x, y, bias=True)[0, 1] / x.var() if x.var() > 0 else 0.0
        assert m["n"] == len(own) and np.allclose([m["intercept"], m["coef"][0]], [y.mean() - slope * x.mean(), slope])
        assert np.isclose(m["metric_mse"], np.mean((y - m["intercept"] - slope * x) ** 2))
        assert (m["metric_r2"] is None) == (y.var() == 0)


def test_group_keys_stay_exact_beside_a_null_key(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, 1.0, 2.0), (None, 1.0, 1.0), (None, 2.0, 3.0)], "g long, x double, y double").coalesce(1)
    models = M.fit_grouped_ols(df, ["g"], ["x"], "y")
    assert {r["g"] for r in models.collect()} == {big, None}
    assert [r["g"] for r in M.missing_models(df, models, ["g"]).collect()] == [None, None]


def test_group_without_a_complete_row_has_no_coefficients(spark):
    df = spark.createDataFrame([("a", None, 2.0), ("b", 1.0, 1.0), ("b", 2.0, 3.0)], "g string, x double, y double")
    models = M.fit_grouped_ols(df, ["g"], ["x"], "y")
    by = {r["g"]: r for r in models.collect()}
    assert by["a"]["n"] == 0 and by["a"]["intercept"] is None and by["a"]["coef"] == [None] and abs(by["b"]["coef"][0] - 2.0) < 1e-9
    assert M.missing_models(df, models, ["g"]).count() == 0
