import numpy as np
from pyspark.sql import functions as F

from driftwood.operators import drift as D


def _brute(a, b):
    xs = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    ks = np.max(np.abs(fa - fb))
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(xs))
    return ks, w1


def test_ecdf_distances_match_brute_force(spark):
    rng = np.random.default_rng(5)
    ref = np.round(rng.normal(0, 1, 700), 2)
    cur = {w: np.round(rng.normal(0.3 * w, 1 + 0.2 * w, 200 + 50 * w), 2) for w in range(4)}
    rdf = spark.createDataFrame([("c", float(v)) for v in ref], "column_name string, value double")
    cdf = spark.createDataFrame([(w, "c", float(v)) for w, vs in cur.items() for v in vs],
                                "w int, column_name string, value double")
    got = D.ecdf_distances(D.value_counts(cdf, ["w", "column_name"]), D.value_counts(rdf, ["column_name"]),
                           ["w", "column_name"], ["column_name"]).collect()
    for r in got:
        ks, w1 = _brute(cur[r["w"]], ref)
        assert abs(r["ks_statistic"] - ks) < 1e-12
        assert abs(r["wasserstein_distance"] - w1) < 1e-9


def test_identical_samples_have_no_drift(spark):
    vals = [float(i % 37) for i in range(500)]
    rdf = spark.createDataFrame([("c", v) for v in vals], "column_name string, value double")
    cdf = spark.createDataFrame([(1, "c", v) for v in vals], "w int, column_name string, value double")
    r = D.ecdf_distances(D.value_counts(cdf, ["w", "column_name"]), D.value_counts(rdf, ["column_name"]),
                         ["w", "column_name"], ["column_name"]).first()
    assert r["ks_statistic"] == 0 and abs(r["wasserstein_distance"]) < 1e-12
    edges = spark.createDataFrame([("c", [5.0, 10.0, 20.0])], "column_name string, edges array<double>")
    psi = D.psi_numeric(cdf, rdf, ["w", "column_name"], ["column_name"], edges).first()
    assert abs(psi["population_stability_index"]) < 1e-12
    p = spark.range(1).select(D.ks_pvalue(F.lit(0.0), F.lit(500), F.lit(500)).alias("p")).first()["p"]
    assert p == 1.0
