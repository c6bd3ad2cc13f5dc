import numpy as np
import pytest

from driftwood.operators import profile as PR
from driftwood.operators import prefix
from driftwood.operators.prefix import running_sums

SCHEMA = "ts timestamp_ntz, x double, kind string"


def _rows(rng, days, per_day, shift=0.0):
    import datetime as dt
    start = dt.datetime(2024, 3, 1)
    out = []
    for d in range(days):
        for i in range(per_day):
            x = float(np.round(rng.normal(shift + 0.2 * d, 2), 1))
            out.append((start + dt.timedelta(days=d, seconds=int(rng.integers(86400))),
                        None if i % 11 == 0 else float("nan") if i % 13 == 0 else x, "abc"[int(rng.integers(3))]))
    return out


def test_building_the_tables_runs_no_job(spark):
    df = spark.createDataFrame(_rows(np.random.default_rng(1), 3, 40), SCHEMA)
    sc = spark.sparkContext
    sc.setJobGroup("monitor-build", "no job may start")
    prof, drift = PR.monitor(df, "ts", ["x"], ["kind"], "1 day", df)
    assert len(sc.statusTracker().getJobIdsForGroup("monitor-build")) == 0
    assert drift.columns and prof.columns
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_time_are_kept(spark):
    rows = _rows(np.random.default_rng(2), 2, 30)
    rows += [(None, 5.0, "a"), (None, None, "b"), (None, 7.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    prof = PR.profile_metrics(df, ["x"], ["kind"], "ts")
    assert sum(r["count"] + r["num_nulls"] for r in prof.where("column_name = 'x'").collect()) == len(rows)
    lost = {r["column_name"]: r for r in prof.where("window is null").collect()}
    assert (lost["x"]["count"], lost["x"]["num_nulls"], lost["x"]["median"], lost["x"]["log_type"]) == (2, 1, 6.0, "INPUT")
    assert (lost["kind"]["count"], lost["kind"]["distinct_count"]) == (2, 2)
    drift = PR.drift_metrics(df, df, ["x"], ["kind"], "ts")
    assert drift.where("window is null").count() == 2
    assert PR.drift_metrics(df, None, ["x"], [], "ts", drift_type="CONSECUTIVE").where("window is null").count() == 0


def test_nan_and_null_are_no_values(spark):
    rows = _rows(np.random.default_rng(3), 1, 300)
    r = PR.profile_metrics(spark.createDataFrame(rows, SCHEMA), ["x"], [], "ts").first()
    x = np.array([v for _, v, _ in rows if v is not None and v == v])
    nan = sum(v is not None and v != v for _, v, _ in rows)
    assert (r["count"], r["num_nulls"], r["num_nan"]) == (len(x) + nan, 300 - len(x) - nan, nan)
    assert r["distinct_count"] == len(set(x)) and r["num_zeros"] == int((x == 0).sum())
    assert np.allclose([r["avg"], r["median"], *r["quantiles"]], [x.mean(), np.median(x), *np.percentile(x, range(10, 100, 10))])


@pytest.mark.parametrize("kind", ["BASELINE", "CONSECUTIVE"])
@pytest.mark.parametrize("part_rows", [16, 1 << 16])
def test_drift_matches_brute_force(spark, monkeypatch, kind, part_rows):
    monkeypatch.setattr(prefix, "PART_ROWS", part_rows)
    rng = np.random.default_rng(4)
    rows, base = _rows(rng, 4, 150), _rows(rng, 2, 200, 0.5)
    got = PR.drift_metrics(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(base, SCHEMA), ["x"], [], "ts",
                           drift_type=kind).collect()
    clean = lambda rs: np.sort([v for _, v, _ in rs if v is not None and v == v])
    days = sorted({t.date() for t, *_ in rows})
    by_day = {d: clean([r for r in rows if r[0].date() == d]) for d in days}
    ref = {d: clean(base) for d in days} if kind == "BASELINE" else dict(zip(days[1:], by_day.values()))
    assert len(got) == len(ref)
    for r in got:
        a, b = by_day[r["window"]["start"].date()], ref[r["window"]["start"].date()]
        xs = np.union1d(a, b)
        gap = np.abs(np.searchsorted(a, xs, "right") / len(a) - np.searchsorted(b, xs, "right") / len(b))
        assert abs(r["ks_test"]["statistic"] - gap.max()) < 1e-9
        assert abs(r["wasserstein_distance"] - (gap[:-1] * np.diff(xs)).sum()) < 1e-9
        edges = np.unique(np.percentile(b, range(10, 100, 10)))
        p, q = (np.maximum(np.bincount(np.searchsorted(edges, z), minlength=len(edges) + 1) / len(z), 1e-4) for z in (a, b))
        seen = np.bincount(np.searchsorted(edges, b), minlength=len(edges) + 1) + np.bincount(np.searchsorted(edges, a), minlength=len(edges) + 1) > 0
        assert abs(r["population_stability_index"] - ((p - q) * np.log(p / q))[seen].sum()) < 1e-9


def test_running_sums_over_every_kind_of_number(spark, monkeypatch):
    monkeypatch.setattr(prefix, "PART_ROWS", 8)
    rng = np.random.default_rng(5)
    vals = np.unique(np.concatenate([rng.normal(0, 10.0 ** rng.integers(-300, 300, 400)), [0.0, 5e-324, -5e-324, 1e308, np.inf, -np.inf],
                                     1.7e9 + np.arange(200)]))
    df = spark.createDataFrame([(float(v), 1) for v in vals], "v double, c long")
    got = sorted(running_sums(df, [], "v", ["c"], with_next=True).collect(), key=lambda r: r["v"])
    assert [r["cum_c"] for r in got] == list(range(1, len(vals) + 1))
    assert [r["next_v"] for r in got] == [*map(float, vals[1:]), None]


def test_refresh_reads_and_writes_touched_days_only(spark, tmp_path):
    from driftwood.streaming.monitor import land, refresh_stored_profile, source_days
    rng = np.random.default_rng(6)
    rows = _rows(rng, 4, 50) + [(None, 1.0, "a")]
    last = max(t for t, *_ in rows if t).date()
    old = [r for r in rows if r[0] is None or r[0].date() < last]
    new = [r for r in rows if r[0] is not None and r[0].date() == last] + _rows(rng, 1, 20)  # a new day, and late rows of the first
    source, metrics = str(tmp_path / "source"), str(tmp_path / "metrics")
    days = land(spark.createDataFrame(old, SCHEMA), source, "ts")
    refresh_stored_profile(spark, source, metrics, days, ["x"], "ts", ["kind"])
    files = {p.parent.name: p.name for p in (tmp_path / "metrics").rglob("*.parquet")}
    days = land(spark.createDataFrame(new, SCHEMA), source, "ts")
    assert sorted(days) == ["2024-03-01", str(last)]
    plan = source_days(spark, source, days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = refresh_stored_profile(spark, source, metrics, days, ["x"], "ts", ["kind"])
    after = {p.parent.name: p.name for p in (tmp_path / "metrics").rglob("*.parquet")}
    kept = {k for k in files if files[k] == after[k]}
    assert kept == set(files) - {"day=2024-03-01"} and set(after) - set(files) == {f"day={last}"}
    want = PR.profile_metrics(spark.createDataFrame(old + new, SCHEMA), ["x"], ["kind"], "ts")
    key = lambda r: (r["column_name"], str(r["window"]))
    assert sorted(got.select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)


def test_week_of_day_sketches(spark):
    from driftwood.operators import sketches as SK
    rows = _rows(np.random.default_rng(7), 14, 900) + [(None, 4.0, "a"), (None, None, "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    weeks = SK.read_profile(SK.merge_profiles(SK.sketch_profile(df, ["x"], "ts"), "1 week"))
    got = {r["window_start"]: r for r in weeks.collect()}
    want = {r["window"] and r["window"]["start"]: r for r in PR.profile_metrics(df, ["x"], [], "ts", "1 week").collect()}
    assert got.keys() == want.keys() and None in got
    for w, a in got.items():
        b = want[w]
        assert [a[c] for c in ("count", "num_nulls", "num_nan", "num_zeros", "min", "max")] == \
            [b[c] for c in ("count", "num_nulls", "num_nan", "num_zeros", "min", "max")]
        assert abs(a["avg"] - b["avg"]) < 1e-9 and abs(a["distinct_count"] - b["distinct_count"]) <= SK.DISTINCT_ERROR * b["distinct_count"]
        x = np.sort([v for t, v, _ in rows if v is not None and v == v and (t is None if w is None else t and w <= t < b["window"]["end"])])
        for p, q in zip([0.5, *PR.DECILES], [a["median"], *a["quantiles"]]):
            assert np.searchsorted(x, q, "left") / len(x) <= p + SK.RANK_ERROR and np.searchsorted(x, q, "right") / len(x) >= p - SK.RANK_ERROR
