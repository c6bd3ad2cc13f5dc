import os
import subprocess
import sys

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from driftwood.llm import langid, quality
from driftwood.llm.decontam import contamination
from driftwood.llm.quality import grade, text_marks
from test_dedup import _brute_spans, _components, _sets  # noqa: E402
from test_packing import check

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_each_stage_against_brute_force(spark, sf_dir):
    """All stages in turn, over documents with nulls, empty and repeated rows and columns of clashing names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(-1, None, "en", "s", 0), (-2, "", None, None, None), (-3, "x y", "en", "s", 3), (-3, "x y", "en", "s", 3)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("node", F.lit("clash")).withColumn("kept", F.lit(1))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "passage_dedup", "decontaminate", "packing"]
    held = [docs]
    for _, stage in corpus_pipeline.STAGES:
        held.append(stage(spark, held[-1], sf_dir).cache())
    assert all(d.columns == docs.columns for d in held[1:-1])

    judged = grade(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in judged) == sorted(r.doc_id for r in held[1].collect())

    texts = sorted({(r.doc_id, r.text) for r in held[1].collect()}, key=repr)
    classes = _components(_sets(texts))
    assert sorted(r.doc_id for r in held[2].collect()) == sorted(i for i in classes if classes[i] == i)

    kept = [(r.doc_id, r.text) for r in held[2].collect()]
    want = dict(zip([i for i, _ in kept], _brute_spans(kept)))
    got = {r.doc_id: (r.text or "").encode() for r in held[3].collect()}
    assert got.keys() <= want.keys() and all(got[i] == want[i].decode("utf-8", "ignore").encode() for i in got)
    assert all(not want[i].strip() or i in got for i in want)

    bad = {r.doc_id for r in contamination(held[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert {r.doc_id for r in held[4].collect()} == got.keys() - bad

    check(held[5].collect(), [(r.doc_id, r.text) for r in held[4].collect()])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_ordinal_likelihood_by_direct_sum():
    """The fitted model is a maximum of the penalised likelihood, summed document by document."""
    r = np.random.default_rng(2)
    words = [f"w{i}".encode() for i in range(12)]
    codes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    texts = [np.flatnonzero(r.random(12) < 0.4) for _ in range(240)]
    strength = r.normal(0, 1.5, 12)
    grades = np.array([int(np.digitize(strength[t].sum() + r.logistic(), [-1, 1])) for t in texts])
    model = quality.fit(grades, [codes[t] for t in texts], steps=1500)
    order = {int(c): i for i, c in enumerate(model.marks)}
    at = [[order[int(codes[j])] for j in t] for t in texts]
    share = 1 / np.bincount(grades)[grades]
    share /= share.sum()

    def loss(w, t):
        total = 0.0
        for own, k, s in zip(at, grades, share):
            z = sum(w[i] for i in own)
            tail = [1.0, *(1 / (1 + np.exp(c - z)) for c in t), 0.0]
            total -= s * np.log(tail[k] - tail[k + 1])
        return total + 1e-4 * (w @ w) + quality.L1 * np.abs(w).sum()

    best = loss(model.weights, model.thresholds)
    assert (np.diff(model.thresholds) >= 0).all()
    for i in range(len(model.weights) + 2):
        for step in (-0.05, 0.05):
            w, t = model.weights.copy(), model.thresholds.copy()
            (w if i < len(w) else t)[i if i < len(w) else i - len(w)] += step
            assert loss(w, t) > best - 2e-4
    expected = model.tails(np.array([sum(model.weights[i] for i in own) for own in at])).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.5


def test_scores_are_sums_over_marks(spark, docs_of, edge_rows):
    r = np.random.default_rng(3)
    docs = docs_of(edge_rows + [(100 + i, " ".join(r.choice(["good", "fine", "text"] if i % 3 else ["BAD!!", "junk", "text"], 8))) for i in range(60)])
    labels = spark.createDataFrame([(100 + i, int(i % 3 > 0), int(i % 6 == 0)) for i in range(60)] + [(None, 1, 0), (1, None, 1)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    weight = dict(zip(model.marks.tolist(), model.weights))
    got = {x.doc_id: x for x in grade(docs, labels).collect() if x.doc_id is not None and x.doc_id != 8}
    for i, text in ((x.doc_id, x.text) for x in docs.collect() if x.doc_id in got):
        words, marks = text_marks(text)
        z = sum(weight.get(xxhash.xxh3_64_intdigest(m), 0.0) for m in words + marks)
        tails = [1 / (1 + np.exp(t - z)) for t in model.thresholds]
        assert got[i].p_good == pytest.approx(tails[-1]) and got[i].expected_grade == pytest.approx(sum(tails))
        assert got[i].kept == (tails[-1] >= 0.5)


def test_machines_match_a_plain_solver():
    """With passes enough the coordinate ascent reaches the optimum that a slow projected gradient finds; with the few passes of
    the operator its machines win the same duels."""
    r = np.random.default_rng(5)
    centre = r.normal(0, 1, (3, 6))
    x = np.vstack([c + r.normal(0, 0.8, (40, 6)) for c in centre]).astype(np.float32)
    names = np.repeat(["a", "b", "c"], 40)
    duels = langid.Duels(["a", "b", "c"], x, {n: np.flatnonzero(names == n) for n in "abc"})
    wide = np.hstack([x, np.ones((len(x), 1))])

    def slow(rows, y, c=10.0):
        k = (wide[rows] @ wide[rows].T) * np.outer(y, y)
        a = np.zeros(len(y))
        for _ in range(20_000):
            a = np.clip(a + (1 - k @ a) / np.linalg.norm(k, 2), 0, c)
        return (a * y) @ wide[rows]

    def loss(w, rows, y, c=10.0):
        return 0.5 * w @ w + c * np.maximum(0, 1 - y * (wide[rows] @ w)).sum()

    votes = np.zeros((len(x), 3))
    for k, (i, j) in enumerate(duels.pairs):
        rows = np.flatnonzero((names == "abc"[i]) | (names == "abc"[j]))
        y = np.where(names[rows] == "abc"[i], 1.0, -1.0)
        best = slow(rows, y)
        assert loss(langid.svm(x[rows], y, passes=1500), rows, y) <= 1.01 * loss(best, rows, y)
        m = wide @ best
        votes[np.arange(len(x)), np.where(m >= 0, i, j)] += 1
    got, score = duels.decide(x)
    clear = np.sort(votes, axis=1)[:, -1] > np.sort(votes, axis=1)[:, -2]
    assert (got[clear] == votes.argmax(axis=1)[clear]).mean() > 0.95 and ((score >= 0) & (score <= 1)).all()


def test_operators_run_from_any_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from driftwood.session import build_session
from driftwood.llm.sharding import shard_by_bytes
from driftwood.llm.periods import periodic_runs
from driftwood.llm.jaccard import jaccard_components
spark = build_session("local[2]", 2, driver_memory="1g")
docs = spark.createDataFrame([(i, "a b c d e f g h " * (i % 3)) for i in range(9)], "doc_id long, text string")
print(shard_by_bytes(docs, 3).count(), periodic_runs(docs).count(), jaccard_components(docs).where("component_id < doc_id").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "9 9 4" in done.stdout, done.stderr[-2000:]
