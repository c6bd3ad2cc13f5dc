import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from driftwood.llm import trie
from driftwood.llm.periods import collapse, find_runs, periodic_runs, repeat_tail, summarize

FIELDS = "conv_id long, turn long, role string, text string, conv string, pos int, k1 string"


def brute_runs(w):
    out, seen = [], set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and (i, j - i + q) not in seen:
                seen.add((i, j - i + q))
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_match_all_lags():
    r = random.Random(2)
    for _ in range(4000):
        a = r.choice([1, 2, 2, 3, 6])
        w = [r.randrange(a) for _ in range(r.randrange(80))]
        u = [r.randrange(a) for _ in range(r.randrange(1, 25))]
        u = u[:3] * 3 + u if r.random() < 0.3 else u
        w = w[:r.randrange(12)] + (u * 9)[:int(len(u) * r.uniform(3, 8))] + w[:9]
        assert find_runs(np.array(w, np.int64)) == brute_runs(w)
    for _ in range(60):  # periods of every level
        n = r.randrange(300, 2500)
        w, p = [r.randrange(3000) for _ in range(n)], n // r.randrange(4, 11)
        w = w[:p // 2] + [w[p // 2 + i % p] for i in range(n)]
        assert find_runs(np.array(w)) == brute_runs(w)


def test_long_texts_are_cheap():
    assert find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    unit = np.random.default_rng(1).integers(0, 10**6, 30_000)
    assert find_runs(np.tile(unit, 6)) == [(0, 180_000, 30_000)]
    assert collapse(9, [(1, 7, 1)]).tolist() == [True, True] + [False] * 6 + [True]


def test_period_rows(spark, docs_of, edge_rows):
    extra = [(10, " ".join(f"w{i}" for i in range(200))), (11, "a\x1cb a\x0bb " * 4 + "end"), (12, "x y z " * 5), (-4, "r s " * 9)]
    rows = edge_rows + extra
    got = sorted(map(tuple, summarize(periodic_runs(docs_of(rows), rewrite=repeat_tail)).collect()), key=repr)
    want = []
    for i, t in rows:
        w = repeat_tail(i, (t or "").encode().split())
        runs = brute_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        kept = [x for x, k in zip(w, collapse(len(w), runs)) if k]
        want.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(kept)).hexdigest()))
    assert got == sorted(want, key=repr)
    assert periodic_runs(docs_of([])).count() == 0
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [f"v{k}".encode() for k in range(90)]
    assert all(repeat_tail(i, words) != words for i in planted) and repeat_tail(None, words) == words


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(np.fmod(c, 20))
        built[c] = own.get(donor, [])[:h] + v[h:]
    nodes = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    saved, leaves = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        words = len(k[-1][1].encode().split()) if k else 0
        saved[k] = (len(nodes[k]) - 1) * words + sum(saved[x] for x in kids[k])
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
    out = []
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], FIELDS)
    return sorted(map(tuple, trie.prefix_trie(*trie.swap_heads(frame)).collect()), key=repr)


@pytest.mark.parametrize("chunk", [3])
def test_trie_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    r = random.Random(chunk)
    say = [f"line {i} of \x0b some words" * (i % 3) for i in range(4)]
    rows = []
    for c in [*range(-25, 70), 1000, 2000]:
        n = r.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, None if r.random() < 0.1 else t, r.choice(["user", "assistant", None]), r.choice([*say, None, ""])) for t in range(n)]
    for c in range(200, 260):  # equal conversations, and one that is a prefix of another
        rows += [(c, t, "user", f"same {t}") for t in range(4 + c % 2)]
    rows += [(500, t % 40, "user", f"long {t % 7}") for t in range(60)]
    rows += [(None, 0, "user", "nobody's"), (41, 1, "user", "say"), (41, 1, "user", "say")]
    assert nodes_of(spark, rows) == brute_trie(rows)


def test_trie_edges(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "a", "b")]) == []
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, None, None)]  # no donor, one turn of its own: rebuilt without turns
    assert nodes_of(spark, rows) == brute_trie(rows) and len(nodes_of(spark, rows)) == 1
    long_text = [(40, 0, "user", "word " * 200_000), (41, 0, "user", "word " * 200_000)]
    assert nodes_of(spark, long_text) == brute_trie(long_text)
