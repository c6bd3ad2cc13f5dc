import random

import numpy as np
import pytest

from driftwood.llm import jaccard
from driftwood.llm.jaccard import _head, _prefix, jaccard_components


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = {b" ".join(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({b" ".join(w)} if w else set())
    return out


def brute(texts, percent=80):
    sets = sets_of(texts)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def got(spark, docs):
    return sorted(map(tuple, jaccard_components(docs).collect()))


def edited(r, words, times):
    w = list(words)
    for _ in range(times):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return w


@pytest.mark.parametrize("block", [16])
def test_matches_all_pairs(spark, docs_of, monkeypatch, block):
    """Large groups of edited copies around the threshold, chains, shared lines, short texts and sets of shared parts only."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    r = random.Random(block)
    new = lambda n, x: [f"{x}{r.randrange(10**6)}" for _ in range(n)]
    texts, base, far = [], new(150, "w"), None
    for i in range(90):
        texts.append((i, edited(r, base, r.randrange(0, 7))))
    for i in range(60):  # a second group that is near the first, but not quite
        far = far or edited(r, base, 5)
        texts.append((200 + i, edited(r, far, r.randrange(0, 5))))
    chain = new(100, "c")
    for i in range(20):  # neighbours are alike, ends are not
        chain = edited(r, chain, 1)
        texts.append((300 + i, list(chain)))
    lines = [new(12, "l") for _ in range(12)]
    for i in range(60):
        texts.append((400 + i, sum(r.sample(lines, 6), [])))  # nothing of their own
        texts.append((500 + i, new(60, "u") + r.choice(lines)))
    texts += [(700 + i, [f"v{k}" for k in range(i, i + 8)]) for i in range(12)]
    texts += [(800 + i, ["a", "b", "c"][:1 + i % 3]) for i in range(6)]
    texts = [(i, " ".join(w)) for i, w in texts]
    texts += [(900 + i, texts[i][1].upper()) for i in range(5)]
    assert got(spark, docs_of(texts)) == brute(texts)


def test_edges(spark, docs_of, edge_rows):
    rows = [tuple(x) for x in jaccard_components(docs_of(edge_rows)).collect()]
    assert len(rows) == len(edge_rows)
    by = {i: (n, c) for i, n, c in rows}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[5] == (0, 5) and by[7][1] == 6 and by[4] == (1, 4)
    assert by[None][1] is None and by[8] == (2, 8)
    assert jaccard_components(docs_of([])).count() == 0
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    twice = [(8, a), (8, b), (9, a + " end"), (10, b + " end"), (8, a)]  # one id with unlike texts
    assert sorted(x.component_id for x in jaccard_components(docs_of(twice)).collect()) == [8] * 5


def test_bounds_lose_nothing():
    """No pair of sizes and overlaps at the threshold is dropped by the prefix or by the least number of shared shingles."""
    r = np.random.default_rng(0)
    for _ in range(3000):
        x, y = r.integers(1, 120, 2)
        least = int(np.ceil(80 * (x + y) / 180))
        if least > min(x, y):
            continue
        common = r.permutation(400)[:least]
        rest = np.setdiff1d(np.arange(400), common)
        r.shuffle(rest)
        a = np.sort(np.concatenate([common, rest[:x - least]]))
        b = np.sort(np.concatenate([common, rest[x - least:x + y - 2 * least]]))
        assert np.intersect1d(a[:_prefix(x, 80)], b[:_prefix(y, 80)]).size
        shared = np.intersect1d(a[:_head(x, 80)], b[:_head(y, 80)]).size
        for n in (x, y):
            j = -(-n * 80 // 100)
            assert shared >= min(-(-j * 80 // 100), -(-j // 10) + 9)
