import random

from driftwood.llm.minhash import drop_near_duplicates, near_duplicates
from driftwood.llm.sharding import shard_by_bytes
from driftwood.llm.suffixes import WINDOW, remove_repeats


def _sets(texts):
    out = {}
    for i, t in texts:
        w = (t or "").lower().split()
        out[i] = {" ".join(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())
    return out


def _components(sets):
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_components_match_all_pairs(spark, docs_of):
    """A large group of edited copies around the threshold, where single stars miss links."""
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    texts += [(500 + i, " ".join(f"u{r.randrange(10**6)}" for _ in range(80)) + " shared line of some words") for i in range(40)]
    texts += [(900 + i, " ".join(f"v{k}" for k in range(i, i + 8))) for i in range(30)]
    want = _components(_sets(texts))
    got = {x.doc_id: x.component_id for x in near_duplicates(docs_of(texts)).collect()}
    assert got == want


def test_near_duplicate_edges(spark, docs_of, edge_rows):
    rows = near_duplicates(docs_of(edge_rows)).collect()
    assert len(rows) == len(edge_rows)
    by = {x.doc_id: x for x in rows}
    assert by[1].n_shingles == by[2].n_shingles == by[5].n_shingles == 0 and by[1].kept and by[5].kept
    assert by[7].component_id == 6 and not by[7].kept and by[4].n_shingles == 1
    assert by[None].component_id is None
    kept = drop_near_duplicates(docs_of(edge_rows))
    assert kept.columns == docs_of(edge_rows).columns
    assert sorted(x.doc_id for x in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6, 8]
    assert near_duplicates(docs_of([])).count() == 0


def _brute_spans(texts):
    raws = [(t or "").encode() for _, t in texts]
    seen = {}
    for k, b in enumerate(raws):
        for i in range(len(b) - WINDOW + 1):
            seen.setdefault(b[i:i + WINDOW], []).append((k, i))
    gone = [bytearray(len(b)) for b in raws]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i:i + WINDOW] = b"\x01" * WINDOW
    return [bytes(c for c, g in zip(b, m) if not g) for b, m in zip(raws, gone)]


def test_repeats_match_brute_force(spark, docs_of):
    r = random.Random(7)
    text = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    p, q = text(260), text(900)
    texts = [(1, text(500) + p + text(300)), (2, p + text(90)), (3, text(777) + p[10:230]), (4, q), (5, text(30) + q[100:]),
             (6, q[:450] + text(10) + q[450:]), (7, "ab" * 700), (8, text(199)), (9, None), (10, ""), (11, "x" * 199),
             (12, "x" * 250), (13, text(3000) + "ab" * 150), (14, q)]
    want = dict(zip([i for i, _ in texts], _brute_spans(texts)))
    rows = remove_repeats(docs_of(texts)).collect()
    assert {x.doc_id: bytes(x.kept) for x in rows} == want
    twice = remove_repeats(docs_of([(1, p), (1, p), (None, q), (2, "s")])).collect()
    assert [len(x.kept) for x in sorted(twice, key=lambda x: (x.doc_id is None, x.doc_id))] == [0, 0, 1, len(q.encode())]
    assert remove_repeats(docs_of([])).count() == 0


def test_shards_are_contiguous_and_even(spark, docs_of, edge_rows):
    rows = sorted(shard_by_bytes(docs_of(edge_rows + [(i, "word " * 20) for i in range(30, 400)]), 7).collect(),
                  key=lambda x: (x.shard, x.slot))
    assert len(rows) == 380
    ids = [x.doc_id for x in rows if x.doc_id is not None]
    assert ids == sorted(ids)
    for s in range(7):
        slots = [x.slot for x in rows if x.shard == s]
        assert slots == list(range(len(slots)))
    assert shard_by_bytes(docs_of([]), 7).count() == 0


def test_repeated_id_with_unlike_texts_loses_nothing(spark, docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = {t: t.replace(f"{t[0]}59", "end") for t in (a, b)}
    rows = [(8, a), (8, b), (9, near[a]), (10, near[b]), (8, a), (11, c), (8, ""), (12, None)]
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in near_duplicates(docs_of(rows)).collect())
    assert got == [(8, 0, 8), (8, 56, 8), (8, 56, 8), (8, 56, 8), (9, 56, 8), (10, 56, 8), (11, 56, 11), (12, 0, 12)]
    kept = drop_near_duplicates(docs_of(rows))
    assert sorted((x.doc_id, x.text or "") for x in kept.collect()) == sorted([(8, a), (8, b), (8, ""), (11, c), (12, "")])
    same = drop_near_duplicates(docs_of([(8, a), (8, near[a]), (9, a)]))
    assert [x.doc_id for x in same.collect()] == [8] and same.schema == docs_of(rows).schema
