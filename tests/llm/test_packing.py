import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from driftwood.llm.packing import WordIds, nnls, plan_sequences
from driftwood.llm.queries import pack_query

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts):
    """Pieces cover each document's ids, lie gapless in their sequences, and waste little."""
    tok = Tokenizer.from_file(PATH)
    want = []
    for doc, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[s:s + 4096], "<u4")
            want.append((doc, k, s, len(cut), zlib.crc32(cut.tobytes())))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    return len(seqs), sum(r.length for r in rows)


def test_packs_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack_query(docs).collect()
    n, tokens = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= -(-tokens // 4096) * 1.02 + 1


def test_edges(spark, docs_of, edge_rows):
    odd = edge_rows + [(20, "a<|endoftext|>b it's 12 é́ x"), (21, "ẞİ \x1c   wide"), (22, "a\x0bb")]
    check(pack_query(docs_of(odd)).collect(), odd)
    assert pack_query(docs_of([])).count() == 0


def test_plan_uses_each_piece_once():
    r = np.random.default_rng(3)
    hist = np.bincount(np.clip(r.lognormal(6, 1, 20000).astype(int), 1, 4096), minlength=4097)
    plan = plan_sequences(hist, 4096)
    got = np.zeros(4097, np.int64)
    for p, t in plan:
        assert sum(p) <= 4096 and t > 0
        for x in p:
            got[x] += t
    assert (got == hist).all()
    total = int((hist * np.arange(4097)).sum())
    assert sum(t for _, t in plan) <= -(-total // 4096) * 1.005 + 1


def test_nnls_matches_known_solution():
    a = np.array([[1.0, 0, 1], [0, 1, 1], [0, 0, 1]])
    assert np.allclose(nnls(a, a @ np.array([2.0, 0, 3])), [2, 0, 3])
    assert (nnls(a, np.array([-1.0, 2, 1])) >= 0).all()


def test_word_ids_equal_whole_text_ids():
    r = np.random.default_rng(5)
    signs = list("aZé,.ß İıﬁ¨中文かगि🙂👩ẞ-'\"$1２ſÅΣς\n\t\x00\x07\x1c\x85\u0308\u0301\u00a0\u3000\u200b\ufeff")
    texts = ["".join(r.choice(signs, r.integers(0, 60))) for _ in range(3000)]
    words = WordIds(PATH)
    for text, ids in zip(texts, words.batch(texts)):
        assert ids.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
