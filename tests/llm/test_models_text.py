import numpy as np
from pyspark.sql import functions as F

from driftwood.llm import rnnlm
from driftwood.llm.decontam import contamination, drop_contaminated
from driftwood.llm.html import decode, extract, features, labels, parse
from driftwood.llm.langid import LanguageModel, identify
from driftwood.llm.quality import grade, keep_good
from driftwood.llm.rnnlm import Weights, _outputs, _states, score_texts, train_documents
from driftwood.llm.search import search
from driftwood.llm.suffixes import repeated_spans


def test_hot_anchors_take_the_window_path(spark, docs_of):
    p = "".join(chr(97 + (i * i * 7 + i) % 23) for i in range(500))
    docs = docs_of([(i, f"{i} " * 40 + p[i:] + f" {i * 7}" * 30) for i in range(12)]).select(
        F.xxhash64("text").alias("rid"), "text")

    def covered(group_rows):
        out = {}
        for r in repeated_spans(docs, group_rows=group_rows).collect():
            out[r.rid] = {x["at"] + k for x in r.spans for k in range(x["n"])}
        return out
    assert covered(1) == covered(20_000) and len(covered(1)) == 12


def test_quality_separates_and_handles_edges(spark, docs_of, edge_rows):
    rows = [(i, ("fine words in a row " * 5 + f"w{i}") + (" idiot" if i % 5 == 0 else " ### !!! $$$" * 9 if i % 5 == 1 else ""))
            for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 5 != 1), int(i % 5 == 0)) for i in range(0, 200, 2)] + [(7, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in grade(docs_of(rows), labels).collect()}
    assert sum(got[i] == (i % 5 > 1) for i in range(200)) >= 196
    kept = keep_good(docs_of(rows + edge_rows), labels)
    assert kept.schema == docs_of(rows).schema and kept.count() > 100
    assert keep_good(docs_of(edge_rows), labels.limit(0)).count() == len(edge_rows)
    assert grade(docs_of([]), labels).count() == 0


def test_decontamination_finds_substituted_passages(spark, docs_of, edge_rows):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
    noisy = [w if i % 6 != 4 else f"x{i}" for i, w in enumerate(item)]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, "short"), (None, "no id")], "item_id long, text string")
    docs = docs_of([(100, "before " * 9 + " ".join(item).upper() + "! after"), (101, "q " * 5 + " ".join(noisy)), (102, "alpha beta " * 9)] + edge_rows)
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in contamination(docs, bench).collect()}
    assert got[100] == (True, "0") and got[101] == (True, "0") and not any(v[0] for k, v in got.items() if k not in (100, 101))
    assert drop_contaminated(docs, bench).count() == docs.count() - 2
    assert drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert contamination(docs_of([]), bench).count() == 0


def test_language_of_held_out_rows(spark, sf_dir, docs_of, edge_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    rows = identify(docs, ~held).join(docs.select("doc_id", "lang"), "doc_id").where(held).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r.lang_pred for r in identify(docs_of(edge_rows + [(30, "12 34 !!")]), F.lit(True)).collect()}
    assert odd[1] == odd[2] == odd[30] == "und" and odd[3] == "en"
    assert identify(docs_of([(1, "x")]), F.lit(False)).first().lang_pred == "und"
    assert identify(docs_of([]), F.lit(True)).count() == 0


def test_family_machines_see_every_language():
    x = np.zeros((200, 5), np.float32)
    for i in range(5):
        x[i * 40:(i + 1) * 40, i] = 1
    x[120:160, 4] = 0.8  # the last language of the first family looks like the other family
    langs = np.repeat(np.array(["da", "de", "en", "nl", "fr"], object), 40)
    assert LanguageModel(x, langs, 40).predict(x)[0] == langs.tolist()


def test_gradient_matches_differences():
    w = Weights.start(np.arange(128))
    r = np.random.default_rng(1)
    docs = [r.integers(0, 128, 9).astype(np.int32) for _ in range(3)]

    def loss(v):
        return -sum(rnnlm.score_documents(v, docs, 1)) * np.log(10)
    before = loss(w)
    moments = [0, np.zeros_like(w.flat), np.zeros_like(w.flat)]
    for _ in range(30):
        train_documents(w, docs, 1, moments, 0.02)
    assert loss(w) < 0.8 * before


def test_gradient_of_outputs_matches_finite_differences():
    r = np.random.default_rng(2)
    w, g = Weights.start(np.arange(300)[::-1]), Weights(300)
    w.wo[...], w.wc[...] = r.normal(0, 0.3, w.wo.shape), r.normal(0, 0.3, w.wc.shape)
    s, y = r.normal(size=(40, rnnlm.HIDDEN)).astype(np.float32), r.integers(0, 300, 40)
    _, ds = _outputs(w, s, y, g)

    def loss():
        return -float(_outputs(w, s, y).astype(np.float64).sum())
    for a, d in ((w.wo, g.wo), (w.bo, g.bo), (w.wc, g.wc), (w.bc, g.bc), (s, ds)):
        at = np.unravel_index(np.abs(d).argmax(), d.shape)
        old, h = a[at], 1e-2
        a[at] = old + h
        up = loss()
        a[at] = old - h
        down = loss()
        a[at] = old
        assert abs((up - down) / (2 * h) - d[at]) < 0.02 * abs(d[at]) + 1e-3


def test_frequent_words_lie_in_small_classes():
    for n in (128, 4096, rnnlm.model_words(3_000_000)):
        cuts = rnnlm.class_cuts(n)
        sizes = np.diff(cuts)
        assert cuts[0] == 0 and cuts[-1] == n and (sizes > 0).all() and sizes[0] < sizes[-1]
        if n >= 4096:
            p = 1 / np.arange(1, n + 1)
            met = len(sizes) + (np.repeat(sizes, sizes) * p).sum() / p.sum()
            assert met < 0.8 * 2 * np.sqrt(n)  # even classes meet twice the root at best


def test_adam_in_blocks_is_adam():
    r = np.random.default_rng(3)
    n = rnnlm.BLOCK + 77
    w, m, v = r.normal(size=n).astype(np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32)
    want, m1, v1 = w.astype(float), np.zeros(n), np.zeros(n)
    for step in (1, 2, 3):
        g = r.normal(size=n).astype(np.float32)
        m1, v1 = 0.9 * m1 + 0.05 * g, 0.99 * v1 + 0.01 * (0.5 * g.astype(float)) ** 2
        want -= 0.01 / (1 - 0.9 ** step) * m1 / (np.sqrt(v1 / (1 - 0.99 ** step)) + 1e-4)
        rnnlm._adam(w, g, m, v, 0.5, step, 0.01)
    assert np.allclose(w, want, atol=1e-5)


def test_streams_that_have_ended_take_no_steps(monkeypatch):
    r = np.random.default_rng(5)
    docs = [r.integers(0, 128, n).astype(np.int32) for n in [100 * rnnlm.STEPS] + [rnnlm.STEPS] * 63]
    w, met, states = Weights.start(np.arange(128)), [], rnnlm._states
    monkeypatch.setattr(rnnlm, "_states", lambda w, table, x, *more: met.append(x.size) or states(w, table, x, *more))
    train_documents(w, docs, 1, [0, np.zeros_like(w.flat), np.zeros_like(w.flat)])
    assert sum(met) == sum(map(len, docs))
    met.clear()
    rnnlm.score_documents(w, docs, 1)
    assert sum(met) <= sum(map(len, docs)) + 63 * rnnlm.STEPS


def test_scores_do_not_depend_on_the_documents_beside():
    r = np.random.default_rng(6)
    w = Weights.start(np.arange(8192)[::-1])
    w.wo[...], w.wc[...] = r.normal(0, 0.3, w.wo.shape), r.normal(0, 0.3, w.wc.shape)
    docs = [r.integers(0, 8192, n).astype(np.int32) for n in (1, 700, 33, 64, 5, 130)]
    alone = [rnnlm.score_documents(w, [d], 1)[0] for d in docs]
    assert np.allclose(rnnlm.score_documents(w, docs, 1), alone, rtol=1e-5)


def test_classes_of_a_window_share_their_exponentials(monkeypatch):
    r = np.random.default_rng(8)
    w, g = Weights.start(np.arange(8192)[::-1]), Weights(8192)
    w.wo[...], w.wc[...] = r.normal(0, 0.3, w.wo.shape), r.normal(0, 0.3, w.wc.shape)
    s, y = r.normal(size=(3000, rnnlm.HIDDEN)).astype(np.float32), r.integers(0, 6000, 3000)
    g.flat[...], calls, exp2 = 7, [], np.exp2
    monkeypatch.setattr(np, "exp2", lambda a, out: calls.append(a.size) or exp2(a, out=out))
    _, ds = _outputs(w, s, y, g, scale=0.5)
    classes, sizes = len(w.cuts) - 1, np.diff(w.cuts)
    assert sum(calls) == classes * len(y) + sizes[w.class_of[y]].sum()
    assert len(calls) <= 2 + 2 * sum(calls) / rnnlm.NEAR_OUTPUTS < classes
    # the same from whole tables
    x = np.column_stack([s, np.ones(len(s))]).astype(float)
    a, c = x @ w.wcb, w.class_of[y]
    pc = np.exp(a) / np.exp(a).sum(axis=1, keepdims=True)
    b = np.where(w.class_of == c[:, None], x @ w.wob, -np.inf)
    pw = np.exp(b) / np.exp(b).sum(axis=1, keepdims=True)
    at = np.arange(len(y))
    assert np.allclose(_outputs(w, s, y), np.log(pc[at, c] * pw[at, y]), atol=1e-4)
    pc[at, c] -= 1
    pw[at, y] -= 1
    assert np.allclose(g.wcb, 0.5 * x.T @ pc, atol=1e-2) and np.allclose(g.wob, 0.5 * x.T @ pw, atol=1e-2)
    assert np.allclose(ds, 0.5 * (pc @ w.wc.T + pw @ w.wo), atol=1e-4)


def test_gradient_through_time_matches_finite_differences():
    r = np.random.default_rng(9)
    w, n, steps, h = Weights.start(np.arange(128)), 3, 5, rnnlm.HIDDEN
    w.wh[...] = r.normal(0, 0.5, w.wh.shape)
    table, x = r.normal(size=(steps * n, 3 * h)).astype(np.float32), np.arange(steps * n).reshape(steps, n)
    keep, out = np.ones((steps, n), np.float32), r.normal(size=(steps, n, h)).astype(np.float32)
    keep[2, 1], start, cache = 0, r.normal(0, 0.5, (n, h)).astype(np.float32), []
    _states(w, table, x, keep, start, cache)
    dg, d_wh = rnnlm._states_back(w, cache, out, keep)

    def loss():
        return float((_states(w, table, x, keep, start)[0].astype(float) * out).sum())
    for a, d in ((table, dg.transpose(0, 2, 1).reshape(table.shape)), (w.wh, d_wh)):
        for i in np.argsort(-np.abs(d), axis=None)[:40:3].tolist():
            at = np.unravel_index(i, d.shape)
            old, by = a[at], 1e-2
            a[at] = old + by
            up = loss()
            a[at] = old - by
            down = loss()
            a[at] = old
            assert abs((up - down) / (2 * by) - d[at]) < 0.02 * abs(d[at]) + 1e-3


def test_hashes_of_many_texts_tell_their_words_apart():
    long = rnnlm.HASH_BYTES
    texts = ["a B\tab AB\x0bba", None, "", " \n\r ", "É é\x0c日本", "ab " * long + "q" * (3 * long) + " ba " + "q" * (3 * long - 1),
             "Q" * (3 * long), "x" * long + " y", "\ud800 a", " b" * long] + [f"w{i} W{i % 7}" for i in range(20_000)]
    hashes, ends = zip(*rnnlm.token_hashes(texts))
    got = [part for h, e in zip(hashes, ends) for part in np.split(h, e[:-1])]
    words = [[*(t or "").encode("utf-8", "replace").lower().split(), None] for t in texts]
    assert [len(h) for h in got] == [len(x) for x in words] and len(hashes) < 20
    of: dict = {}
    for h, x in zip(got, words):
        for a, b in zip(h.tolist(), x):
            assert of.setdefault(b, a) == a
    assert len(set(of.values())) == len(of) and of[None] == int(rnnlm.END)


def test_places_of_hashes():
    r = np.random.default_rng(10)
    some = np.unique(np.concatenate([r.integers(0, 1 << 63, 500, np.uint64), np.arange(40, dtype=np.uint64), [np.uint64(2**64 - 1)]]))
    for held in (some, some[:1], some[:0], some[:-1]):
        asked = np.concatenate([some, some + np.uint64(1)])
        where = {h: i for i, h in enumerate(held.tolist())}
        assert rnnlm.Coder(held)(asked).tolist() == [where.get(h, -1) for h in asked.tolist()]


def test_class_factored_probabilities_sum_to_one():
    w = Weights.start(np.arange(128))
    s, _ = _states(w, w.emb @ w.wx + w.b, np.zeros((1, 1), int), np.ones((1, 1), np.float32), np.zeros((1, rnnlm.HIDDEN), np.float32))
    lp = _outputs(w, np.repeat(s[0], 128, axis=0), np.arange(128))
    assert abs(np.exp(lp).sum() - 1) < 1e-4


def test_scores_edges(spark, docs_of, edge_rows):
    got = score_texts(docs_of(edge_rows), F.lit(True), vocab=128).collect()
    assert len(got) == len(edge_rows) and {r.n_tokens for r in got if r.doc_id in (1, 2, 5)} == {1}
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in got)
    assert score_texts(docs_of([(1, "a b")]), F.lit(False), vocab=128).first().train_tokens == 0
    assert score_texts(docs_of([]), F.lit(True), vocab=128).count() == 0


def test_network_learns_from_every_document(spark, docs_of):
    shares = docs_of([(i, "") for i in range(20)]).select("doc_id", rnnlm.hash_share(F.col("doc_id"), 5).alias("at")).collect()
    last = max(shares, key=lambda r: r["at"]).doc_id  # the last one that any share of the documents takes
    got = score_texts(docs_of([(last, "a b " * 4000)]), F.lit(True)).first()
    assert got.score > 0.2 * got.base_score


def test_model_words_grow_with_the_vocabulary():
    sizes = [rnnlm.model_words(n) for n in (0, 10_000, 400_000, 40_000_000)]
    assert sizes[0] == sizes[1] == rnnlm.VOCAB and 4 * sizes[1] < sizes[2] < sizes[3] / 4
    assert all(n % rnnlm.class_size(n) == 0 for n in sizes)


def test_pages_without_landmarks_and_edges(spark, sf_dir):
    odd = [(9001, None), (9002, ""), (9003, "plain &amp; text"), (9004, "<div><p>one<p>two<br>three</div><script>x<b></script>"),
           (9005, "<nav><a href=x>menu</a></nav><article><h1>T&eacute;</h1><p>a <b>b</b>\n c<ul><li>x<li>y</ul></article><footer>f</footer>"),
           (9005, "<<<>>&&<article>"), (None, "<article><p>z</p><form><p>no</p></form></article>")]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    more = spark.createDataFrame([(i, "u", h) for i, h in odd], "page_id long, url string, html string")
    got = [r for r in extract(pages.union(more).withColumn("text", F.lit("clash"))).where("page_id is null or page_id > 9000").collect()]
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    assert by[9001] == by[9002] == [""] and "Té\n\na b c" in by[9005][0] + by[9005][1]
    assert "menu" not in "".join(by[9005]) and by[None] == ["z"]
    assert extract(pages.limit(0)).count() == 0


def page_text(page):
    """Text by the named parts alone, as where nothing could be learned."""
    nodes, texts = parse(page)
    return decode(nodes, texts, np.where(labels(nodes) < 0, -1.0, 1.0))


def test_unseen_elements_hide_nothing_after_them():
    for start in ('<svg viewBox="0 0 1 1"/>', "<select><option>", "<select>", "<noscript>", "<template>", "<svg>", "<noscript><img>", "<div><select><option></div>"):
        assert page_text(f"<body>{start}<article><p>one<p>two</article></body>") == "one\n\ntwo", start
    for name in ("select-box", "style-guide", "template-x", "script-note", "svg-icon", "noscript-x"):
        assert page_text(f"<{name}>zero</{name}><p>one</p><{name}><p>two</p>") == "zero\n\none\n\ntwo"
    plain = "<body><ul><li>a<li>b</ul><p>one two</p><div>three</div>"
    nodes, texts = parse(plain)
    for gone in ("<svg><g><path d='x'/><text>no</text></g></svg>", "<select name=x><option>no<option selected>no</select>", "<svg/>",
                 "<noscript><div><p>no</p></div></noscript>", "<template><p>no</template>", "<SCRIPT>no</SCRIPT >", "<textarea><p>no</textarea>"):
        own = parse(plain.replace("<p>one ", f"{gone}<p>one {gone}"))
        assert page_text(plain.replace("one ", f"one {gone}")) == page_text(plain), gone
        assert np.array_equal(features(own[0]), features(nodes)), gone
    assert page_text("<p>one</p><script>no</p><p>no") == "one"


def test_only_whole_attribute_names_count():
    for attrs in ('aria-hidden="false"', "aria-hidden", 'data-hidden="0"', 'title="the hidden valley"', "data-id=nav", "data-role='menu'", "x-class=ads",
                  'title="id=nav class=ads"', 'data-style="display:none"', "hidden-x", '"stray hidden" lang=en', "alt='style=display:none'"):
        assert page_text(f"<article {attrs}><p>one</article>") == "one", attrs
    for attrs in ("hidden", 'HIDDEN=""', 'aria-hidden="true"', "aria-hidden=TRUE", "class = 'x nav'", 'lang="en"id="nav"', "role=menu", "style='display: none'"):
        assert page_text(f"<article {attrs}><p>one</article>") == "", attrs
    assert parse("<div class=\"a b\" data-id=c id='d'role=e>")[0][1].words == ["a", "b", "d", "e"]


def test_split_main_text_and_lists_come_whole(spark, sf_dir):
    nodes, texts = parse("<div><p>one</p><p>two</p></div><nav><p>no</p></nav><div><p>six</p><p>ten</p></div><div><p>four</p><p>five</p></div>")
    odds = np.array([{"p": 2.0, "div": -3.0, "nav": -4.0}.get(n.tag, -1.0) for n in nodes])
    assert decode(nodes, texts, odds) == "one\n\ntwo\n\nsix\n\nten\n\nfour\n\nfive"
    page = ("<nav><ul><li><a href=x>menu</a></ul></nav><article><h1>T</h1><p>a<ul><li>x<li>y</ul><table><tr><td>k<td>l</table>"
            "<blockquote>q</blockquote><p>z</article><footer>f</footer>")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    got = extract(pages.union(spark.createDataFrame([(9001, "u", page)], pages.schema))).where("page_id = 9001").first()
    assert got.text.split() == "T a x y k l q z".split()


def test_search_matches_brute_force_on_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows + [(40, "a b c d e"), (41, "a b"), (42, "c c c d")])
    q = spark.createDataFrame([(1, "a b d"), (2, None), (3, "zzz"), (None, "a")], "query_id long, text string")
    rows = search(docs, q, k=3).orderBy("rank").collect()
    assert {r.query_id for r in rows} == {1} and [r["rank"] for r in rows] == [1, 2, 3] and {r.doc_id for r in rows} <= {4, 40, 41, 42}
    assert search(docs_of([]), q).count() == 0


def test_index_rows_are_packed():
    import pandas as pd

    from driftwood.llm import search as module
    texts = [" ".join(f"w{(i * 7 + j) % 400}" for j in range(300)) for i in range(250)] + ["same " * 70_000, None]
    row = next(module._shards(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts})]))).iloc[0]
    docs, counts, ends = (module._numbers(row[c]) for c in ("docs", "counts", "ends"))
    assert sum(len(row[c]) for c in ("docs", "counts", "ends", "lens")) < 7 * len(docs)  # was 8 and the ends and lengths
    assert counts.max() == 70_000 and counts.sum() == module._numbers(row["lens"]).sum() == 250 * 300 + 70_000
    assert ends[-1] == len(docs) and docs.max() < len(texts) and len(ends) == len(row["terms"]) // 8 + 1


def test_search_equals_brute_force_over_many_shards(spark, docs_of, monkeypatch):
    import math
    from collections import Counter

    import numpy as np

    from driftwood.llm import search as module
    monkeypatch.setattr(module, "QUERIES", 20)
    r = np.random.default_rng(9)
    texts = [(i, " ".join(f"w{w}" for w in r.zipf(1.4, r.integers(1, 120)) % 500)) for i in range(600)]
    bags = {i: Counter(t.split()) for i, t in texts}
    df = Counter(w for b in bags.values() for w in b)
    mean = sum(sum(b.values()) for b in bags.values()) / len(bags)
    asked = texts[::10]
    got = {}
    for x in search(docs_of(texts), spark.createDataFrame(asked, "query_id long, text string"), k=4).collect():
        got.setdefault(x.query_id, []).append((-x.score, x.doc_id))
    for q, text in asked:
        want = []
        for i, b in bags.items():
            norm = 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)
            hits = [math.log1p((600 - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + norm) for w in set(text.split()) if w in b]
            if hits:
                want.append((-round(sum(hits), 6), i))
        want = sorted(want)[:4]
        assert [i for _, i in sorted(got[q])] == [i for _, i in want]
        assert np.allclose([s for s, _ in sorted(got[q])], [s for s, _ in want], atol=2e-6)


def test_a_shard_takes_queries_in_batches(monkeypatch):
    import pandas as pd

    from driftwood.llm import search as module
    r = np.random.default_rng(4)
    texts = [" ".join(f"w{w}" for w in r.zipf(1.3, r.integers(0, 90)) % 700) for _ in range(500)] + ["w1 w2"] * 3 + [None]
    shard = module.Shard(next(module._shards(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts})]))).iloc[0], 40.0)
    rows = next(module._terms(iter([pd.DataFrame({"query_id": range(300), "text": texts[:300]})])))
    rows["idf"] = [1 / (1 + (t % 997)) for t in rows["terms"]]
    want = []
    for terms, idf in zip(rows["terms"], rows["idf"]):
        score = np.zeros(len(texts))
        for t, x in zip(terms.view(np.uint64), idf):
            at = slice(*shard.ends[(i := np.searchsorted(shard.terms, t)):i + 2])
            score[shard.docs[at]] += x * shard.weight[at]
        best = sorted((-round(v, 6), int(i)) for v, i in zip(score, shard.ids) if v)[:5]
        want.append([i for _, i in best] + [0] * (5 - len(best)))
    calls, plain = [], module.Shard._best
    monkeypatch.setattr(module.Shard, "_best", lambda self, *a: (calls.append(len(a[2])), plain(self, *a))[1])
    for limits, at_most in (({}, 2), ({"BATCH_POSTINGS": 700}, 300), ({"BATCH_CELLS": 1}, 300), ({"TABLE_CELLS": 0}, 2), ({"OFTEN": 600}, 2)):
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(module, name, value)
            own = module.Shard(next(module._shards(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts})]))).iloc[0], 40.0)
            calls.clear()
            ids, scores = np.zeros((300, 5), np.int64), np.full((300, 5), -1.0)
            own.top(module.Queries.of(rows), ids, scores)
        assert len(calls) <= at_most and sum(calls) == 300  # was one call a query and more
        assert ids.tolist() == want
