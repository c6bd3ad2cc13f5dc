import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.llm import html as H

PARTS = ['<section class="comments">', '<div class="comments">', "<aside>", "<footer>", "<nav>", '<div class="sidebar">',
         '<div class="cookie-notice">', "<form>", '<div class="ad">', '<div id="comments"><article>', "<header>"]
LONG = "".join(f"<p>Reader number {i} has written quite a long paragraph, of the kind that an article might hold as well.</p>" for i in range(6))


def close(part):
    return "".join(f"</{t.split()[0]}>" for t in reversed(part.strip("<>").split("><")))


@pytest.fixture(scope="module")
def trees(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return H.train(pages.where(F.col("page_id") % 6 == 0)), [r.html for r in pages.where("page_id % 500 = 1").collect()]


def text(model, page):
    nodes, texts = H.parse(page)
    return H.decode(nodes, texts, model.log_odds(H.features(nodes)))


@pytest.mark.parametrize("part", PARTS)
def test_named_parts_never_leak(trees, part):
    """Long paragraphs of other parts, inside and after the article, and where the article is a plain division."""
    model, pages = trees
    block = part + LONG + close(part)
    for page in pages:
        want = text(model, page)
        assert want and "Reader number" not in want
        for changed in (page.replace("</article>", f"{block}</article>"), page.replace("</article>", f"</article>{block}"),
                        page.replace("<article>", f"{block}<article>")):
            assert text(model, changed) == want
        plain = page.replace("<article>", "<div>").replace("</article>", f"</div>{block}")
        assert "Reader number" not in text(model, plain)


def test_plain_pages_keep_their_paragraphs(trees):
    """Without article and class names the trees decide by density and place."""
    model, pages = trees
    kept = total = 0
    for page in pages:
        want = text(model, page).split("\n\n")
        got = text(model, page.replace("<article>", "<div>").replace("</article>", "</div>")).split("\n\n")
        kept, total = kept + len(set(want) & set(got)), total + len(want)
    assert kept >= 0.9 * total


def test_a_form_around_the_page_is_opened(trees):
    model, pages = trees
    for page in pages:
        around = page.replace("<body>", "<body class='sidebar-left'><form>").replace("</body>", "</form></body>")
        assert text(model, around) == text(model, page)


def test_choice_is_the_best_of_all():
    r = np.random.default_rng(4)
    for _ in range(300):
        n = int(r.integers(2, 9))
        nodes = [H.Node("" if i == 0 else "div", [], -1 if i == 0 else int(r.integers(0, i)), 0, 0, False) for i in range(n)]
        odds = np.round(r.normal(0, 2, n), 2)
        best = max(sum(odds[i] for i in s) for k in range(n) for s in itertools.combinations(range(1, n), k)
                   if all(nodes[i].parent in (0, *s) for i in s))
        state = H.choose(nodes, odds)
        assert all(state[i] < 0 or i == 0 or state[nodes[i].parent] >= 0 for i in range(n))
        assert abs(sum(odds[i] for i in range(1, n) if state[i] >= 0) - best) < 1e-9
        assert all((state[i] == 1) == (odds[i] > 0) for i in range(1, n) if state[i] >= 0)


def test_long_broken_pages_take_linear_time():
    for unit in ("<a ", '<p x="', "<div>", "<ul><li>", '<x ">"', "<", "<!", "</script <script>", "<p>x ", "<table><tr><td>", "<p x='\">", "<select><option>"):
        spent = []
        for size in (100_000, 400_000):
            page = unit * (size // len(unit))
            start = time.process_time()
            nodes, texts = H.parse(page)
            H.decode(nodes, texts, np.zeros(len(nodes)))
            spent.append(time.process_time() - start)
        assert spent[1] < 12 * max(spent[0], 0.05), (unit, spent)


def test_broken_tags():
    got = lambda page: H.decode(*(p := H.parse(page)), np.ones(len(p[0])))
    assert got("<p class=it's>don't</p><p>two") == "don't\n\ntwo"
    assert got("<p title='a > b' data-x=\"<i>\">one") == "one"
    assert got("a < b and x <y") == "a < b and x <y"
    assert got("<p>one <b <i>two</p>") == "one two"
    assert got("<script>if (a</b) '</p>'</script ><p>x<style></style") == "x"
