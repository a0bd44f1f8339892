"""op5 on deep and broken pages: the work grows with the page, and branch contents are told apart exactly."""

import random
import time
from collections import defaultdict

from epigrid.llm import html

TAGS = "div p b li ul ol table tr td dl dt dd hr br article main header span option select section i".split()


def contents(page):
    """Texts of each style-tree node in page order, by walking all ancestors of each text."""
    keys, own = page.keys(), defaultdict(list)
    for node, text in page.items:
        if text and not text.isspace():
            line = []
            while node >= 0:
                line.append(keys[node])
                node = page.parent[node]
            for k in dict.fromkeys(line):
                own[k].append(" ".join(text.split()))
    return {k: tuple(own.get(k, ())) for k in keys[1:]}


def test_contents_equal_those_of_a_walk():
    random.seed(1)
    name, meant = {}, {}
    for _ in range(1500):
        page = html.Page("".join(random.choice([f"<{t}>", f"<{t}>", f"</{t}>", "word ", "x", " "]) for t in random.choices(TAGS, k=random.randint(1, 60))))
        want = contents(page)
        for key, _, vote in page.votes()[1]:
            assert name.setdefault(want[key], vote) == vote and meant.setdefault(vote, want[key]) == want[key]


def test_deep_and_broken_pages_take_linear_time():
    n = 20_000
    for page in ("<div>word{}", "<b>{}", "<header>x{}", "<p><div>{}"):
        text = "".join(page.format(k) for k in range(n)) + "<hr></q>x<li>y</li>" * n
        start = time.time()
        p = html.Page(text)
        p.votes()
        assert "x" in p.text(frozenset(p.keys()[5:9])) or p.dead[1]
        assert time.time() - start < 10     # a walk up for each text would take minutes


def test_a_deep_page_among_others(spark):
    deep = "<div>" * 50_000 + "deep" + "</div>" * 50_000
    rows = [(1, "http://a.org/1", "<article><p>one</p></article>"), (2, "http://a.org/2", deep), (3, "http://a.org/3", "<p>" + "long text " * 200_000)]
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == ("one", 3) and got[2] == ("deep", 4) and got[3][1] == 200_000 * 10 - 1
