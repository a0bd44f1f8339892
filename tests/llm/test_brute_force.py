"""Operators against brute force on small data."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from epigrid.llm import decontaminate, dedup, html, licenses, pieces, quality, setjoin, suffixes, topk, toxicity, urls

SF = "/root/testdata/sf0.001"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_suffix_array_and_prefixes():
    random.seed(3)
    for _ in range(200):
        k = random.choice([1, 2, 4, 30])
        s = np.array([random.randint(1, k) for _ in range(random.randint(1, 150))] + [0])
        t = s.tolist()
        want = sorted(range(len(t)), key=lambda i: t[i:])
        sa = suffixes.suffix_array(s, k + 1)
        assert sa.tolist() == want
        lcp = suffixes.common_prefixes(s, sa)
        for a, b in itertools.pairwise(want):
            n = next((x for x in range(len(t)) if a + x >= len(t) or b + x >= len(t) or t[a + x] != t[b + x]), 0)
            assert lcp[b] == n


def test_suffix_array_recurses_at_every_alphabet(monkeypatch):
    """Few and many names (once a border at 4,096), by buckets and suffix by suffix: the naive order."""
    rng = np.random.default_rng(5)
    names = []
    real = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda s, k: names.append(k) or real(s, k))
    for n, k in ((3000, 40), (30_000, 300), (60_000, 3000)):
        half = rng.integers(1, k + 1, n // 2)
        s = np.concatenate((half, half, [0]))
        t = s.astype(">i4").tobytes()
        orders = []
        for full in (0, 64, len(s) + 1):
            monkeypatch.setattr(suffixes, "FULL_BUCKETS", full)
            orders.append(real(s, k + 1).tolist())
        assert orders[0] == orders[1] == orders[2]
        if n == 3000:
            assert orders[0] == sorted(range(len(s)), key=lambda i: t[4 * i:])
        else:       # neighbours in order over 100 symbols, and every suffix there once
            assert sorted(orders[0]) == list(range(len(s)))
            assert all(t[4 * a: 4 * a + 400] <= t[4 * b: 4 * b + 400] for a, b in itertools.pairwise(orders[0]))
    assert min(names) < 4096 < max(names)


def spans(rows, w=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - w + 1):
            first[b[k:k + w]] = min(i, first.get(b[k:k + w], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - w + 1):
            if first[b[k:k + w]] < i:
                gone[k:k + w] = b"\1" * w
        n = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), n, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [1024, 2])
def test_repeated_spans(spark, hot):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    base = " ".join(f"w{i}é" for i in range(60))
    rows += [(5000, base), (5001, base), (5002, "x" * 300), (5003, "x" * 120 + base[40:200]), (5004, None), (5005, "short"), (5006, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, dedup.repeated_spans(df, hot=hot).collect())) == spans(rows)


def test_toxicity_held_out(spark):
    random.seed(1)
    words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(300)]
    texts, toxic = [], []
    for i in range(1200):
        w = random.choices(words, k=60)
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            for k in range(4):
                w[k * 10] = random.choice(["moronic", "scummy", "idiotic"])
        texts.append(" ".join(w))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs_of(spark, texts), labels).filter("held_out").collect()
    assert np.mean([r.predicted == toxic[r.doc_id] for r in got]) > 0.95 and len(got) > 150


def test_quality_held_out(spark):
    random.seed(2)
    words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(300)]
    texts, good = [], []
    for i in range(900):
        w = random.choices(words, k=120)
        good.append(int(i % 4 > 0))
        if not good[-1]:
            w[60:] = [x.upper() + "!!" for x in w[60:]]
        texts.append(" ".join(w))
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")
    got = quality.quality_scores(docs_of(spark, texts), labels).filter("held_out").collect()
    assert np.mean([r.predicted == good[r.doc_id] for r in got]) > 0.95


def test_license_scan_against_every_window(spark):
    random.seed(4)
    names = dict(licenses.TEMPLATES)
    filler = ["".join(random.choices("mnopq", k=4)) for _ in range(50)]
    texts, want = [], {}
    for i in range(60):
        w = random.choices(filler, k=random.randint(0, 80))
        if i % 2:
            name = random.choice(list(names))
            at = random.randint(0, len(w))
            want[i] = (name, at)
            w[at:at] = names[name].split()
        texts.append(" ".join(w))
    whole = [r for r in licenses.scan_licenses(docs_of(spark, texts)).collect() if r.containment == 1.0]
    # a planted text may hold a shorter template whole
    assert {r.doc_id: (r.license, r.first_word) for r in whole if r.license == want[r.doc_id][0]} == want
    assert all(" ".join(names[r.license].split()[:6]) in names[want[r.doc_id][0]] for r in whole)


def test_masks_hit_every_window():
    for gone in itertools.combinations(range(decontaminate.WINDOW), decontaminate.WINDOW - decontaminate.NEEDED):
        assert any(not set(gone) & {o + x for x in m} for m in decontaminate.MASKS for o in range(decontaminate.WINDOW - decontaminate.SPAN + 1))


def test_leaks_with_substitutions(spark):
    item = " ".join(f"a{i}" for i in range(20))
    two = item.split()
    two[4], two[9] = "zz", "yy"
    many = [w if i % 3 else "q" for i, w in enumerate(item.split())]
    short = "one two three four five six seven eight"
    texts = ["x y " + item, "x " + " ".join(two) + " y", " ".join(many), "p " + short, short[:-5], "", None, item + " " + item]
    bench = spark.createDataFrame([(1, item), (2, short), (3, "tiny item"), (4, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 1), (1, 1), (3, 2), (7, 1)}
    assert {r.doc_id for r in decontaminate.decontaminate(docs_of(spark, texts), bench).collect()} == {2, 4, 5, 6}


def test_html_articles_and_style_tree(spark):
    page = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header>Site</header><nav><ul><li>Home</ul></nav>"
            "<div class='cookie-notice'>ok?</div><article><header><h1>Title &amp; more {k}</h1></header><p>One\n  two<br>three {k}"
            "<p>Four <b>five</b> &eacute;</p><div class='tagline'>Read the paper every day</div><aside>side</aside><form>f</form></article>"
            "<div id='comments'><p>nice</p></div><footer>foot</footer></body></html>")
    rows = [(i, f"http://h.org/{i}", page.replace("{k}", f"text number {i} " * 3)) for i in range(12)] + [(12, None, None), (13, "x", "plain &lt;text&gt;")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_text(df).collect()}
    n = "text number 3 text number 3 text number 3"
    assert got[3] == f"Title & more {n}\nOne two three {n}\nFour five é"      # the tag line is on every page of the host
    assert got[12] == "" and got[13] == "plain <text>"
    alone = {r.page_id: r.text for r in html.extract_text(df.filter("page_id = 3")).collect()}
    assert alone[3].endswith("Read the paper every day")


def brute_ids(text, v):
    table, out = {p: (i, s) for p, i, s in v.rows}, []
    for key in pieces.words_of(text or ""):
        if key == pieces.SPACE:
            out += [v.byte_id[b] for b in key.encode()]
            continue
        w, best = pieces.lattice_word(key), [(0.0, -1, 0)]
        for e in range(1, len(w) + 1):
            best.append(max((best[s][0] + table.get(w[s:e], (0, v.fallback))[1], s, table.get(w[s:e], (-1 - ord(w[s]), 0))[0])
                            for s in range(max(0, e - v.longest), e) if w[s:e] in table or e - s == 1))
        path, at = [], len(w)
        while at:
            path.append(best[at][2])
            at = best[at][1]
        for i in path[::-1]:
            out += [i] if i >= 0 else [v.byte_id[b] for b in chr(-1 - i).encode()]
    return out


def test_encoding_round_trip_and_viterbi(spark):
    v = pieces.Vocabulary()
    texts = ["", None, " ", "  a  b ", "Hello world", "▁x ▁ ▁▁", "tab\tnew\nline", "😀 漢字 é", "x" * 1000 + " y", "▁" * 300, "don't stop. 12.5%"]
    got = pieces.encode(docs_of(spark, texts))
    rows = {r.doc_id: r for r in got.collect()}
    for i, t in enumerate(texts):
        assert rows[i].token_ids == brute_ids(t, v) and rows[i].round_trip
    assert {r.doc_id: r.text for r in pieces.decode(got).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_topk(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(400, 24))
    X[7] = X[8]
    rows = [(i, x.tolist()) for i, x in enumerate(X)] + [(500, None), (501, [float("nan")] * 24), (502, [1.0, None]), (600, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.topk_search(df, block=50).collect()}
    Q = np.floor(1024 * X).astype(np.int64)
    for q in range(0, 400, 100):
        score = Q @ Q[q]
        ranked = sorted([(-int(s), i) for i, s in enumerate(score) if i != q] + [(0, 600)])[:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, -s) for s, i in ranked]
    assert got[600, 1] == (0, 0) and got[600, 10] == (9, 0)


def test_url_rules_and_words(spark):
    u = ["http://WWW.example.com/en/1?q", "https://a.b.example.com/en/x#y", "http://q.com/", "ftp://n.net/es/1", "http://notcom/en/", "http://m.spam-farm.example.org/x",
         "http://casinowin.org/a", "http://plain.org/a", None, "no scheme", "http://c.com", "http://x.net/fr/?a"]
    df = spark.createDataFrame(list(enumerate(u)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(df).collect()}
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1][2:] == ("example.com/en/", "block") and got[2][2:] == ("com/", "allow") and got[3][2:] == ("net/es/", "block")
    assert got[4][2] is None and got[10] == ("c.com", "", None, "allow") and got[11][2] == "net/fr/"
    assert got[5][2:] == (None, "block") and got[6][3] == "block" and got[7][3] == "allow"
    assert got[8][:3] == ("", "", None) and got[9][:3] == ("", "", None)


def jaccard(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_components(spark, block):
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    base = random.choices(words, k=300)
    for i in range(40):     # a chain of near copies, each a little further from the first
        base = list(base)
        base[random.randrange(300)] = f"z{i}"
        base[random.randrange(300)] = f"y{i}"
        rows.append((6000 + i, " ".join(base)))
    rows += [(7000, "a b"), (7001, "A  b"), (7002, ""), (7003, None), (7004, "one two three four five"), (7005, "one two three four five six")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, setjoin.jaccard_components(df, block=block).drop("dig", "stays").collect()))
    assert got == jaccard(rows)
    assert collections.Counter(c for _, _, c in got)[6000] > 5 and math.isfinite(len(got))
