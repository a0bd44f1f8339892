
import math
import random

from epigrid.llm import decontaminate, html, pieces, urls


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def whole_text_ids(text, v):
    """Viterbi over the whole text, with spaces as U+2581 and a literal U+2581 as its bytes."""
    if not text:
        return []
    table = {p: (i, s) for p, i, s in v.rows}
    w = "▁" + text.replace("▁", "\0").replace(" ", "▁")
    best = [(0.0, -1, 0)]
    for e in range(1, len(w) + 1):
        best.append(max((best[s][0] + table.get(w[s:e], (0, v.fallback))[1], s, table.get(w[s:e], (-1 - ord(w[s]), 0))[0])
                        for s in range(max(0, e - v.longest), e) if w[s:e] in table or e - s == 1))
    path, at = [], len(w)
    while at:
        path.append(best[at][2])
        at = best[at][1]
    return [x for i in path[::-1] for x in ([i] if i >= 0 else [v.byte_id[b] for b in ("▁" if i == -1 else chr(-1 - i)).encode()])]


def test_runs_of_spaces(spark):
    v = pieces.Vocabulary()
    assert any(set(p) == {pieces.SPACE} and len(p) == 8 for p, _, _ in v.rows)
    texts = ["if x:\n        return the value", "  two", "end  ", "   ", "a.  b   c    d", " " * 40 + "x" + " " * 17, "▁  ▁x ▁", "one two", "a ▁  b"]
    for r in pieces.encode(docs_of(spark, texts)).collect():
        assert r.token_ids == whole_text_ids(texts[r.doc_id], v) and r.round_trip, texts[r.doc_id]


def test_words_of_any_length(spark):
    v = pieces.Vocabulary()
    rng = random.Random(4)
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400)) for _ in range(12)]
    texts = letters + ["漢字仮名交じり文中国" * 60, "line\n" * 200, " " * 700 + "x", "a " + "🙂é" * 150 + " ▁" + "ab" * 200, "the" * 25000]
    for r in pieces.encode(docs_of(spark, texts)).collect():
        assert r.token_ids == whole_text_ids(texts[r.doc_id], v) and r.round_trip, texts[r.doc_id][:50]


def test_url_counts_are_whole(spark):
    # more than 100,000 (word, label) rows of count 2, and two words on one host each
    many = spark.range(102_000).selectExpr("id", "explode(array('http://alpha.org/w', 'http://gamma.org/w')) AS u").selectExpr("id", "concat(u, id) AS url")
    few = spark.createDataFrame([(-1, "http://casino.org/rare"), (-2, "http://alpha.org/rare"), (-3, "http://casino.org/only"), (-4, "http://alpha.org/")], "id long, url string")
    got = {r.page_id: r.log_odds for r in urls.url_filter(many.unionByName(few), id_col="id").filter("page_id < 0").collect()}
    allow, block = 2 * 102_000 + 1 + 4 + len(urls.PLAIN_WORDS), 2 + 2 + len(urls.BLOCK_WORDS)
    share = block / (allow + block)
    odds = lambda b, a: math.log((b + share / 2) / (a + (1 - share) / 2)) - math.log(share / (1 - share))
    rare, only = odds(1, 1), odds(1, 0)
    assert math.isclose(got[-2] - got[-4], rare, abs_tol=1e-9)
    assert math.isclose(got[-3] - got[-1], only - rare, abs_tol=1e-9)


def test_boilerplate_of_a_small_section_and_beside_copies(spark):
    def page(k, kind):
        return f"<body><div class='{kind}'><p>Read the {kind} every day</p></div><div class='t{kind}'><p>{kind} text number {k} is here</p></div></body>"

    section = [(k, f"http://hot.org/{k}", page(k, "few")) for k in range(10)]
    hot = section + [(100 + k, f"http://hot.org/{100 + k}", page(k, "many")) for k in range(1200)]
    copies = [(5000 + k, f"http://copied.org/{k}", page(k % 20 if k < 40 else 0, "many")) for k in range(2001)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(hot + copies, "page_id long, url string, html string")).collect()}
    alone = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(section, "page_id long, url string, html string")).collect()}
    assert alone[3] == got[3] == "few text number 3 is here"
    assert got[103] == got[5003] == "many text number 3 is here" and got[7000] == "many text number 0 is here"


def test_leaks_are_judged_by_row(spark):
    item = " ".join(f"b{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, "x " + item), (None, "clean"), (7, item + " y"), (7, "also clean"), (8, None)]
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {tuple(r) for r in got} == {(None, "clean"), (7, "also clean"), (8, None)} and len(got) == 3
