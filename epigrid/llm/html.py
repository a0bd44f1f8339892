"""Main text of web pages: landmarks of the markup plus a site style tree.

All pages of one host are merged into a style tree.  A node is the path of element
names with class and id; equal siblings share a node.  Per node the pages vote with
a presentation (the sequence of child elements) and a content (the text of the whole
branch, so a node's content already holds that of the nodes below it).  With m
distinct pages, the importance of either is its entropy over log(m); the composite
importance of a branch weighs presentation 0.1 and content 0.9.  Branches that show
nearly the same thing on all pages that have them (importance below 0.2 on at least 8
distinct pages of the host, however many other pages it has) are removed from each page.

Markup says the rest: scripts, styles, navigation, asides, forms, footers, page
headers, hidden parts, and parts whose class, id or role names an advert, notice,
menu, sidebar or reader comment go everywhere.  The text comes from the page's
<article> elements, else from <main>, else from the body.  Inside article or main the
tree removes containers only, never paragraphs or headings, and never a branch with
half of the text: pages that repeat one article keep it.

Scale: votes are pre-aggregated per (host, node, presentation, content), so a host
with a third of all pages is combined map-side.  Removable nodes are a stored table that
meets each page's own nodes by (host, node), so a page's list holds none but its own.

Defined results: null html is empty and gives empty text; a null url has no host and
takes no part in the tree; unclosed or stray tags are read as browsers do in the
simple cases; repeated rows stay repeated (exact copies of a page vote once); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .urls import host_of

NOISE, LEAST_PAGES = 0.2, 8
PRIME, BASE = (1 << 61) - 1, 0x9E3779B97F4A7C15 % ((1 << 61) - 1)     # of the running hash over a page's texts

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}
LISTS = frozenset("ul ol dl table tbody thead tfoot menu select".split())
DROPPED = RAW | frozenset("nav aside footer form button select option input menu dialog object embed svg canvas audio video "
                          "applet label fieldset head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar "
                  "menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification "
                  "popup modal overlay newsletter subscribe subscription share sharing social related recommended comment "
                  "comments disqus replies footer masthead widget pagination pager toolbar skip copyright login signup".split())
CONTAINERS = frozenset("div section ul ol dl table aside header details span".split())


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


class Page:
    """Element nodes in page order and the text chunks below them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.name, self.dead, self.last = ["#"], [-1], ["#"], [False], [0]
        self.items: list[tuple[int, str | None]] = []       # (node, text) or (node, None) for a block edge
        self.inside, self.open = [False], {}                # node in article or main; open elements by name
        # per level of the stack: the nearest level, itself or outer, of a block and of an element that CLOSES or LISTS names
        self.blocks, self.listed = [0], [0]
        stack, at, n, find = [0], 0, len(html), _TOKEN.search
        while at < n:
            m = find(html, at)
            end = m.start() if m else n
            if end > at:
                self.items.append((stack[-1], html[at:end]))
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._close(stack, tag)
                continue
            self._imply(stack, tag)
            if tag in BLOCK:
                self.items.append((stack[-1], None))
            attrs = m[3] or m[6]
            node = self._open(stack[-1], tag, attrs)
            if tag == "br":
                self.items.append((stack[-1], " "))
            if tag in VOID:
                continue
            if tag in RAW:
                shut = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = shut.end() if shut else n
                continue
            self._push(stack, node, tag)

    def _open(self, parent: int, tag: str, attrs: str) -> int:
        name, dead = tag, tag in DROPPED
        if attrs and not attrs.isspace():
            for key, value in _ATTR.findall(attrs):
                key, value = key.lower(), value.strip("\"'").lower()
                if key in ("class", "id"):
                    name += ("." if key == "class" else "#") + value
                    words = set(re.split(r"[\s_-]+", value))
                    dead = dead or bool(words & NAMES) or ("header" in words and not self.inside[parent])
                elif key == "role":
                    dead = dead or value in ROLES
                elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                    dead = True
        if tag == "header" and not self.inside[parent]:
            dead = True
        self.tag.append(tag)
        self.parent.append(parent)
        self.name.append(name)
        self.dead.append(dead or self.dead[parent])
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        return len(self.tag) - 1

    def _push(self, stack: list[int], node: int, tag: str) -> None:
        level = len(stack)
        stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.blocks.append(level if tag in BLOCK else self.blocks[-1])
        self.listed.append(level if tag in CLOSES or tag in LISTS else self.listed[-1])

    def _cut(self, stack: list[int], k: int) -> None:
        for x in stack[k:]:
            self.open[self.tag[x]] -= 1
        del stack[k:], self.blocks[k:], self.listed[k:]

    def _imply(self, stack: list[int], tag: str) -> None:
        """Elements that an opening tag ends without a closing one."""
        if tag in BLOCK and tag not in ("html", "head", "body"):
            k = self.blocks[-1]
            if k and self.tag[stack[k]] == "p":
                self._cut(stack, k)
                self.items.append((stack[-1], None))
        if tag in CLOSES:
            k = self.listed[-1]
            while k:
                t = self.tag[stack[k]]
                if t in CLOSES[tag]:
                    self._cut(stack, k)
                    self.items.append((stack[-1], None))
                    if tag != "tr" or t == "tr":
                        break
                elif t in LISTS:
                    break
                k = self.listed[k - 1]

    def _close(self, stack: list[int], tag: str) -> None:
        if not self.open.get(tag):
            return
        k = len(stack) - 1
        while self.tag[stack[k]] != tag:
            k -= 1
        if self.blocks[-1] >= k:
            self.items.append((stack[k], None))
        self._cut(stack, k)

    def keys(self) -> list[int]:
        """The style-tree node of each element."""
        memo, out = {}, [_digest("#")]
        for i in range(1, len(self.tag)):
            at = (out[self.parent[i]], self.name[i])
            if at not in memo:
                memo[at] = _digest(f"{at[0]}/{at[1]}")
            out.append(memo[at])
        return out

    def votes(self) -> tuple[int, list[tuple[int, int, int]]]:
        """The page's fingerprint, and (node, presentation, content) of each node.

        The items of a branch stand side by side, so its content is a range of one running hash.
        """
        keys, below, parent = self.keys(), {}, self.parent
        n = len(keys)
        for i in range(1, n):
            below.setdefault(keys[parent[i]], []).append(self.name[i])
        first, last, sums, powers = [-1] * n, [0] * n, [0], [1]
        for node, text in self.items:
            if text and not text.isspace():
                if first[node] < 0:
                    first[node] = len(sums) - 1
                sums.append((sums[-1] * BASE + _digest(" ".join(text.split()))) % PRIME)
                powers.append(powers[-1] * BASE % PRIME)
                last[node] = len(sums) - 1
        for i in range(n - 1, 0, -1):           # a node stands after its parent
            if first[i] >= 0:
                up = parent[i]
                first[up] = first[i] if first[up] < 0 else min(first[up], first[i])
                last[up] = max(last[up], last[i])
        own = dict.fromkeys(keys[1:], 0)
        for i in range(1, n):
            if first[i] >= 0:
                size = last[i] - first[i]
                own[keys[i]] = (own[keys[i]] * powers[size] + sums[last[i]] - sums[first[i]] * powers[size]) % PRIME
        return sums[-1], [(k, _digest(" ".join(below.get(k, ()))), x) for k, x in own.items()]

    def text(self, noise: frozenset[int] = frozenset()) -> str:
        n = len(self.tag)
        dead = self.dead
        root = [False] * n
        for want in ("article", "main", "#"):
            if any(self.tag[i] == want and not dead[i] for i in range(n)):
                for i in range(n):
                    root[i] = self.tag[i] == want or i > 0 and root[self.parent[i]]
                break
        if noise:
            keys, size = self.keys(), [0] * n
            for node, text in self.items:
                if text and root[node] and not dead[node]:
                    size[node] += len(text)
            for i in range(n - 1, 0, -1):
                size[self.parent[i]] += size[i]
            dead = list(dead)
            for i in range(1, n):
                dead[i] = dead[i] or dead[self.parent[i]] or (
                    keys[i] in noise and 2 * size[i] < size[0] and (want == "#" or self.tag[i] in CONTAINERS))
        blocks, now = [], []
        for node, text in self.items:
            if text is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif root[node] and not dead[node]:
                now.append(unescape(text) if "&" in text else text)
        blocks.append("".join(now))
        return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for host, html in zip(pdf["host"], pdf["html"], strict=True):
            page, votes = Page(html).votes()
            out += [(host, page, *v) for v in votes]
        yield pd.DataFrame(out, columns=["host", "page", "node", "style", "content"])


def _nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"host": pdf["host"], "key": pdf["key"], "nodes": [list(dict.fromkeys(Page(h).keys()[1:])) for h in pdf["html"]]})


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = [Page(h or "").text(frozenset(x) if x is not None and len(x) else frozenset())
                 for h, x in zip(pdf["html"], pdf["noise"], strict=True)]
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every style-tree node; ``pages`` has host and html."""
    votes = (pages.filter("host <> '' AND html IS NOT NULL").select("host", "html")
             .mapInPandas(_votes, "host string, page long, node long, style long, content long").distinct())

    def entropy(kind: str) -> DataFrame:
        per = votes.groupBy("host", "node", kind).agg(F.count("*").alias("n"))
        return per.groupBy("host", "node").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log(F.col("n"))).alias("s")) \
            .select("host", "node", "m", (F.log("m") - F.col("s") / F.col("m")).alias(kind))

    both = entropy("style").join(entropy("content").drop("m"), ["host", "node"])
    share = (0.1 * F.col("style") + 0.9 * F.col("content")) / F.log("m")
    return both.select("host", "node", F.col("m").alias("pages"), F.when(F.col("m") > 1, share).otherwise(1.0).alias("importance"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("key", F.unhex(F.md5(F.col("html").cast("binary"))))
    tree = style_tree(rows)
    # stored, so that its size is known when the join is planned
    noise = store(tree.filter((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < NOISE)).select("host", "node"), "noise")
    own = (rows.filter("host <> '' AND html IS NOT NULL").select("host", "key", "html")
           .mapInPandas(_nodes, "host string, key binary, nodes array<long>").select("host", "key", F.explode("nodes").alias("node")))
    found = own.join(noise, ["host", "node"]).groupBy("host", "key").agg(F.collect_set("node").alias("noise"))
    # ids travel as text: pandas would turn a column with nulls to floats, which cannot hold large ids
    return (rows.join(found, ["host", "key"], "left").select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "noise")
            .mapInPandas(_texts, "page_id string, url string, text string, n_chars long")
            .withColumn("page_id", F.col("page_id").cast("long")))
