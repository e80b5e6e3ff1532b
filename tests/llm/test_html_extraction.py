from __future__ import annotations

import html
import itertools
import random
from html.parser import HTMLParser

import pytest

from ledgerlake.llm import html_extraction
from ledgerlake.llm.html_blocks import blocks
from ledgerlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"


class Plain(HTMLParser):
    """Blocks inside <article> by the standard library's parser, for pages whose article holds h1, p, b and br."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.now, self.out = False, [], []

    def flush(self):
        text = " ".join("".join(self.now).split())
        if text:
            self.out.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("article", "p", "h1", "footer"):
            self.flush()
        if tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            self.flush()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now.append(data)


def test_query_matches_plain_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, sf_dir).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) > 100
    for r in rows:
        plain = Plain()
        plain.feed(r.html)
        plain.flush()
        want = "\n".join(plain.out)
        assert got[r.page_id].text == want
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(want))


LONG = "This is a sentence of the story, with a comma and an end. " * 6
PAGES = [
    # page, its main text
    ("<p>One &amp; two&nbsp;&eacute; &#233;&lt;b&gt;</p>", None),
    ("<html><body class='has-sidebar'><header><a href=/>Site</a></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><main><article><header><h1>Title</h1></header><p>First\n\n line.<p>Second <i>line</i>.<ul><li>An item<li>Another</ul><div class='ad'>Buy!</div><p>Third.</article><section id=comments><h2>Comments</h2><article class=comment><p>Nice post!</article></section></main><aside>More</aside><footer>&copy; me</footer>", "Title\nFirst line.\nSecond line.\nAn item\nAnother\nThird."),
    ("<article>a<!-- <p>x</p> --><script>var t='</p><p>no';</script>b<style>p{}</style> c<form><label>Name</label><input value=x><button>Send</button></form></article>", "ab c"),
    ("<article><p>a < b and c<d> <em>e</em></p><p title='x > y'>q</article", "a < b and c e\nq"),
    ("<article><p>cut here <a href='/unfinished", "cut here"),
    ("<article>x<!-- never closed <p>y", "x"),
    ("<article>x<script>never closed <p>y", "x"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table><pre>k\n  v</pre><blockquote>said</blockquote></article>", "1\n2\n3\nk v\nsaid"),
    ("<div class=cookie-notice>We use cookies.</div><form id=aspnetForm><div class='article-body'><p>Text.</p></div><div class=shareButtons>Share</div></form>", "Text."),
    ("<article>one<br>two<BR/>three</article><div class='relatedPosts'><article><p>Teaser</p></article></div>", "one two three"),
    ("<body><p hidden>no</p><article><p style='display: none'>no</p><p>yes</p><noscript>no</noscript><svg><text>no</text></svg></article></body>", "yes"),
    ("<article>&am &ampx &copy &#x41; &unknown;</article>", "&am &x © A &unknown;"),
    ("plain text without any tag " + LONG, None),
    ("<div><div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div><h2>A head</h2>" + f"<p>{LONG}</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a href=4>Four</a> | <a href=5>Five</a></div></div>", "\n".join(["A head", LONG.strip(), LONG.strip(), "Short.", LONG.strip()])),
    ("", ""),
    (None, ""),
    ("<><<>></ ><!x><?y?>", None),
    ("<article>" + "<div>" * 3000 + "deep" + "</b></span></i>" * 3000 + "</article>", "deep"),
    ("<article>" + "<p>w.</p>" * 20000 + "</article>", "\n".join(["w."] * 20000)),
    ("\x00<article>nul\x00</article>", "nul\x00"),
]


@pytest.mark.parametrize("weights", ["prior", "fitted"])
def test_pages(spark, sf_dir, weights):
    w = html_extraction.PRIOR if weights == "prior" else html_extraction.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    for page, want in PAGES:
        found = blocks(page or "")
        got = "\n".join(itertools.compress((b.text for b in found), html_extraction.label(found, w)))
        if want is not None:
            assert got == want, (page or "")[:200]


def test_operator_on_odd_rows(spark, sf_dir):
    rows = [(i, f"http://h/{i}", page, "clash", 1) for i, (page, _) in enumerate(PAGES)] + [(None, None, None, None, None), (1, "http://h/1", PAGES[1][0], "again", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(4)
    got = html_extraction.extract(pages, html_extraction.fit(pages)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, (_, want) in enumerate(PAGES):
        if want is not None and i != 13:  # the page without marks is judged by shape, which these few pages do not teach
            assert by[i].text == want and by[i].n_chars == len(want)
    assert by[None].text == "" and by[None].url is None
    nothing = pages.where("false")
    assert html_extraction.fit(nothing) == html_extraction.PRIOR
    assert html_extraction.extract(nothing, html_extraction.PRIOR).count() == 0


def test_unmarked_pages_by_shape(spark, sf_dir):
    """Weights learnt from marked pages find the text of the same pages without their marks."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    w = html_extraction.fit(pages)
    right = total = 0
    for r in pages.collect():
        marked = blocks(r.html)
        want = html_extraction.label(marked, w)
        bare = r.html
        for name in ("nav", "article", "footer"):
            bare = bare.replace(f"<{name}>", "<div>").replace(f"</{name}>", "</div>")
        found = blocks(bare.replace(' class="ad"', ""))
        got = html_extraction.label(found, w)
        assert [b.text for b in found] == [b.text for b in marked]
        right += sum(x == y for x, y in zip(got, want, strict=True))
        total += len(want)
    assert right / total > 0.9


def test_min_cut_against_all_labellings():
    r = random.Random(4)
    for _ in range(400):
        n = r.randrange(1, 9)
        cost = [r.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, r.randrange(0, 6)) for a in range(n) for b in range(a) if r.random() < 0.5]

        def energy(kept, cost=cost, edges=edges):
            return sum(c for c, k in zip(cost, kept, strict=True) if c > 0 and not k) - sum(c for c, k in zip(cost, kept, strict=True) if c < 0 and k) + sum(w for a, b, w in edges if kept[a] != kept[b])

        every = list(itertools.product([False, True], repeat=n))
        least = min(map(energy, every))
        got = html_extraction.min_cut(cost, edges)
        assert energy(got) == least
        assert sum(got) == max(sum(k) for k in every if energy(k) == least)


def test_reader_never_fails_and_keeps_text():
    r = random.Random(8)
    bits = ["<p>", "</p>", "<div class='ad'>", "</div>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>", "<!--", "-->", "<script>", "</script>", "<a href=\"x", "\">", ">", "<", "&amp;", "&", "word ", "<br>", "<article>", "</article>", "<x y='", "'", "=", "</", "<!", "\n", "é"]
    for _ in range(3000):
        page = "".join(r.choice(bits) for _ in range(r.randrange(40)))
        found = blocks(page)
        assert all(b.text == " ".join(b.text.split()) and b.text for b in found)
        assert len(html_extraction.label(found, html_extraction.PRIOR)) == len(found)
    for _ in range(300):  # only escaped text and paragraphs: nothing is lost
        words = ["".join(r.choice("a<&>\"'é ") for _ in range(8)) for _ in range(5)]
        assert [b.text for b in blocks("<p>".join(html.escape(w) for w in words))] == [t for t in (" ".join(w.split()) for w in words) if t]
