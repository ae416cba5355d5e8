"""HTML extraction against hand-made pages and, on the driver's pages, against the plain article markup."""

import html
import random
import re
import time

import pytest

from gridloom.llm.html_text import extract, main_text, page_lines, spans
from gridloom.llm.queries import REGISTRY


def test_article_without_its_surroundings():
    page = "<head><title>T</title></head><nav><ul><li>a<article><header><h1>T&amp;U</h1></header><p>para <i>w</i>ord<div class=comments><article>c</article></div><form><p>q</form><p>the\n end</article>x"
    assert main_text(page) == "T&U\npara word\nthe end"


def test_surge_and_dive_without_article():
    page = '<header><h1>Site</h1></header><div class="content has-sidebar"><h2>T</h2><p>' + "word " * 40 + '</p><p>short</p><div class="ad-box">buy</div><p>tail</p></div><div id="comments"><p>' + "c " * 200 + "</p></div><footer>f"
    assert main_text(page) == "T\n" + ("word " * 40).strip() + "\nshort\ntail"
    assert spans([0, 10, 0, 0, 0, 50, 60, 5, 0, 0, 0, 9], 3, 80) == [(5, 8)]
    assert main_text("<p>tiny</p>") == "tiny"


def test_raw_text_comments_and_cut_tags():
    assert main_text('<p>a<script>var t="</p>";</script>b<!-- <p>no</p> --></p><p class="x') == "ab"
    assert main_text("<p>1 < 2 &lt;b&gt; &#233;&nbsp;x</p>") == "1 < 2 <b> é x"
    assert main_text("<p>kept</p><script>never closed <p>x</p>") == "kept"
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert [x.text for x in page_lines("<p>" * 9000 + "deep")[0]] == ["deep"]


LONG = ("Some words of an article that go on for a while, so that its lines are dense. " * 3).strip()
MENU = "".join(f'<div><a href="/{i}">Item {i}</a></div>' for i in range(9))


@pytest.mark.parametrize("names", ["wrapper with-sidebar", "layout no-ads", "page has-nav", "sidebar", "ad", "nav-wrapper", "newsletter", "comments"])
def test_wrappers_are_told_by_their_text(names):
    """A name in markup takes no text away where nothing else is dense; what it marks beside an article goes."""
    inner = f'<div class="{names}"><h2>Title</h2><p>{LONG}</p><p>End.</p></div>'
    assert main_text(MENU + inner) == f"Title\n{LONG}\nEnd."
    nested = f'<div id="{names}"><div class="ad-box"><div role="complementary">{inner}</div></div></div>'
    assert main_text(nested) == f"Title\n{LONG}\nEnd."
    if not names.split()[-1].startswith(("with-", "no-", "has-", "nav-wrapper")):
        assert main_text(f"<p>{LONG}</p><p>More of it.</p>{inner}") == f"{LONG}\nMore of it."


def test_links_part_no_short_lines_from_the_text():
    links = "".join(f'<div><a href="x">share {i}</a></div>' for i in range(5))
    page = MENU + "<h1>Title</h1>" + links + f"<p>{LONG}</p>" + links + "<p>Between.</p>" + links + f"<p>{LONG}</p>" + links + "<p>The last words.</p>" + MENU + "<div>Imprint</div>"
    assert main_text(page) == f"Title\n{LONG}\nBetween.\n{LONG}\nThe last words."


def test_broken_markup_leaves_nothing_behind():
    assert main_text('<p>one <a href="x>two</a> three</p><p class="k">four "five" six</p>') == 'one two three\nfour "five" six'
    assert main_text("<p title=don't>a</p><p data-x='<b>no</b>' id=\"y\">b</p>") == "a\nb"
    assert main_text('<p>a <b class="x <i>b</i></p>') == "a b"
    for n in (10, 5000):
        assert len(main_text("<div><div><nav>" + "<b>" * n + f"</div></div><p>{LONG}</p>")) == len(LONG)


@pytest.mark.parametrize("piece", ["<nav><article>", '<div class=ad><p>x</p>', '<a href="x>t ', "</b><i>", "<script>x</script><p>y</p>", "<!-- ", '<p "', "<header><footer>", "<svg>", "<div class='related'>word "])
def test_time_grows_with_the_page(piece):
    def took(n):
        began = time.process_time()
        main_text(piece * n)
        return time.process_time() - began

    took(500)
    few, many = min(took(4000) for _ in range(2)), took(32_000)
    assert many < 0.3 or many < 24 * few  # eight times the page; a square would be 64


P = "Four hundred characters of an article would stand here, were this not a test of it. " * 4
P = P.strip()


@pytest.mark.parametrize("raw", ['<script>var s="<!--";</script>', '<style>a{content:"<!--"}</style>', "<script>if (a<b && c) { d='<![CDATA[' }</script>", '<title>a <!-- b</title>', "<textarea><!-- </textarea>", "<SCRIPT>'<p>'</SCRIPT >"])
def test_comment_marks_in_scripts_open_no_comment(raw):
    assert main_text(f"{raw}<p>{P}</p>") == main_text(f"<article>{raw}<p>{P}</p></article>") == P
    assert main_text(f"<p>{P}</p>{raw}<p>End.</p>") == f"{P}\nEnd."


@pytest.mark.parametrize("mark", ['section class="social studies"', 'section id="related-work"', 'p class="privacy-law"', 'div class="search-theory"', 'section class="discussion"', 'section id="related"', 'div class="notice"'])
def test_subjects_of_an_article_stay(mark):
    tag = mark.split()[0]
    page = f"{MENU}<article><p>{LONG}</p><{mark}>{P}</{tag}><p>End</p></article>"
    assert main_text(page) == f"{LONG}\n{P}\nEnd"


@pytest.mark.parametrize("mark", ['div class="comments"', 'section id="comment-list"', 'div class="ad-box"', 'div class="related"', 'div class="share-buttons"', 'div class="cookie-notice"', 'div class="notice"'])
def test_what_is_around_goes_from_within_an_article(mark):
    tag = mark.split()[0]
    inner = '<a href="x">' + P + "</a>" if "related" in mark else "Short." if mark.endswith('"notice"') else P
    assert main_text(f"<article><p>{LONG}</p><{mark}>{inner}</{tag}><p>End</p></article>") == f"{LONG}\nEnd"


def test_formulas_and_last_lines_stay():
    assert main_text(f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p></article>") == f"{LONG}\nLet x=1 be."
    links = '<div><a href="/a">share</a></div>' * 4
    assert main_text(f"{MENU}<h1>T</h1><p>{LONG}</p>{links}<p>No full stop at the end</p>{MENU}<div>Imprint</div>") == f"T\n{LONG}\nNo full stop at the end"
    assert main_text(f"<p>{LONG}</p>{links}<p>© 2020 Somebody</p>") == LONG


def plain_article(page):
    """The article's blocks by a parser of the standard library: elements and whole names decide, nothing is weighed."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.lines, self.text, self.stack = [], [], []

        def flush(self):
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append(line)
            self.text = []

        def handle_starttag(self, tag, attrs):
            if tag not in ("b", "i", "a", "em"):
                self.flush()
            if tag not in ("br", "img"):
                self.stack.append((tag, dict(attrs).get("class", "")))

        def handle_endtag(self, tag):
            if tag not in ("b", "i", "a", "em"):
                self.flush()
            while self.stack and self.stack.pop()[0] != tag:
                pass

        def handle_data(self, data):
            tags = [t for t, _ in self.stack]
            if "article" in tags and not {"script", "style", "form", "nav", "aside", "footer"} & set(tags) and not any(c in ("comments", "ad-box", "newsletter") for _, c in self.stack):
                self.text.append(data)

    parser = Plain()
    parser.feed(page)
    parser.close()
    parser.flush()
    return "\n".join(parser.lines)


def test_pages_equal_a_plain_parser():
    rng = random.Random(9)
    words = lambda n: " ".join(rng.choice(["alpha", "b&amp;c", "<b>bold</b>", "d&#233;", "<i>it</i>alic", "日本", '<a href="/x">link</a>']) for _ in range(n))
    around = ["<nav><ul><li><a href=/>Home</a></ul></nav>", "<aside><p>" + "side text " * 30 + "</p></aside>", '<script>var a = "<!-- </p>";</script>', "<style>p{content:'<!--'}</style>", "<!-- <article>no</article> -->", "<form><p>mail<input></p></form>"]
    within = ["<script>x='<!--'</script>", '<div class="ad-box"><p>' + "buy this " * 20 + "</p></div>", "<!-- gone -->", "<form>q</form>", '<div class="newsletter">sign up</div>', '<div class="comments"><p>' + "first! " * 30 + "</p></div>"]
    for _ in range(200):
        blocks = [rng.choice([f"<p>{words(rng.randint(1, 60))}</p>", f"<h2>{words(3)}</h2>", f"<ul><li>{words(5)}</li><li>{words(9)}</li></ul>", f"<blockquote>{words(30)}<br>{words(4)}</blockquote>", rng.choice(within)]) for _ in range(rng.randint(1, 12))]
        article = f"<article><h1>{words(4)}</h1><p>{words(60)}</p>{''.join(blocks)}</article>"
        page = f"<html><head><title>t</title></head><body>{''.join(rng.sample(around, 3))}{article}{''.join(rng.sample(around, 2))}<footer>f</footer></body></html>"
        assert main_text(page) == plain_article(page)


def brute_spans(weights, window, surge):
    """Runs from the definition: surge at the first window above, back over weighty lines, dive at the first empty window."""
    total = lambda k: sum(weights[k : k + window])
    out, i, end = [], 0, 0
    while i < len(weights):
        if total(i) > surge:
            start = next(k for k in range(i, len(weights)) if weights[k])
            while start > end and weights[start - 1]:
                start -= 1
            i = next((k for k in range(max(i, start), len(weights)) if total(k) <= 0), len(weights))
            out.append((start, i))
            end = i
        else:
            i += 1
    return out


def test_spans_equal_brute_force():
    rng = random.Random(4)
    for _ in range(500):
        weights = [rng.choice([0, 0, 0, 5, 30, 90]) for _ in range(rng.randint(0, 30))]
        for window, surge in ((3, 80), (1, 20), (4, 0)):
            assert spans(weights, window, surge) == brute_spans(weights, window, surge)


def test_rows_pass_one_for_one(spark):
    rows = [(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None), (2, "v", "", "t")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_equals_plain_markup(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in REGISTRY.queries["op10_html_text"](spark, sf).collect():
        page = pages.pop(r.page_id)
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("<br>|</?p>|</?h1>", article))
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)
    assert not pages
