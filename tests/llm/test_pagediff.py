"""Page differencing: alignment, zones, odd markup, pairs by URL."""

import random
import tracemalloc

import pytest

from ranklight.llm import pagediff as pd


def _lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(60))
def test_alignment_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    k = rng.choice([2, 5, 20])
    a, b = ([rng.randrange(k) for _ in range(rng.randint(0, 15))] for _ in range(2))
    got = pd.shared_lines(a, b)
    assert got == sorted(set(got)) and len(got) == _lcs(a, b)
    it = iter(b)
    assert all(any(a[i] == y for y in it) for i in got)


def _main(html):
    return "\n".join(t for z, t in pd.lines_of(html) if z >= pd.OPEN)


def test_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"<p>"}</style><script>var t="</p>";</script></head><body class="no-sidebar">
    <header>Site</header><nav><ul><li><a href="/x">x</a><li>y</ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
    <div id="sidebar">side</div><div class="wrap with-sidebar"><article><header><h1>The &amp; title</h1></header>
    <p><b>First  one.<br><p>Second &lt;b&gt; caf&eacute; &#8212; &am a &lt; b 3 < 4</p><aside>aside</aside>
    <div class="share">Share!</div><p hidden>gone<p>Third<form><input value="q"><button>Go</button></form>
    <ul><li>i1<li>i2</ul></article><div class="comments"><article class="comment">I disagree</article></div></div>
    <div role="navigation">pages</div><footer>&copy; me</footer></body></html>"""
    assert _main(page) == "The & title\nFirst one.\nSecond <b> café — &am a < b 3 < 4\nThird\ni1\ni2"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>a<b>b</b>c</div>d", "abc\nd"),
    ("<p>cut off <a href=\"x", "cut off"), ("<script>x", ""), ("<!-- never ends <p>a</p>", ""), ("a<br/>b<hr>c", "a\nb\nc"),
    ("<p class='ad'>x<p>y", "y"), ("</p></div>a</span>", "a"), ("<P>Up</P><FOOTER>f</FOOTER>", "Up"), ("&nbsp; a&nbsp;&nbsp;b ", "a b"),
    ("<span>in</span>side <i>it", "inside it"), ("<td>a</td><td>b</td>", "a\nb")])
def test_markup(page, want):
    assert _main(page) == want


KEPT = ['<article><p data-hidden="false">Text', '<article><p title="a hidden gem">Text', '<article><p data-id="comments">Text',
        '<article><div class="social-policy">Text</div>', '<article><section class="related-work">Text</section>',
        '<article><h2 id="search-methods">Text</h2>', '<div class="entry nav-tabs-content">Text</div>',
        '<form><article>Text</article></form>', '<form id="aspnetForm"><div class="page"><main><p>Text</main></div></form>',
        "<article><p data-x='class=ad' alt=\"role=menu\">Text", '<article><p class="nonads header-image">Text']
GONE = ['<div class="related-posts">x</div>', '<div id="siteNav">x</div>', '<div class="post-comments">x</div>', '<ul class="social-share-buttons"><li>x</ul>',
        '<div class="cookie-banner-overlay">x</div>', "<div class=ad-slot>x</div>", '<p hidden>x</p>', '<p HIDDEN="">x</p>',
        '<div role="navigation">x</div>', '<form><p>x</p></form>', '<div class="wide sidebar-left">x</div>', '<div style="display: none">x</div>',
        '<div id="page-header">x</div>', '<section class="newsletter-signup-form">x</section>']


@pytest.mark.parametrize("html", KEPT)
def test_attributes_are_read_one_by_one(html):
    assert _main(html) == "Text"


@pytest.mark.parametrize("html", GONE)
def test_other_zones(html):
    assert _main(html) == "" and _main(f"<article>Text{html}</article>") == "Text"


def test_alignment_of_a_very_long_page():
    rng = random.Random(1)
    shared = [rng.randrange(10**6) for _ in range(6000)]
    a, b = shared[:3000] + shared[:3000], shared[3000:] + shared[:3000]
    rng.shuffle(b)
    tracemalloc.start()
    got = pd.shared_lines(a, b)
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()
    it = iter(b)
    assert len(got) > 50 and all(any(a[i] == y for y in it) for i in got)


def test_differencing_where_rules_fail(spark):
    """Pages without an article, whose menus and footers have no telling names."""
    def page(i):
        return (f"<div><div><p>Start</p><p>Topics</p><p>Contact us</p></div><div><h1>Story {i}</h1><p>First {i} words.</p>"
                f"<p>Second {i} words.</p></div><div><p>Imprint</p><p>All rights reserved</p></div></div>")
    rows = [(i, f"http://h{i % 3}.org/s/{i}", page(i)) for i in range(30)]
    got = {r.page_id: r.text for r in pd.extract(_pages(spark, rows)).collect()}
    by_rules = {i: "\n".join(t for z, t in pd.lines_of(h) if z >= pd.OPEN) for i, _, h in rows}
    want = {i: f"Story {i}\nFirst {i} words.\nSecond {i} words." for i in range(30)}
    assert got == want and all(by_rules[i].count("\n") == 7 for i in want)


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")


def test_shared_lines_go(spark):
    def page(own):
        return f"<div><p>Welcome to our site</p><p>{own}</p><p>{own} more</p><p>All rights kept</p></div>"
    art = "<p>Site line</p><article><p>Same story</p></article>"
    rows = [(1, "http://a.com/news/1", page("One")), (2, "https://A.com/news/2?x=1", page("Two")), (3, "http://a.com/zzz", page("Three")),
            (4, "http://b.com/x", page("Alone")), (5, None, page("No address")), (6, "http://c.com/1", art), (7, "http://c.com/2", art),
            (8, "http://d.com/1", None), (9, "http://d.com/2", ""), (4, "http://b.com/x", page("Alone")), (None, "http://a.com/news/3", page("Four"))]
    got = {(r.page_id, r.text) for r in pd.extract(_pages(spark, rows)).collect()}
    assert got == {(1, "One\nOne more"), (2, "Two\nTwo more"), (3, "Three\nThree more"), (None, "Four\nFour more"),
                   (4, "Welcome to our site\nAlone\nAlone more\nAll rights kept"),
                   (5, "Welcome to our site\nNo address\nNo address more\nAll rights kept"),
                   (6, "Same story"), (7, "Same story"), (8, ""), (9, "")}
    assert pd.extract(_pages(spark, rows)).count() == len(rows)


def test_nearest_page_is_by_path(spark):
    rows = [(1, "http://h.com/a/x/1", "<p>L1<p>L2<p>p1"), (2, "http://h.com/a/x/2", "<p>L1<p>p2"), (3, "http://h.com/b/1", "<p>L2<p>p3")]
    got = {r.page_id: r.text for r in pd.extract(_pages(spark, rows)).collect()}
    assert got[1] == "L2\np1" and got[2] == "p2"


@pytest.mark.parametrize("block", [1 << 16, 2])
def test_copies_at_other_addresses_are_passed_over(spark, monkeypatch, block):
    monkeypatch.setattr(pd, "BLOCK_ROWS", block)

    def page(own, extra=""):
        return f"<div><p>Site</p>{extra}<p>{own}</p><p>{own} more</p><p>Kept</p></div>"
    rows = [(1, "http://a.com/x", page("One")), (2, "https://a.com/x", page("One")), (3, "http://a.com/x.html", page("One", "<nav>n</nav>")),
            (4, "http://a.com/x?page=2", page("One")), (5, "http://a.com/y", page("Two")), (6, "http://a.com/y#top", page("Two")),
            (7, "http://b.com/1", page("Only")), (8, "http://b.com/1.html", page("Only")), (9, "http://c.com/1", page("Lone")),
            (10, "http://d.com/1", "<p>Site<article><p>Story</article>"), (11, "http://d.com/2", "<p>Site<article><p>Story</article>"),
            (12, "http://d.com/3", "<p>Other<article><p>Tale</article>")]
    got = {r.page_id: r.text for r in pd.extract(_pages(spark, rows)).collect()}
    assert all(got[i] == "One\nOne more" for i in (1, 2, 3, 4)) and all(got[i] == "Two\nTwo more" for i in (5, 6))
    assert got[7] == got[8] == "Site\nOnly\nOnly more\nKept" and got[9] == "Site\nLone\nLone more\nKept"
    assert got[10] == got[11] == "Site\nStory" and got[12] == "Other\nTale"


def test_empty_table(spark):
    assert pd.extract(_pages(spark, [])).count() == 0


def test_query_on_test_data(spark):
    rows = pd.op7_page_differencing(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50 and all(r.n_chars == len(r.text) > 0 and "©" not in r.text for r in rows)
