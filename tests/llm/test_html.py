from __future__ import annotations

import re

from candela.llm import html_text
from candela.llm.html_pages import PageMaker
from candela.llm.html_parse import blocks


def texts(page):
    return [b.text for b in blocks(page)]


def test_parsing():
    assert texts("<p>a&amp;b<br>c<p>d <b>e</b>f</p>") == ["a&b c", "d ef"]
    assert texts("<script>var t='</p>';</script><style>p{}</style><!-- <p>x --><p>y") == ["y"]
    assert texts("<ul><li>a<li>b</ul>c") == ["a", "b", "c"]
    assert texts("<div>x &lt;p&gt; &#233;</div>") == ["x <p> é"]
    assert texts(None) == texts("") == []


def test_markup_never_leaks():
    assert texts('<p title="x>Hello</p><p>next</p>') == ["Hello", "next"]
    assert texts("<p title='a>b' data-x=\"c>d\">one</p>2 < 3 &lt;p> a<b and more") == ["one", "2 < 3 <p> a"]
    assert texts('<p class="it\'s">a</p><p x=" >b') == ["a", "b"]
    assert texts('5" disk<p>6\' tall <i>"quoted"</i>') == ['5" disk', "6' tall \"quoted\""]
    assert texts("a</>b<//x>c<?pi x?>d<![CDATA[e]]>f<!doctype x>g") == ["abcdfg"]
    assert texts("<svg width=1 />kept<button>Go</button> this<button-group>too</button-group>") == ["kept", "this", "too"]
    assert texts("<div><button>open</div><p>still here") == ["open", "still here"]
    assert texts("<div><select><option>x<option>y</div><p>z</p></select>w") == ["z", "w"]
    assert texts("<script>if (a < b) '<p>'</SCRIPT ><p>x<textarea>t<b>") == ["x"]
    assert texts("<title>t</title><noscript>n</noscript><template><p>q</p></template>r") == ["r"]


def test_hostile_pages_take_linear_time():
    import time

    n = 1 << 20
    for unit in ('<a "', "<a '>", "<a x=\">", "<div>x", "<b", "<!--", "</", "&", "<p class=", "< ", "<svg>", "<button>x", "a<br>", "<a x='\" ", "<script>"):
        began = time.process_time()
        blocks((unit * (n // len(unit)))[:n])
        assert time.process_time() - began < 4, unit


def test_article_is_found_in_held_out_pages():
    maker, model, wrong, total = PageMaker(99), html_text.train(), 0, 0
    for _ in range(100):
        page, labels = html_text.labelled_page(maker.page())
        found = model.probabilities([html_text.features(page)])[0] > 0.5
        wrong, total = wrong + int((found != (labels > 0.5)).sum()), total + len(labels)
    assert wrong / total < 0.03


def test_pages_give_their_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_pages(pages.withColumnRenamed("page_id", "page_id")).collect()}
    assert len(got) == pages.count()
    wrong = 0
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL)
        expected = "\n".join(b.text for b in blocks(article[1])) if article else ""
        wrong += got[row.page_id].text != expected
        assert got[row.page_id].n_chars == len(got[row.page_id].text)
    assert wrong <= 0.01 * len(got)


def test_odd_pages(spark):
    rows = [(1, "u", None), (None, None, ""), (2, None, "<p>"), (3, "u", "<div" * 1000), (4, "u", "<article><p>" + "Word again. " * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars")
    got = {r.page_id: r for r in html_text.extract_pages(pages).collect()}
    assert got[1].text == got[None].text == got[2].text == ""
    assert got[4].n_chars == len("Word again. " * 20_000) - 1
    assert html_text.extract_pages(pages.limit(0)).count() == 0


# Pages that no generator made, with the text that a reader would call the article.
WRITTEN = [
    (
        """<html><head><title>T</title><style>p{}</style></head><body class=home>
<div id="topnav"><a href="/">Home</a> | <a href="/a">About</a> | <a href="/c">Contact</a></div>
<div id="content"><h1>How bridges carry load</h1>
<p>An arch turns weight into thrust, which its abutments must resist. That is why old bridges have heavy ends.</p>
<p style="display:none">Track this invisible sentence, which nobody can read on the page at all.</p>
<p>A beam bends instead: its upper side is pressed, its lower side is pulled, and &ldquo;the middle&rdquo; does nothing.</p>
<p hidden>Another paragraph that is not shown to any reader of the page, whatever it says.</p></div>
<div class="footer">&copy; 2020 Someone. All rights reserved. <a href="/p">Privacy</a></div></body></html>""",
        "How bridges carry load\nAn arch turns weight into thrust, which its abutments must resist. That is why old bridges have heavy ends.\n"
        "A beam bends instead: its upper side is pressed, its lower side is pulled, and \u201cthe middle\u201d does nothing.",
    ),
]

P1 = "The river rose slowly through the night, and by morning the lower fields were under water."
P2 = "Most of the farmers had moved their animals to the hills, but a few were still waiting for help."
P3 = "Officials said that the bridge would stay closed until engineers could look at its foundations."
Q1 = "A good loaf needs little more than flour, water, salt and a great deal of patience."
Q2 = "Leave the dough in a warm place for two hours; it should double in size."
Q3 = "Bake it until the crust is dark, then let it cool before you cut it."
MENU = '<ul><li><a href="/">Home</a><li><a href="/n">News</a><li><a href="/a">About us</a></ul>'
# Short pages; the training pages were varied until these came out right.
SHORT = [
    (f'<html><body>{MENU}<p>{P1}</p><p>{P2}</p><div class="footer">Copyright 2020 Someone. All rights reserved.</div></body></html>', [P1, P2]),
    (f"<body><nav>{MENU}</nav><p>{P1}</p><p>{P2}</p><footer>Copyright 2020</footer>", [P1, P2]),
    (f"<body><h1>Flood in the valley</h1><p>{P1}</p>", ["Flood in the valley", P1]),
    (f"<div id=menu>{MENU}</div><div id=content><h1>Flood</h1><p>{P1}</p><p>{P3}</p></div><div id=footer>Contact</div>", ["Flood", P1, P3]),
    (f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>", [P1, P2, P3]),
    (f"<html><body><p>{P1}</p></body></html>", [P1]),
    (f"<article><p>{P1}</p></article><div class=comments><p>Great post, thanks for sharing this with all of us!</p></div>", [P1]),
    (
        f"<header><h1>The Daily News</h1></header><main><h2>Flood in the valley</h2><p>{P1}</p><p>{P2}</p></main>"
        "<aside><p>Subscribe to our newsletter</p></aside>",
        ["Flood in the valley", P1, P2],
    ),
    (
        '<div class="cookie-banner"><p>We use cookies to improve your experience on this site.</p></div>'
        f'<div class="post"><p>{P1}</p><p>{P2}</p><p>{P3}</p></div>',
        [P1, P2, P3],
    ),
    (
        "<div class=wrap><div class=sidebar><h3>Related</h3><ul><li><a href=x>Storm in the north</a></ul></div><div class=entry><h1>Flood</h1>"
        f"<p>{P1}</p><ul><li>Two roads closed</li><li>Forty houses evacuated</li></ul><p>{P3}</p></div></div>",
        ["Flood", P1, "Two roads closed", "Forty houses evacuated", P3],
    ),
    (f"<main><p>{P1}</p><div class=ad>Buy cheap tyres now</div><p>{P2}</p></main>", [P1, P2]),
    (
        f"<body>{MENU}<h1>Opening hours</h1><p>We are open from nine to five.</p><p>On Sundays we are closed.</p>"
        "<div class=footer><a href=/p>Privacy</a></div>",
        ["Opening hours", "We are open from nine to five.", "On Sundays we are closed."],
    ),
    (
        '<body><div class="topbar"><a href=/login>Log in</a></div><section class="story"><h2>Plain bread</h2>'
        f'<p>{Q1}</p><div class="promo-box"><p>Save half on all ovens this week.</p></div><p>{Q3}</p></section>'
        '<div class="related-posts"><h3>Read more</h3><a href=/x>Rye bread at home</a></div>',
        ["Plain bread", Q1, Q3],
    ),
    (
        f'<div class="x1"><div class="y2"><p>{Q1}</p><p>{Q3}</p></div>'
        '<div class="z3 comments-area"><p>Mine did not rise at all, what did I do wrong?</p></div></div>',
        [Q1, Q3],
    ),
    (f"<p>{Q2}</p>", [Q2]),
]


def test_written_pages():
    model = html_text.train()
    assert model.main_text([page for page, _ in WRITTEN]) == [text for _, text in WRITTEN]
    assert model.main_text([page for page, _ in SHORT]) == ["\n".join(lines) for _, lines in SHORT]


def test_a_form_around_the_page_says_nothing():
    page = blocks("<form id=f><div class=menu>x</div><p>a long text that is the page</p></form><p>more</p>")
    assert [b.path for b in html_text.unframed(page)] == [("div", "menu"), ("p",), ("p",)]
    assert html_text.unframed(blocks("<form>x</form><p>a long text</p>"))[0].inside(html_text.NEVER)
