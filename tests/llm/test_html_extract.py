"""Main text of pages: given pages by their article, made pages by their parts."""

import html
import re
import time

import pytest

from pricelens.llm import html_extract as X

SMALL = "/root/testdata/sf0.01"
P1 = "The harbour town was quiet in the morning, and the boats, all painted blue, lay still on the water."
P2 = "Nobody had expected the storm, which came from the west, to turn so early; it did &amp; it stayed."
P3 = "In the end, after three long days, the sun returned and the market opened again for everyone."
BODY = f"<p>{P1}</p><p>{P2}</p><p>Short one.</p><p>{P3}</p>"
WANT = " ".join([P1, html.unescape(P2), "Short one.", P3])
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News and more news, daily</a></li><li><a href="/c">Contact</a></li></ul>'
LONG = " ".join(["This sidebar talks, at length, about something else entirely, and it goes on and on."] * 3)

PAGES = {
    "article": f"<html><body><nav>{MENU}</nav><article><h1>Title</h1>{BODY}</article><footer>&copy; 2020</footer></body></html>",
    "div by id": f'<body><div id="header">Site name</div><div id="menu">{MENU}</div><div id="content"><h1>Title</h1>{BODY}</div><div id="sidebar"><p>{LONG}</p></div><div id="footer">Footer, with, commas</div></body>',
    "plain divs": f"<body><div>{MENU}</div><div><h1>Title</h1>{BODY}</div><div><p>About us.</p></div></body>",
    "heading before": f'<body><div class="wrap"><h1>Title</h1><div class="text">{BODY}</div></div><div class="col">{MENU}</div></body>',
    "comments": f'<main><article><h1>Title</h1>{BODY}<section class="comments"><h2>Comments</h2><article class="comment"><p>{LONG}</p></article></section></article></main>',
    "comments after": f'<body><div class="post"><h1>Title</h1>{BODY}</div><div id="comments"><ol class="commentlist"><li class="comment"><div class="comment-body"><p>{LONG}</p></div></li></ol></div></body>',
    "noise inside": f'<article><h1>Title</h1><div class="ad-slot"><p>{LONG}</p></div><p>{P1}</p><aside>{LONG}</aside><p>{P2}</p><form><p>{LONG}</p><input><button>Go</button></form><p>Short one.</p><script>if (a < b) document.write("<p>{LONG}</p>")</script><style>p > a {{}}</style><p>{P3}</p></article>',
    "cookie notice": f'<body><div class="cookie-notice" role="dialog"><p>{LONG}</p></div><div class="page"><div class="entry-content"><h1>Title</h1>{BODY}</div></div></body>',
    "form around": f'<body><form id="aspnetForm" action="x"><div>{MENU}</div><div class="main"><h1>Title</h1>{BODY}</div></form></body>',
    "layout names": f'<body class="has-sidebar"><div class="content-with-sidebar"><article class="post comments-open tag-social"><h1>Title</h1>{BODY}</article></div><div class="sidebar"><p>{LONG}</p></div></body>',
    "sections": f"<body><div>{MENU}</div><article><h1>Title</h1><section><p>{P1}</p><p>{P2}</p></section><section><p>Short one.</p><p>{P3}</p></section></article></body>",
    "wrapped paragraphs": f'<body><div><h1>Title</h1><div class="row"><div><p>{P1}</p></div></div><div class="row"><div><p>{P2}</p></div></div><p>Short one.</p><div class="row"><div><p>{P3}</p></div></div></div></body>',
    "unclosed": f"<body><nav>{MENU}</nav><article><h1>Title</h1><p><b>{P1}<br><p>{P2}<p>Short one.<p>{P3}</article><footer>x</footer>",
    "breaks": f"<body><table><tr><td>{MENU}<td><h1>Title</h1>{P1}<br><br>{P2}<br/>Short\n\n   one.<br>{P3}</table></body>",
    "upper case and quotes": f"<BODY><NAV title='a > b'>{MENU}</NAV><ARTICLE data-x=\"1 > 0\"><H1>Title</H1>{BODY}</ARTICLE></BODY>",
    "comment marks": f"<body><!-- <article><p>{LONG}</p></article> --><article><h1>Title</h1><!-- > -->{BODY}<![CDATA[]]><![foo[x]]></article><!-- end",
    "hidden": f'<body><article><h1>Title</h1><p hidden>{LONG}</p><div style="display: none">{LONG}</div>{BODY}</article></body>',
    "unclosed menu": f"<body><header><h1>Site</h1><nav>{MENU}<article><h1>Title</h1>{BODY}</article><footer>x</footer></body>",
    "article header": f'<body><header><h1>The Daily Site</h1></header><article><header><h1>Title</h1><p>By someone</p></header>{BODY}</article></body>',
}


@pytest.mark.parametrize("name", PAGES)
def test_made_pages(name):
    assert X.main_text(PAGES[name]) == "Title " + WANT


def test_odd_pages():
    assert X.main_text(None) == X.main_text("") == X.main_text("<p></p>") == X.main_text("<script>x</script>") == ""
    assert X.main_text("just text,  with\n no tags &lt;b&gt;") == "just text, with no tags <b>"
    assert X.main_text("<p>a&nbsp;b &#233;&eacute;&#xe9; &unknown; 1 < 2 & 3 > 2 <b>bo</b>ld</p>") == "a b ééé &unknown; 1 < 2 & 3 > 2 bold"
    assert X.main_text('<p>one</p><p>two <a href="x') == "one two"
    assert X.main_text("<p>a&#" + "9" * 5000 + ";b&#x" + "f" * 5000 + ";c&#0000065;</p>") == "a\ufffdb\ufffdcA"
    assert X.main_text('<p title="open>one</p><p>two</p>') == "one two"
    assert X.main_text("<div><p>x</p></div></div></p></b>") == "x"
    assert X.main_text("<nav><p>only a menu</p></nav>") == ""
    assert X.main_text("<body><div class=notice>only a notice</div></body>") == "only a notice"


@pytest.mark.parametrize("unit", ["<a href=x>", "<div>", "<p>", "<b><div>", "</b>", "<li><b>", "<a ", "<a b='", '<a b="x>" ', "<!--", "<![", "&", "<script>", "<title>", "<td><table>", "<div></span>", "<p><b></p>", "<i>x</div>", "<ul><li><a>x", "a,"])
def test_linear(unit):
    n = 400_000 // len(unit)
    start = time.time()
    X.main_text("<article><p>text</p>" + unit * n + "<p>end</p>")
    assert time.time() - start < 12


def test_query(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = X.op13_html_extract(spark, SMALL).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        article = re.search("<article>(.*)</article>", rows[r.page_id].html, re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]+>", "", re.sub("</?(p|h1|br)>", " ", article))).split())
        assert (r.url, r.text, r.n_chars) == (rows[r.page_id].url, want, len(want))


def test_rows(spark):
    rows = [(1, PAGES["article"], "x"), (1, PAGES["article"], "x"), (None, None, "y"), (2, "", "z"), (3, "<p>" + "word, " * 100_000, "w")]
    df = spark.createDataFrame(rows, "page_id long, html string, main_text string")
    for block in (8_000_000, 1):
        out = X.extract_main_text(df, block_chars=block)
        assert out.columns == ["page_id", "html", "main_text", "main_text_1"]
        got = {(r.page_id, r.main_text): r.main_text_1 for r in out.collect()}
        assert out.count() == 5 and got[(1, "x")] == "Title " + WANT
        assert got[(None, "y")] == got[(2, "z")] == "" and len(got[(3, "w")]) == 599_999
    assert X.extract_main_text(df.limit(0)).count() == 0


W = "the of harbour town quiet morning boats painted blue lay still water nobody expected storm west turn early days sun returned market opened".split()
WRAPS = {
    "article": "<article>{}</article>", "main": "<main>{}</main>", "both": "<main><article>{}</article></main>", "id": '<div id="content">{}</div>', "class": '<div class="post">{}</div>',
    "div": "<div>{}</div>", "grid": '<div class="wrap"><div class="row"><div>{}</div></div></div>', "section": "<section>{}</section>", "table": "<table><tr><td>{menu}</td><td>{}</td></tr></table>",
}


def made_page(rnd, wrap):
    """A page with one article in ``wrap`` and much around and inside it; the article's text."""

    def sentence(n=0):
        w = [rnd.choice(W) for _ in range(n or rnd.randrange(3, 18))]
        return " ".join(w[: len(w) // 2]) + (", " if len(w) > 6 and rnd.random() < 0.6 else " ") + " ".join(w[len(w) // 2 :]) + "."

    def text(most):
        return " ".join(sentence() for _ in range(rnd.randrange(1, most)))

    def links(n):
        return "<ul>" + "".join(f'<li><a href="/{i}">{sentence(2)}</a></li>' for i in range(n)) + "</ul>"

    def noise():
        t = text(4)
        return rnd.choice(
            [
                f"<nav>{links(5)}</nav>", f'<div class="menu">{links(4)}</div>', f"<header><h1>Site</h1><p>{t}</p></header>", f"<footer><p>{t}</p></footer>", f'<div id="footer"><p>&copy; {t}</p></div>',
                f"<aside><h3>More</h3><p>{t}</p></aside>", f'<div class="sidebar"><p>{t}</p>{links(4)}</div>', f'<div class="cookie-notice"><p>{t}</p><button>OK</button></div>', f'<div class="ad">{t}</div>',
                f"<form><label>{t}</label><input><button>Go</button></form>", f'<script>var a="<p>{t}</p>";</script><style>p{{}}</style>', links(6),
            ]
        )

    comment = "".join(f'<div class="comment"><p>{text(6)}</p></div>' for _ in range(rnd.randrange(1, 6)))
    comments = rnd.choice([f'<section id="comments"><h2>Comments</h2>{comment}</section>', f'<div class="comments">{comment}</div>', f'<ol class="comment-list"><li>{comment}</li></ol>', ""])
    want, inner = [sentence(5)], ""
    inner += f"<h1>{want[0]}</h1>"
    for _ in range(rnd.randrange(1, 12)):
        kind = rnd.choice(["p", "p", "p", "p", "a", "h2", "ul", "blockquote"])
        t = text(6) if kind in "pa" else sentence()
        if kind == "ul":
            items = [sentence() for _ in range(3)]
            inner += "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
            want += items
        else:
            inner += f'<p><a href="/x">{t[:3]}</a>{t[3:]}</p>' if kind == "a" else f"<{kind}>{t}</{kind}>"
            want.append(t)
        inner += noise() if rnd.random() < 0.1 else ""
    inside = rnd.random() < 0.5
    around = lambda: "".join(noise() for _ in range(rnd.randrange(0, 4)))
    body = WRAPS[wrap].format(inner + (comments if inside else ""), menu=links(3))
    return f"<html><head><title>t</title></head><body>{around()}{body}{'' if inside else comments}{around()}</body></html>", " ".join(want)


@pytest.mark.parametrize("wrap", WRAPS)
def test_pages_with_much_around_the_article(wrap):
    import random

    rnd = random.Random(wrap)
    for _ in range(150):
        page, want = made_page(rnd, wrap)
        assert X.main_text(page) == want, page
