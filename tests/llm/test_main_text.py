import html
import re

from snapledger.llm import main_text as X
from snapledger.llm import queries

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, text string, n_chars string"
BLOCK = re.compile(r"</?(?:p|h1)\b[^>]*>")


def article(page):
    """The test pages' articles, whose inner markup is known: h1, p, and unclosed b and br."""
    m = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page, re.S)
    blocks = BLOCK.split(re.sub(r"<[^>]*\Z", "", m[1]))
    lines = (" ".join(html.unescape(re.sub(r"</?(?:b|br)>", " ", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_registered_query_gives_the_articles(spark):
    got = {r.page_id: r for r in queries.QUERIES["op8_main_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)
        assert got[p.page_id].url == p.url


WORDS = "one two three four five six seven eight nine ten"


def text(page):
    return X.main_text(page, {t: 0.1 for t in ("p", "b", "h1", "div", "article", "ul", "li", "section")})


def test_boilerplate_is_left_out():
    page = f"""<html><head><title>T t t</title><style>p {{}}</style></head><body>
    <header>Site name here</header><nav><ul><li><a href=/>Home page</a><li>Menu</ul></nav>
    <div class="cookie-notice">We use cookies</div><div id=sidebar><p>Side words here</p></div>
    <article><h1>The&nbsp;title &amp; more</h1><p>{WORDS}<br>after</p><aside>aside words</aside>
    <p>{WORDS} <a href="x>y">link</a> end</p><form><label>Your name</label></form>
    <script>var x = "<p>not this</p>";</script><ul><li>item one</li><li>item two</li></ul><!-- <p>no</p> --></article>
    <section class="comments"><p>{WORDS}</p></section><div role="contentinfo">c</div><footer>&copy; x</footer>"""
    assert text(page) == f"The title & more\n{WORDS} after\n{WORDS} link end\nitem one\nitem two"


def test_broken_pages():
    assert text(f"<nav>menu words<article><p>{WORDS}") == WORDS
    assert text(f"<p>{WORDS}</p><p>{WORDS}<scr") == f"{WORDS}\n{WORDS}"
    assert text(f"<script>a<p>{WORDS}") == "" and text("<!-- x") == "" and text("<") == "<"
    assert text(f"<p title='>'>{WORDS} &lt;b&gt; &am") == f"{WORDS} <b> &am"


def test_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<p>{WORDS}</p>"), (3, "u", "plain"), (3, "u", "plain"),
            (4, "u", f"<article><p>{WORDS}</p></article>" * 20_000)]
    d = spark.createDataFrame([(*r, "t", "n") for r in rows], PAGES)
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in X.extract_pages(d).collect()}
    assert got[1, "u"] == ("", 0) and got[2, None] == ("", 0) and got[3, "u"] == ("plain", 5)
    assert got[None, "u"][0] == WORDS
    assert got[4, "u"][0] == "\n".join([WORDS] * 20_000)
    assert X.extract_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_wrappers_around_the_article_are_no_boilerplate():
    body = f"<article><h1 class='article-header'>A title</h1><p>{WORDS}</p><p>{WORDS}</p></article>"
    want = f"A title\n{WORDS}\n{WORDS}"
    for wrapper in ("div class='no-sidebar'", "div class=has-header", "div class='content-sidebar-wrap'", "div class='x sidebar'",
                    "form id='aspnetForm'", "header", "div data-id=ad", "section role=search", "div title='x class=ad'"):
        tag = wrapper.split()[0]
        assert text(f"<body><nav>menu here</nav><{wrapper}><p><a href=/>Home</a></p>{body}</{tag}><footer>c</footer></body>") == want, wrapper
        assert text(f"<body><{wrapper}>{body.replace('article>', 'div>')}</{tag}></body>") == want, wrapper
    assert text(f"<article><header><h1>A title</h1></header><p>{WORDS}</p></article>") == f"A title\n{WORDS}"
    assert text(f"<article><p>{WORDS}</p><p class=notice>not lost</p><p>{WORDS}</p></article>") == f"{WORDS}\nnot lost\n{WORDS}"
    assert text(f"<div class=widget><p>{WORDS}</p></div><div class=promo><p>{WORDS} more</p></div>") == f"{WORDS}\n{WORDS} more"
    teaser = "<aside><article><p>teaser words</p></article></aside>"
    assert text(f"{teaser}<article><p>{WORDS}</p></article>") == WORDS


def test_missing_end_tags_do_not_cut_the_rest():
    for first in ("<p class='notice'>x", "<li class='share'>x", "<div class=ad>x", "<aside>x", "<span class=ad>x", "<ul><li class=share>x</ul>",
                  "<dl><dt class=share>x<dd>y</dl>", "<table><tr><td class=ad>x</table>", "<table class=ad><tr><td>x<tr><td>y</table>"):
        got = text(f"<body><article><p>{WORDS}</p>{first}<p>{WORDS} middle</p><p>{WORDS} end</p></article><p>z</body>").split("\n")
        assert got[0] == WORDS and f"{WORDS} middle" in got and f"{WORDS} end" in got, first
    for anchor in ("<a name='top'>", "<a id='x'/>", "<a href=/>x", "<p><a href=/>x</p>", "<a href=/>x<a href=/y>y"):
        assert text(f"{anchor}<article><p>{WORDS}</p><p>{WORDS} end</p></article>").endswith(f"{WORDS}\n{WORDS} end"), anchor
    assert text(f"<article><p>{WORDS}</p></article><a href=/><div><p>linked card words</p></div></a>") == WORDS
    assert text(f"<head><title>T t</title><body><p>{WORDS}</p>") == WORDS
    assert text(f"<ul class=nav><li class=menu>one two<li>three four</ul><p>{WORDS}") == WORDS
    page = "<p><i>" * 30_000 + "<b>" * 30_000 + "</i>x</div></b>" * 30_000
    assert text(page).startswith("x")


def test_marked_containers_are_passed_over():
    """Adverts and comments, inside the article or next to it, break nothing off."""
    first, second = f"{WORDS} first " * 8, f"{WORDS} second " * 8
    lines = f"{' '.join(first.split())}\n{' '.join(second.split())}"
    for block in ('<div class="ad">buy this now</div>', f'<section id="comments"><p>{WORDS}</p><p>{WORDS} more</p></section>',
                  f'<div class="promo">{"promoted words " * 50}</div>', "<ul class='social-links'><li>one<li>two</ul>"):
        assert text(f"<article><p>{first}</p>{block}<p>{second}</p></article>") == lines, block
    for name in ("comment-list", "right-sidebar", "respond-wrap", "cookie-notice-bar"):
        beside = f'<div class="{name}"><p>{WORDS}</p><p>{WORDS}</p></div>'
        body = f"<p>{first}</p><p>{second}</p>"
        assert text(f"<body>{beside}<article>{body}</article>{beside}</body>") == lines, name
        assert text(f"<body><div>{beside}{body}{beside}</div></body>") == lines, name
    # Wrappers, long text under a name of several parts, and what ends nowhere stay.
    for name in ("has-sidebar", "no-sidebar", "ad-free", "main-nav-page"):
        assert text(f'<div class="{name}"><article><p>{first}</p><p>{second}</p></article></div>') == lines, name
        assert text(f'<div class="{name}"><p>{first}</p></div><div><p>{second}</p></div>') == lines, name
    assert text(f"<article><div class=article-header>A title</div><p>{first}</p><p>{second}</p></article>") == f"A title\n{lines}"
    assert "second" in text(f"<article><p>{first}</p><div class=ad>x<p>{second}</p></article>")
    assert text(f"<div class=comments><p>{WORDS}</p></div>") == WORDS
