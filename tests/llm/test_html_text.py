import re
import time

import pytest

from pressgauge.llm import html_text

LONG = "The council met on Monday, and after a long debate, it approved the plan. Work begins in May; costs are shared."

PAGE = f"""<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{{x:y}}</style><script>var t="</p>";</script></head><body class="home has-sidebar">
<header><h1>Site</h1><p>{LONG}</p></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and {LONG}</p></div><!-- ad <p>no</p> --><div class="ad">Buy, buy, buy! {LONG}</div>
<article class="post"><header><h1>Title &lt;here&gt;</h1></header><p><b>First &amp; <i>fore</i>most.<br>{LONG}<p>Short.</p><ul><li>one<li>two</ul>
<form><label>Mail</label><input name="a"></form><h2 id="related">Sub</h2><blockquote>{LONG}</blockquote>
<section id="comments"><article class="comment"><p>{LONG} I disagree.</p></article></section><footer>Filed, today.</footer></article>
<aside><p>{LONG}</p></aside><footer>&copy; Site &middot; all, rights.</footer>"""


def test_article_without_its_surroundings():
    expected = ["Title <here>", f"First & foremost. {LONG}", "Short.", "one", "two", "Sub", LONG]
    assert html_text.main_text(PAGE).split("\n\n") == expected


def test_page_without_article_element():
    page = f"""<body><div id="menu"><a>One</a> <a>Two</a></div><div class="links"><p><a>x</a></p><p><a>y</a></p><p><a>z</a></p></div>
    <div class="text"><h2>Head</h2><p>{LONG}</p><p>{LONG} {LONG}</p><p>Tail.</p></div><div class="sidebar-right"><p>{LONG}</p></div></body>"""
    assert html_text.main_text(page).split("\n\n") == ["Head", LONG, f"{LONG} {LONG}", "Tail."]


def paragraphs(count, size=500, marks=5):
    """Paragraphs of so many characters, with so many punctuation marks, each begun by its number."""
    words = [f"{i} " + "word " * (size // 5) for i in range(count)]
    return [w[: size - marks].rstrip().ljust(size - marks, "x") + "." * marks for w in words]


def test_body_beside_article_teasers():
    body, teaser = paragraphs(5), "t" * 149 + "."
    inside = "".join(f"<p>{p}</p>" for p in body)
    for count in (1, 2):
        teasers = f"<article class='teaser'><p>{teaser}</p></article>" * count
        for tag in ("div", "section"):
            page = f"<body><{tag}>{inside}</{tag}>{teasers}</body>"
            assert html_text.main_text(page).split("\n\n") == body
    page = f"<body><div><p>{teaser}</p></div><article>{inside}</article></body>"
    assert html_text.main_text(page).split("\n\n") == body


def test_lists_tables_and_quotes_inside_the_body():
    a, b, c = paragraphs(3)
    items = [f"item {i} of thirty characters" for i in range(10)]
    listed = "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>"
    table = "<table><tr><td>one<td>two<tr><td><ul><li>three</ul></table>"
    page = f"""<body><div class="links"><ul><li>x<li>y</ul></div><div>
    <p>{a}</p>{listed}<p>{b}</p>{table}<blockquote><p>Said.</p></blockquote><dl><dt>term<dd>sense</dl><p>{c}</p></div></body>"""
    assert html_text.main_text(page).split("\n\n") == [a, *items, b, "one", "two", "three", "Said.", "term", "sense", c]


def test_broken_markup_never_fails():
    pieces = ["<p>", "</p", "<div class='a", "<!--", "text, ", "<script>", "</script>", "<", "&amp", "<b", "</table>", '<a href="', "<td>", "\x00", "]]>"]
    for i in range(len(pieces) ** 2):
        html_text.main_text("".join(pieces[(i * k) % len(pieces)] for k in range(1, 12)))
    assert html_text.main_text("<p>" * 3000 + "deep, text.") == "deep, text."
    assert html_text.main_text("<div>" * 3000 + "deep, text.") == "deep, text."


def test_ratios_by_hand():
    page = html_text.parse("<p>aaaa.</p><p>bb.</p>")
    assert [t for _, t in page.blocks] == ["aaaa.", "bb."] and len({page.path[e] for e, _ in page.blocks}) == 1
    (ratio,) = html_text.content_paths(page, [0, 1]).values()
    assert abs(ratio - 4 * (1 + 1)) < 1e-9


def test_given_pages_by_template(spark):
    """The generated pages hold their article in one element: cut it out by pattern and compare."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    import html as entities

    for row in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == "\n\n".join(b for b in blocks if b)


def test_odd_rows(spark):
    rows = [(1, "u", None, "own"), (2, None, "", "own"), (2, "u", f"<p>{LONG}", None), (2, "u", f"<p>{LONG}", None), (None, "u", "x" * 100_000, "own")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "u", ""), (2, None, ""), (2, "u", LONG), (2, "u", LONG), (None, "u", "x" * 100_000)]))
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


PROSE = "A long sentence about the town, its river and its mills. Another one follows, no shorter than the first! And a third."


def whole_page(body):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def prose_paragraphs(count=4):
    return "".join(f"<p>{PROSE} Number {i}.</p>" for i in range(count))


EVERYTHING = "\n\n".join(f"{PROSE} Number {i}." for i in range(4))


@pytest.mark.parametrize("before, after", [
    ('<article class="post ad-free">', "</article>"), ('<div class="header-wrap-post">', "</div>"),
    ('<div id="content" class="search-friendly">', "</div>"), ('<div class="nav"><div class="promo"><section>', "</section></div></div>"),
    ("<div>", "</div>"), ("", ""),
])
def test_a_name_never_takes_the_prose_away(before, after):
    for extra in ("", "<p>Short line outside.</p>", '<ul class="menu"><li>Home</li><li>News, sport, arts.</li></ul><div class="cookie-notice">We use cookies.</div>'):
        found = html_text.main_text(whole_page(f"{before}{prose_paragraphs()}{after}{extra}"))
        assert EVERYTHING in found and "cookies" not in found and "Home" not in found


def test_comments_and_adverts_go_inside_an_article_too():
    talk = "".join(f"<p>I think so too, and so does my neighbour, dear reader. Talk {i}!</p>" for i in range(40))
    for name in ("user-responses", "comments", "reply-list"):
        found = html_text.main_text(whole_page(f'<article>{prose_paragraphs()}<section class="{name}">{talk}</section></article>'))
        assert found == EVERYTHING
        assert html_text.main_text(whole_page(f'<div><div>{prose_paragraphs()}</div><div id="{name}">{talk}</div></div>')) == EVERYTHING
    line = f'<p>{PROSE} <span class="advert">Buy <span>now</span> here!</span>Number 0.</p>'
    assert html_text.main_text(whole_page(f"<article>{line}{prose_paragraphs()[prose_paragraphs().index('</p>') + 4:]}</article>")) == EVERYTHING
    assert html_text.main_text(whole_page(f'<article>{prose_paragraphs()}<p>See <span class="road">the <b>d</b>river</span>.</p></article>')) == f"{EVERYTHING}\n\nSee the driver."


def test_deep_pages_take_linear_time():
    start = time.perf_counter()
    assert html_text.main_text("<div>" * 100_000 + PROSE) == PROSE
    assert time.perf_counter() - start < 5
