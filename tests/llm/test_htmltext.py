import pytest

from check_queries import compare, connect
from tidegrid.llm import htmltext
from tidegrid.llm.htmltext import main_text

LONG = "A sentence of the article that goes on for a while, so that its line has many characters and few tags. "


def test_every_unwanted_part_is_left_out():
    html = f"""<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head>
    <body class="has-sidebar"><div class="cookie-notice">We use cookies. {LONG}</div>
    <header><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
    <div id="topMenu"><a href="/">Home</a></div>
    <article><header><h2>The   title</h2><p class="byline">By someone</p></header>
    <p>{LONG}<script>track()</script><b>bold</b>,<br>next&nbsp;line &amp; more&hellip;</p>
    <div class="ad-slot">{LONG}</div><aside>{LONG}</aside><p>Short.</p><p class="notice">{LONG}</p>
    <form><label>Mail</label><input name=q><button>Send</button></form>
    <blockquote>{LONG}</blockquote><noscript>Turn it on</noscript><!-- hidden --><footer>Filed under</footer></article>
    <section class="comments"><h3>Comments</h3><article class="comment"><p>{LONG * 4}</p></article></section>
    <div class="sidebar"><p>{LONG}</p></div><div style="display: none">{LONG}</div><footer>&copy; all {LONG}</footer></body></html>"""
    long = LONG.strip()
    assert main_text(html) == f"The title\n{long} bold, next line & more…\nShort.\n{long}"


@pytest.mark.parametrize("page", [
    "<div id=wrap><div class=menu><a href=1>One</a></div><div id=content>{body}</div><div class=side><a href=2>Two</a> <a href=3>Three</a></div></div>",
    "<table><tr><td><a href=1>One</a><br><a href=2>Two</a></td><td>{body}</td></tr></table>",
    "<main>{body}</main><div>Imprint</div>",
    "<form id=aspnetForm><div role=banner>Bank</div><main>{body}</main></form>",
    "<nav><ul><li>unclosed<article>{body}</article>",
    "<section class=comment-list><p>" + LONG * 9 + "</p></section><article>{body}</article>",
])
def test_regions(page):
    body = f"<h1>Title</h1><p>{LONG}<p>Be.</p><ul><li>first<li>second</ul><p>{LONG}</p><p>{LONG}</p>"
    long = LONG.strip()
    expected = f"Title\n{long}\nBe.\nfirst\nsecond\n{long}\n{long}"
    assert main_text(f"<html><body>{page.format(body=body)}</body></html>") == expected
    assert main_text(page.format(body=body)) == expected


def test_several_parts_without_an_article_element():
    page = f"<body><div><p>{LONG}</p></div><div><p>{LONG}</p><p>x</p></div><div><a href=1>One</a> <a href=2>Two</a></div></body>"
    assert main_text(page) == f"{LONG.strip()}\n{LONG.strip()}\nx"


def test_short_article_beside_longer_text():
    assert main_text(f"<div>{LONG * 3}</div><article><p>Yes.</p></article><div>{LONG * 3}</div>") == "Yes."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>", ""), ("<article></article>", ""),
    ("<article><p>a<!-- x > y --> b</p></article>", "a b"),
    ("<article>one<p>two</article>three", "one\ntwo"),
    ("<article><p>1 < 2 &lt; 3 &#233; &#x1F600; &unknown; &amp</p></article>", "1 < 2 < 3 é 😀 &unknown; &"),
    ("<article><p>cut <b", "cut"),
    ("<article><![if x]><p>a</p><![endif]></article>", "a"),
    ("<ARTICLE><P CLASS='x'>A</P></ARTICLE>", "A"),
    ("<article><p>a</div></section>b</p></article>", "ab"),
    ("<article><p>a</p><!-- never closed <p>b</p>", "a"),
    ("<article><pre>a\n  b</pre><span class=ad>buy</span>c</article>", "a b\nc"),
])
def test_edges(html, text):
    assert main_text(html) == text


def test_smoothing_is_a_weighted_mean():
    import numpy as np

    ratios = np.array([0.0, 10, 0, 0, 5, 100, 0, 0, 3, 3])
    got = htmltext.smoothed(ratios)
    for i in range(10):
        near = [j for j in range(10) if abs(i - j) <= htmltext.RADIUS]
        w = [np.exp(-((i - j) ** 2) / (2 * htmltext.SIGMA**2)) for j in near]
        assert got[i] == pytest.approx(sum(a * ratios[j] for a, j in zip(w, near)) / sum(w))


def test_very_long_page_and_deep_nesting():
    page = "<article>" + "".join(f"<p>Paragraph {i}.</p>" for i in range(30_000)) + "</article>"
    assert main_text(page) == "\n".join(f"Paragraph {i}." for i in range(30_000))
    assert main_text("<div>" * 3000 + LONG + "</div>" * 3000) == LONG.strip()


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table_against_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, "op11_html_extraction") is None


def test_clashing_names_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame(
        [(1, "<article>é<p>b</article>", "t", 7), (1, "<article>é<p>b</article>", "t", 7), (2, None, None, None)],
        "page_id long, html string, Text string, _html int")
    got = htmltext.extract(pages)
    assert got.columns == ["page_id", "html", "Text", "_html", "text_", "n_chars"]
    assert sorted((r["page_id"], r["text_"], r["n_chars"]) for r in got.collect()) == [(1, "é\nb", 3), (1, "é\nb", 3), (2, "", 0)]
    assert htmltext.extract(pages.limit(0)).collect() == []
