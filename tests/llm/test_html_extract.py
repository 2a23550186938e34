import html
import re
import time

import pytest

from salesmart.llm import html_extract
from salesmart.llm.html_extract import main_text

LONG = "The quick brown fox jumps over the lazy dog and runs away through the dark green forest until night falls."


def blocks(n, tag="p"):
    return "".join(f"<{tag}>{LONG} Number {i}.</{tag}>" for i in range(n))


def lines(n):
    return [f"{LONG} Number {i}." for i in range(n)]


def test_article_without_what_surrounds_it():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></li></ul></nav><!-- ad --><div class="ad">{LONG}</div>
    <aside><p>{LONG}</p></aside><div id="cookie-notice">We use cookies. {LONG}</div>
    <article><h1>Short &amp; <i>sweet</i></h1><p>a\n  b&nbsp;c<br>d</p>{blocks(3)}<p>Ok.</p><form><label>Mail</label><input></form>
    <div class="share">Share this</div><pre>x  y</pre></article>
    <section class="comments"><p>{LONG}</p></section><div class="sidebar">{blocks(2)}</div><footer>&copy; us</footer>"""
    assert main_text(page).split("\n") == ["Short & sweet", "a b c d", *lines(3), "Ok.", "x y"]


@pytest.mark.parametrize("page", [
    f"<body><div id=top class='navbar'><a>x</a></div><div class='wrap'><div id='content'><h1>Head</h1>{blocks(4)}</div>"
    f"<div id='sidebar'><p>{LONG}</p></div></div><div class='site-footer'>{LONG}</div>",
    f"<main><article><h1>Head</h1>{blocks(4)}</article><article class='teaser'><p>More</p></article></main><div class=comment-list><article class=comment>{blocks(1)}</article></div>",
    f"<div class='promo'><article><h1>Head</h1>{blocks(4)}</article>",
    f"<h1>Head</h1>{blocks(4)}<footer>{LONG}</footer>",
    f"<article><h1>Head</h1>{blocks(4).replace('</p>', '')}",
    f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><h1>Head</h1>{blocks(4)}<div><a href=3>About us</a> <a href=4>Terms</a></div>",
    f"<main><div class='notice'>{LONG}</div><h1>Head</h1>{blocks(4)}<div id='newsletter-box'>{LONG}</div><div class='userComments'><p>{LONG}</p></div></main>",
    f"<article><div class='article-header'><h1>Head</h1></div>{blocks(4)}<ul class='commentlist'><li>{LONG}</li></ul><div role=alert>{LONG}</div></article>",
    f"<main><h1>Head</h1>{blocks(4)}<aside>{LONG}</aside><div role='complementary'>{LONG}</div><p hidden>{LONG}</p></main>",
])
def test_templates(page):
    assert main_text(page).split("\n") == ["Head", *lines(4)]


@pytest.mark.parametrize("page", ["", "   ", "<p></p>", "<script>x</script>", "<nav>a</nav>", "<!-- only -->", "<div class=ad>x</div>"])
def test_no_article(page):
    assert main_text(page) == ""


def test_broken_markup_and_long_pages():
    assert main_text("<p>a<b>b<p>c</b></div></p>&#x41;&unknown; <") == "ab\nc\nA&unknown; <"
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"
    long = "<article>" + "<p>word</p>" * 50_000
    assert main_text(long) == "\n".join(["word"] * 50_000)


def test_given_pages_equal_their_article_element(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in html_extract.extract_pages(pages).select("html", "article.*").collect():
        body = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        parts = re.split("</?p>|</?h1>", re.sub("</?b>", "", body.replace("<br>", " ")))
        want = [" ".join(html.unescape(x).split()) for x in parts]
        assert row.text == "\n".join(x for x in want if x) and row.n_chars == len(row.text)


def test_nulls_repeats_extra_columns_and_no_rows(spark):
    rows = [(1, None, "x"), (1, "<p>é</p>", "x"), (1, "<p>é</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_extract.extract_pages(pages)
    assert sorted((r.text, r.article.text, r.article.n_chars) for r in got.collect()) == [("x", "", 0), ("x", "é", 1), ("x", "é", 1)]
    assert html_extract.extract_pages(pages.limit(0)).collect() == []


@pytest.mark.parametrize("page", [
    f"<div class=menu-top><a>x</a></div><div id=content><h1>Title</h1><p>short intro</p><p>{LONG * 20}</p><p>short end</p></div>",
    f"<div id=page><h1>Title</h1><p>short intro</p><ul><li>{LONG * 20}</li></ul><p>short end</p></div>",
    f"<main><h1>Title</h1><p>short intro</p><article><p>{LONG * 20}</p></article><article class=teaser><p>More</p></article><p>short end</p></main>",
    f"<main><div><a href=1>Home</a></div><h1>Title</h1><p>short intro</p><article><p>{LONG * 20}</p></article><p>short end</p></main>",
])
def test_what_stands_beside_one_dominating_part(page):
    assert main_text(page).split("\n") == ["Title", "short intro", LONG * 20, "short end"]


@pytest.mark.parametrize("share", [2, 6, 20])
def test_sections_of_unequal_length(share):
    page = f"<body><div id=content><div class=part1><p>{LONG * share}</p></div><div class=part2><p>{LONG}</p></div></div>"
    assert main_text(page).split("\n") == [LONG * share, LONG]
    page = f"<body><div id=content><div class=part1>{blocks(share * 2)}</div><div class=part2>{blocks(2)}</div></div>"
    assert main_text(page).split("\n") == lines(share * 2) + lines(2)


@pytest.mark.parametrize("page", [
    f"<div class='article-content share-enabled'><h1>Head</h1>{blocks(4)}</div>",
    f"<nav><a href=1>Home</a></nav><div class='layout-sidebar-right'><h1>Head</h1>{blocks(4)}<div class='ad'>{LONG}</div></div><footer>{LONG}</footer>",
    f"<div id='content' class='post related-off'><h1>Head</h1>{blocks(4)}<div class=related>{LONG}</div></div>",
    f"<form id='aspnetForm'><input type=hidden><div id=page><h1>Head</h1>{blocks(4)}</div><select><option>{LONG}</option></select></form>",
    f"<form id='aspnetForm'><article><h1>Head</h1>{blocks(4)}</article></form>",
    f"<div class=alerts><div class=promo><h1>Head</h1>{blocks(4)}</div></div>",
])
def test_a_name_around_everything_silences_nothing(page):
    text = main_text(page).split("\n")
    assert text == ["Head", *lines(4)]


def test_a_wrapper_with_the_heading_and_nearly_all_of_the_text():
    page = f"<p>{LONG}</p><div class='layout-sidebar-right'><h1>Head</h1>{blocks(20)}</div>"
    assert main_text(page).split("\n")[-21:] == ["Head", *lines(20)]
    # Long comments and a long sidebar have no heading of the page.
    page = f"<div id=content><h1>Head</h1>{blocks(3)}</div><div class=comments>{blocks(40)}</div><div class=sidebar>{blocks(40)}</div>"
    assert main_text(page).split("\n") == ["Head", *lines(3)]
    page = f"<article><h1>Head</h1>{blocks(1)}</article><div class=sidebar><h1>More</h1>{blocks(40)}</div>"
    assert main_text(page).split("\n") == ["Head", *lines(1)]


def test_commentary_is_no_comment():
    page = f"<div id=content><h1>Head</h1>{blocks(2)}<div class='commentary'><p>{LONG} Said.</p></div><div class='commentbox'><p>{LONG}</p></div></div>"
    assert main_text(page).split("\n") == ["Head", *lines(2), f"{LONG} Said."]


@pytest.mark.parametrize("named", ["div", "section"])
def test_given_pages_without_their_article_element(spark, named):
    """What names the article is taken away: the ratios and the region alone must tell it."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    same = sum(main_text(re.sub("<(/?)(article|main)>", rf"<\1{named}>", r.html)) == main_text(r.html) for r in pages)
    assert same == len(pages)


@pytest.mark.parametrize("part", ["<div>some text here ", "<p>x</p></b></i></q><div>", "<article>some text ", "<div class=ad>some text ", f"<div class=ad><h1>{LONG}</h1>", "<li>a<div>b", "<td>a<div>b<dd>"])
def test_deep_markup_takes_linear_time(part):
    def seconds(n):
        start = time.perf_counter()
        main_text(part * n)
        return time.perf_counter() - start

    seconds(100)
    few, many = seconds(5_000), seconds(50_000)
    assert many < 40 * few + 1
