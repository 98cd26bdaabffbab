import html
import re
import time

import pytest

from riskloom.llm.html_text import extract, main_text

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="menu"><a href=x>Home</a> <a href=y>News</a></div><div id=main><div class=post><h1>Title here</h1>
<div class=section><p>First paragraph is quite long and says   something, &eacute;t &#233; more.<p>Second one is long too, and
<a href=y>has a link</a> in the middle of it.</div>
<div class=section><p>Third paragraph of the second section is similarly long and informative.</p></div><div class=share>Share this</div></div></div>
<div class="sidebar"><p>Some sidebar text that is long enough to look like a paragraph of text, really.</p></div>
<div class=cookie-notice>We use cookies</div><section id="comments"><p>Reader comment one which is rather long and chatty.</p></section>
<form>Name <input></form><footer>foot</footer><script>var t="</p>";</script></body></html>"""


def test_furniture_is_left_out():
    assert main_text(PAGE) == (
        "Title here First paragraph is quite long and says something, ét é more. Second one is long too, and has a link "
        "in the middle of it. Third paragraph of the second section is similarly long and informative."
    )


def test_article_with_comments_aside_and_unclosed_tags():
    page = "<nav>Menu</nav><article><h1>A</h1><p><b>One.<br><p>Two<aside>Aside</aside><div class='comments'><p>Said</div></article><footer>f"
    assert main_text(page) == "A One. Two"


@pytest.mark.parametrize(
    "page, text",
    [(None, ""), ("", ""), ("plain  text", "plain text"), ("<p>", ""), ("<div>x</div>", "x"), ("a &lt;b&gt; &amp;amp;", "a <b> &amp;"),
     ("<body><p>x</p><p hidden>y</p></body>", "x"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("x<!-- y --><br>z", "x z"),
     ("<script>alert(1)", ""), ("<p title='a>b'>q</p>", "q"), ("1 < 2", "1 < 2")],
)
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 30000 + "x", "<b>" * 30000 + "</i>" * 30000, "<p><b>a" * 20000, '<a "' * 30000, "<" * 50000, "<li>x" * 20000])
def test_odd_pages_take_linear_time(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20


def test_every_page_of_the_table_against_its_article(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for row in pages.collect():
        inner = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"<(/?p|/?h1|br)>", "\0", inner)).split("\0")
        want = " ".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert (got[row.page_id].text, got[row.page_id].n_chars, got[row.page_id].url) == (want, len(want), row.url)


def test_clashing_columns_nulls_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, kept_0 string"
    df = spark.createDataFrame([(1, None, "<p>x", "t", 9, "k"), (None, "u", None, "t", 9, "k"), (1, None, "<p>x", "t", 9, "k")], schema)
    rows = extract(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in rows) == [("1", "x", 1), ("1", "x", 1), ("None", "", 0)]
    assert extract(df.limit(0)).count() == 0


PROSE = "<p>The first paragraph says a good deal about files and who reads them.</p><p>A second one goes on about the same at length.</p>"
PROSE_TEXT = "The first paragraph says a good deal about files and who reads them. A second one goes on about the same at length."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "layout-with-sidebar", "sidebar", "widget social"])
def test_a_wrapper_named_like_furniture_keeps_its_text(name):
    assert main_text(f"<body><div class='{name}'>{PROSE}</div></body>") == PROSE_TEXT
    page = f"<body><div id='{name}'><div>{PROSE}</div><div class='sidebar'><a href=x>More</a> <a href=y>Old</a></div></div></body>"
    assert main_text(page) == PROSE_TEXT


def test_slugged_ids_in_an_article_are_kept_and_link_lists_are_not():
    page = (
        f"<body><article class='post has-comments'>{PROSE}<h2 id='how-to-share-files'>How to share files</h2>"
        "<section id='related-work'><p>Earlier work on this is long and has no links.</p></section><h2 id='login'>Login</h2>"
        "<p>Sign <span class='social-word'>here</span>.</p>"
        "<div class='related-posts'><a href=a>One post</a> <a href=b>And another post</a></div><div class='share-box'>Share this</div>"
        "</article></body>"
    )
    assert main_text(page) == PROSE_TEXT + " How to share files Earlier work on this is long and has no links. Login Sign here."
