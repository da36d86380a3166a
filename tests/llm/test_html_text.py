import re
import time
from collections import Counter

import pandas as pd
import pytest

from clickloom.llm import html_text

ARTICLE = "<h1>A &amp; B</h1><p>One   long\nparagraph, with <a href=x>a link</a> and <b>bold</b> words in it.<p>Short.</p>"
TEXT = "A & B\nOne long paragraph, with a link and bold words in it.\nShort."


@pytest.mark.parametrize("page", [
    f"<body><nav><a href=1>Home</a></nav><article>{ARTICLE}</article><footer>x &copy;</footer></body>",
    f"<div class='site-header'><a href=1>Home</a></div><div id=main>{ARTICLE}</div><div class=sidebar>s</div>",
    f"<body><form><article>{ARTICLE}<aside>no</aside><form>no</form></article></form>",
    f"<div class='cookieNotice'>We store things.</div><main>{ARTICLE}<section class=comments><p>I disagree.</p></section>",
    f"<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no --><article>{ARTICLE}<div class=ad>Buy</div>",
    f"<article class=post>{ARTICLE}<div id='comment-list'><article class=comment>No!</article></div></article>",
    f"<p hidden>no</p><div role=banner>no</div><article>{ARTICLE}</article><div style='display: none'>no</div>",
])
def test_the_article_alone_is_left(page):
    assert html_text.extract(page) == TEXT


def test_density_finds_the_core_without_any_hint():
    links = "".join(f"<li><a href={i}>Item number {i}</a></li>" for i in range(30))
    body = "".join(f"<p>Paragraph {i} tells a story of some length, with many words and few links.</p>" for i in range(8))
    page = f"<div><ul>{links}</ul></div><div><div>{body}</div></div><div><a href=1>About</a> <a href=2>Help</a></div>"
    text = html_text.extract(page)
    assert text.split("\n") == [
        f"Paragraph {i} tells a story of some length, with many words and few links." for i in range(8)
    ]


MENU = "<ul>" + "".join(f"<li><a href={i}>Item number {i}</a></li>" for i in range(20)) + "</ul>"
LONG = [f"{i} " + "word " * 79 + "end." for i in range(5)]
SHORT = [f"{i} " + "text " * 29 + "end." for i in range(3)]


@pytest.mark.parametrize(("page", "lines"), [
    (f"<body>{MENU}<div><div>{''.join(f'<p>{p}</p>' for p in LONG)}</div><div>{''.join(f'<p>{p}</p>' for p in SHORT)}</div></div>",
     [*LONG, *SHORT]),
    (f"<body><div><section>{''.join(f'<p>{p}</p>' for p in LONG)}</section><section>{''.join(f'<p>{p}</p>' for p in SHORT)}</section></div>",
     [*LONG, *SHORT]),
    (f"<body><h1>A heading of thirty letters</h1><div>{''.join(f'<p>{p}</p>' for p in LONG)}</div>",
     ["A heading of thirty letters", *LONG]),
    (f"<body>{MENU}<h1>A heading of thirty letters</h1><div>{''.join(f'<p>{p}</p>' for p in LONG)}</div>",
     ["A heading of thirty letters", *LONG]),
    (f"<body>{MENU}<div>Bare <b>text</b> here.<div>{''.join(f'<p>{p}</p>' for p in LONG)}</div><ul><li>one<li>two</ul></div>",
     ["Bare text here.", *LONG, "one", "two"]),
    (f"<body><a href=1>Home</a> | <a href=2>Help</a><h2><a href=3>Linked title</a></h2><div>{''.join(f'<p>{p}</p>' for p in LONG)}</div>{MENU}",
     ["Linked title", *LONG]),
])
def test_pages_without_semantic_tags_keep_all_their_text(page, lines):
    assert html_text.extract(page).split("\n") == lines


BODY = "".join(f"<p>{p}</p>" for p in LONG)


@pytest.mark.parametrize(("page", "lines"), [
    (f"<div class='post with-sidebar'><h2>Title</h2>{BODY}</div>", ["Title", *LONG]),
    (f"<h1>Title</h1><div class='sidebar-layout'>{BODY}</div>", ["Title", *LONG]),
    (f"<div class='comment-page'><h2>Title</h2>{BODY}</div>", ["Title", *LONG]),
    (f"<div><h2 class='section-header'>Part</h2>{BODY}</div>", ["Part", *LONG]),
    (f"<article>{BODY}<p>See <a class='related-link'>this</a> and <span class='search-term'>that</span> word."
     "<table class='alert-table'><tr><td>cell</table></article>", [*LONG, "See this and that word.", "cell"]),
    (f"<div>{BODY}</div><div class='related'>Read also</div><div class=sidebar>{MENU}</div>"
     f"<div class='comments'>{BODY[:900]}</div>", LONG),
])
def test_a_class_word_alone_takes_nothing_of_the_article(page, lines):
    assert html_text.extract(page).split("\n") == lines


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("plain text < 5 &amp; more", "plain text < 5 & more"), ("<p>a<p>b<br>c", "a\nb c"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<article><p>cut <b>off", "cut off"), ("<title>t</title><article>x</article>", "x"), ("<p>a&#233;&#x41;&nbsp;b", "aéA b"),
    ("<div>" * 5_000 + "deep", "deep"), ("<a title='x > y'>z</a>", "z"), ("<p>un<i>bro</i>ken", "unbroken"),
])
def test_small_pages(page, text):
    assert html_text.extract(page) == text


def test_table_with_nulls_and_clashing_columns(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "old"), (None, None, None, None), (1, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_text.extract_pages(pages).collect()) == ["", "", TEXT]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def _renamed(page):
    return re.sub(r"<(/?)(article|main|nav|header|footer|aside|section)\b", r"<\1div", page)


def _bare(page):
    return re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", _renamed(page))


@pytest.mark.parametrize("change", [_renamed, _bare])
def test_density_alone_finds_the_articles_of_the_table(change):
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    lost = extra = blocks = 0
    for page in pages:
        # The article as its tag gives it, read without any density.
        inner = html_text.parse(page)
        html_text._prune(inner, html_text._is_dropped)
        todo, truth = [inner], []
        while todo:
            node = todo.pop()
            if node.tag == "article":
                truth += html_text._blocks([node])
            else:
                todo.extend(node.children())
        want, got = Counter(truth), Counter(html_text.extract(change(page)).split("\n"))
        lost += sum((want - got).values())
        extra += sum((got - want).values())
        blocks += len(truth)
    assert blocks > 1_000
    assert lost <= 0.02 * blocks
    assert extra <= 0.05 * blocks


def test_density_decides_between_the_articles_of_a_page():
    one = "".join(f"<p>{p}</p>" for p in LONG)
    two = "".join(f"<p>{p}</p>" for p in SHORT)
    page = f"<body>{MENU}<article>{one}</article><article>{two}</article><article><a href=1>Read more</a></article>"
    assert html_text.extract(page).split("\n") == [*LONG, *SHORT]


@pytest.mark.parametrize("notice", [
    "<div>We use cookies to make this site better. OK?</div>",
    "<div>Sign up for our weekly letter: <input name=mail> <button>Go</button></div>",
    "<div><h3>Most read</h3><ul><li><a href=1>A story of some kind</a><li><a href=2>Another story</a></ul></div>",
])
@pytest.mark.parametrize("first", [True, False])
def test_unmarked_notices_beside_the_core_go(notice, first):
    core = f"<div><h1>Title</h1>{''.join(f'<p>{p}</p>' for p in LONG)}</div>"
    page = f"<body>{MENU}{notice if first else ''}{core}{'' if first else notice}</body>"
    assert html_text.extract(page).split("\n") == ["Title", *LONG]


@pytest.mark.parametrize("page", [
    "<span>" * 40_000 + "x</b>" * 40_000,
    "<a '" * 250_000,
    "<a '>\"" * 160_000 + "x",
    "<b><td>" + "<span>" * 40_000 + "x</b>" * 40_000,
    "<span>" * 40_000 + "<li>x" * 40_000,
    "<span>" * 40_000 + "<p>x</p>" * 40_000,
    "<form>" * 80_000 + "<h1>x</h1>",
    "<!" * 500_000,
    "<p>" + "x" * 1_000_000,
])
def test_a_hostile_page_of_one_megabyte_is_read_in_time(page):
    begin = time.process_time()
    html_text.extract(page)
    assert time.process_time() - begin < 2
