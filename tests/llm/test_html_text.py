"""Main text of pages: template pages against their article, other layouts, broken markup."""

import html
import re

import pytest

from fanwrite.llm import html_text
from fanwrite.llm.catalog import op2_html_text
from fanwrite.llm.html_text import main_text

PARA = "This is a paragraph of the article that is long enough to be told from what surrounds it on the page."


def test_template_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op2_html_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("</?b>|<br>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "{}"])
def test_what_is_left_out(wrap):
    inside = f'<h1>Title &amp; more</h1><p>{PARA}</p><script>var x = "<p>no</p>";</script><div class="ad">Buy!</div><p>Short<br>line&nbsp;&lt;b&gt;.</p><form>Your name <input></form><p>End.</p>'
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        '<div id="cookie-notice">We use cookies to make this site work well for you, and for everyone else who reads it too.</div>'
        f'<div class="sidebar"><p>{PARA} Not.</p></div>{wrap.format(inside)}'
        f'<section class="comments"><h3>Comments</h3><article class="comment"><p>{PARA} I disagree!</p></article></section>'
        f"<aside>{PARA} Aside.</aside><footer>&copy; me</footer></body></html>"
    )
    assert main_text(page) == f"Title & more\n\n{PARA}\n\nShort line <b>.\n\nEnd."


def test_menus_without_a_mark_and_stray_lines_are_no_text():
    menu = "<ul>" + "".join(f'<li><a href="/{i}">A link to somewhere number {i}</a></li>' for i in range(9)) + "</ul>"
    assert main_text(f"<div>{menu}</div><div><p>{PARA}</p><p>{PARA}</p></div>{menu}") == f"{PARA}\n\n{PARA}"


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>hi", "hi"), ("plain a < b", "plain a < b"), ("<article><p>a</p><!-- x <p>y", "a"),
        ("<article><p>a <b>b</article>", "a b"), ("<article><script>x", ""), ("<article><p>a<div class=ad><div>x</div>y</div>b</article>", "a\n\nb"),
        ("<article><p title='>'>q</p></article>", "q"), ('<article><p title="x>q</p></article>', "q"), ("<article>&#233;&eacute;&#x65E5;&am", "éé日&am"[:3] + "&am"),
        ("<article><p class=ad>no<p>yes</article>", "yes"), ('<article class="has-sidebar"><p>yes</article>', "yes"),
    ],
)
def test_broken_and_small_pages(page, want):
    assert main_text(page) == want


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a</p>", "x"), (3, "u", "<p>word</p>" * 50_000, "x"), (3, "u", "<p>a</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(((r["page_id"], r["n_chars"]) for r in html_text.texts(pages).collect()), key=str)
    assert got == sorted([(1, 0), (2, 0), (None, 1), (3, 6 * 50_000 - 2), (3, 1)], key=str)
    assert html_text.texts(pages.limit(0)).count() == 0 and html_text.extract(pages).columns == ["page_id", "url", "html", "text"]


@pytest.mark.parametrize("name", ["content-with-sidebar", "site-content sidebar-right", "sidebar", "banner-wrapper"])
@pytest.mark.parametrize("body", [f"<article><h1>T</h1><p>{PARA}</p></article>", f"<main><h1>T</h1><p>{PARA}</p></main>", f"<h1>T</h1><p>{PARA}</p>"])
def test_a_wrapper_of_the_text_is_no_sidebar(name, body):
    side = '<div class="sidebar-left">Short links.</div><div id="ad-300x250">Buy!</div>'
    assert main_text(f'<body><div class="{name}">{side}{body}</div><div class="comments">No!</div></body>') == f"T\n\n{PARA}"


def test_a_mark_is_a_whole_name_and_no_heading():
    kept = '<h2 id="search-results">Results</h2><h2 class="related">Related</h2><h2 id="related-work">Work</h2><p class="notice-period">A month.</p>'
    left_out = '<div class="ad-box">Buy!</div><div class="AD">Buy!</div><div id="cookieNotice">Cookies.</div><div class="related"><article><p>Other.</p></article></div>'
    assert main_text(f"<article><p>{PARA}</p>{kept}{left_out}<p>End.</p></article>") == f"{PARA}\n\nResults\n\nRelated\n\nWork\n\nA month.\n\nEnd."


def test_text_resumes_after_a_gap_in_its_element():
    aside, link = "<aside>An aside.</aside>", '<p><a href="/x">A paragraph that is a link</a></p>'
    page = f'<div><div><h1>T</h1><p>{PARA}</p>{aside}<p>Short.</p>{link}{aside}<ul><li><a href="/y">Linked item</a></li></ul><p>End.</p></div>{aside}<div><p>Stray.</p></div></div>'
    assert main_text(page) == f"T\n\n{PARA}\n\nShort.\n\nA paragraph that is a link\n\nLinked item\n\nEnd."


@pytest.mark.parametrize("name", ["comment-body", "user-comments-list", "CommentList", "commentlist", "reader-responses", "replies", "disqus_thread"])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div><h1>T</h1>{}</div>"])
def test_comments_are_left_out_by_their_names(name, wrap):
    for key in ("class", "id"):
        page = wrap.format(f'<p>{PARA}</p><p>{PARA} More.</p><div {key}="{name}"><p>{PARA} I disagree!</p></div>')
        assert main_text(page).endswith(f"{PARA}\n\n{PARA} More.") and "disagree" not in main_text(page)


@pytest.mark.parametrize("name", ["cookie-banner-v2", "js-newsletter-signup", "ad-box2", "sharebuttons"])
def test_other_marks_in_compounds(name):
    assert main_text(f'<div><p>{PARA} {PARA}</p><div class="{name}"><p>{PARA} Not.</p></div><p>End.</p></div>') == f"{PARA} {PARA}\n\nEnd."


@pytest.mark.parametrize("name", ["commentary", "paddle", "article-body", "wristband", "headerless", "download", "shared-memory", "userland"])
def test_names_that_only_look_like_marks(name):
    assert main_text(f'<div><p>{PARA}</p><div class="{name}"><p>{PARA} Yes.</p></div></div>') == f"{PARA}\n\n{PARA} Yes."


def test_short_rows_before_the_surge_and_a_notice_after_the_text():
    table = "<table><tr><td>Name</td><td>Value</td></tr>" + "".join(f"<tr><td>Row {i}</td><td>{PARA}</td></tr>" for i in range(3)) + "</table>"
    want = "\n\n".join(["T", "Name", "Value", *(x for i in range(3) for x in (f"Row {i}", PARA))])
    assert main_text(f"<body><nav>Home</nav><div><h1>T</h1>{table}</div><footer>f</footer></body>") == want
    assert main_text(f"<body><nav>Home</nav><h1>T</h1>{table}</body>") == want
    assert main_text(f"<body><h1>T</h1><p>{PARA}</p><p>(c) Foo</p></body>") == f"T\n\n{PARA}"
    assert main_text(f"<article><h1>T</h1><p>{PARA}</p><p>(c) Foo</p></article>") == f"T\n\n{PARA}\n\n(c) Foo"


def scored(page):
    """Lines between surges and dives by plain block sums over a page of flat blocks."""
    gaps = r'(?s)<(head|nav|footer|script|style)\b.*?</\1>|<!--.*?-->|<div class="ad">.*?</div>'
    rows = []
    for piece in re.split("(\x00)", re.sub(gaps, "\x00", page)):
        lines = re.split(r"</?(?:p|h1|body|html)\b[^>]*>", piece.replace("<br>", " "))
        text = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in lines]
        rows += [""] * 3 if piece == "\x00" else [x for x in text if x]
    sums = [sum(map(len, rows[i : i + 3])) for i in range(len(rows))]
    out, run = [], []
    for i, row in enumerate([*rows, ""]):
        if i == len(rows) or sums[i] == 0:
            if run and max(sum(map(len, run[k : k + 3])) for k in range(len(run))) >= min(80, max(sums)):
                out += run
            run = []
        elif row:
            run.append(row)
    return "\n\n".join(out)


@pytest.mark.parametrize("tags", [("<div>", "</div>"), ('<section class="post">', "</section>"), ("", ""), ("<div><div>", "</div></div>")])
def test_template_pages_without_their_article_element(spark, tags):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    for page in pages:
        assert main_text(page.replace("<article>", tags[0]).replace("</article>", tags[1])) == main_text(page)


def test_plain_block_sums_choose_the_same_text(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    assert all(scored(page.replace("<article>", "").replace("</article>", "")) == main_text(page) for page in pages)
