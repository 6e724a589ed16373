import pytest

from filetrail.llm.extract import extract_text, main_text
from tests.llm.util import rows

BODY = "A paragraph with commas, with clauses, and quite enough text to look like an article. " * 2
CASES = {
    "": "",
    "plain text only": "plain text only",
    "<p>one<p>two &amp; &lt;three&gt; &eacute;&#233;&nbsp;end": "one\ntwo & <three> éé end",
    "<p>a <b>bold\n\t word</b> end</p>": "a bold word end",
    "<p title='a>b'>kept</p>": "kept",
    "<p>a<br>b<br><br>c</p>": "a b\nc",
    "<script>var a='</p>';</script><style>p{}</style><!-- no --><p>yes</p>": "yes",
    "<nav>only a menu</nav>": "",
    "<div class='comment'>only a comment</div>": "",
    "<p>never closed <i>at all": "never closed at all",
    "3 < 4 and 5 > 2": "3 < 4 and 5 > 2",
    "<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p>": "yes",
    "<a <b \"": "",
    "<!-- open": "",
    "<p>x</p><script>open": "x",
}


@pytest.mark.parametrize("html", CASES)
def test_small_pages(html):
    assert main_text(html) == CASES[html]


def page(article):
    return f"""<!DOCTYPE html><html><head><title>T</title></head><body class="no-sidebar">
    <header><h1>Site</h1><p>{BODY}</p></header><nav><ul><li><a href=/a>Menu a</a></li></ul></nav>
    <div id="cookie-notice"><p>{BODY}</p></div><div class="ad">Buy, buy, buy, {BODY}</div>
    <div id="page">{article}</div>
    <aside><p>{BODY}</p></aside><div class="sidebar-left"><p>{BODY}</p></div>
    <div class="comments"><article class="comment"><p>{BODY}</p></article></div>
    <form><p>{BODY}</p><input name=q></form><footer>&copy; Site</footer></body></html>"""


@pytest.mark.parametrize("article", [
    "<article><h1>Title</h1>{b}</article>",
    "<main><h1>Title</h1><div class=body>{b}</div></main>",
    "<div class=content><h1>Title</h1>{b}</div>",
])
def test_only_the_article_is_kept(article):
    body = f"<p>{BODY}<p>Short.<ul><li>item one<li>item two</ul><div class=share><a href=x>Share</a></div><blockquote>{BODY}</blockquote>"
    text = BODY.strip()
    assert main_text(page(article.format(b=body))) == f"Title\n{text}\nShort.\nitem one\nitem two\n{text}"


def test_link_lists_inside_the_article_go():
    links = "<ul>" + "<li><a href=x>Another story to read</a></li>" * 5 + "</ul>"
    assert main_text(page(f"<article><p>{BODY}</p>{links}<p>{BODY}</p></article>")) == "\n".join([BODY.strip()] * 2)


def test_broken_and_deep_pages_end():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<div>x" * 3_000).count("x") == 3_000
    assert main_text("<p>" + "<b>" * 5_000 + "x") == "x"
    assert main_text("<a href='" * 5_000) == ""
    assert main_text("<" * 50_000 + "x")


def test_operator(spark):
    pairs = [(1, "<p>é one</p>"), (1, "<p>é one</p>"), (2, None), (None, ""), (3, f"<article><p>{'word, ' * 50_000}</p></article>")]
    df = spark.createDataFrame(pairs, "page_id bigint, html string").selectExpr("*", "'u' as url", "'x' as text", "'x' as _parts")
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "_parts", "text", "n_chars"]
    assert rows(out, "page_id", "n_chars") == [(None, 0), (1, 5), (1, 5), (2, 0), (3, 299_999)]
    assert "html" in extract_text(df, keep_html=True).columns
    assert extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("wrapper", [
    "div class='page-with-sidebar'", "div class=content-ads-free", "div id=layout-sidebar", "body class=main-nav-open",
    "div class='main-nav-open'", "form method=post", "div class=sidebar", "form><div class=page-with-comments",
])
@pytest.mark.parametrize("stray", ["", "<p>A stray block that is not the article.</p>"])
def test_wrappers_of_the_whole_page_stay(wrapper, stray):
    parts = f"<p>{BODY}</p>" * 8
    menus = f"<nav>Menu</nav><div class=sidebar-left><p>{BODY}</p></div><div class=comments><p>{BODY}</p></div>"
    if wrapper == "div class=sidebar":
        menus = ""
    found = main_text(f"<html><body>{stray}<{wrapper}>{menus}<div>{parts}</div>")
    assert found.replace("A stray block that is not the article.\n", "") == "\n".join([BODY.strip()] * 8)


def test_long_comments_still_go():
    comments = f"<div class=comments>{f'<p>{BODY}</p>' * 6}</div>"
    assert main_text(f"<div id=page><p>{BODY}</p><p>{BODY}</p></div>{comments}") == "\n".join([BODY.strip()] * 2)


def test_short_articles_do_not_let_others_in():
    assert main_text(f"<div id=page><h1>Short one.</h1><p>Short one.</p></div><div class=sidebar><p>{BODY[:60]}</p></div>") == "Short one.\nShort one."


ARTICLE = "Article text, with a comma, that goes on for a while and then for a while longer. "
ARTICLE = f"<h1>Title</h1><p>{ARTICLE * 2}</p><p>{ARTICLE * 2}</p>"
ARTICLE_TEXT = "Title\n" + "\n".join(["Article text, with a comma, that goes on for a while and then for a while longer. " * 2] * 2)
ARTICLE_TEXT = "\n".join(x.strip() for x in ARTICLE_TEXT.split("\n"))


@pytest.mark.parametrize("name", [
    "comments", "comment-list", "reader-comments", "comments-area", "user-comments", "post-comments", "commentList",
    "sidebar-left", "cookie-bar", "ad-slot", "site-notice", "menu-main", "related-posts", "replies",
])
@pytest.mark.parametrize("n", [1, 10, 60])
def test_what_is_not_the_article_goes_whatever_its_size(name, n):
    one = f"<div class=content><p>{BODY}</p></div>" if n == 10 else f"<p>{BODY}</p>"
    other = f"<div class='{name}'>{one * n}</div>"
    for article in ("<article>{}</article>", "<main>{}</main>", "<div class=post>{}</div>", "<div>{}</div>", "{}",
                    "<form><article>{}</article></form>", "<div class='sidebar-layout'><div><main>{}</main></div></div>"):
        article = article.format(ARTICLE)
        for page in (article + other, other + article, f"<div class=wrap>{article}{other}</div>", f"<div id=page>{article}{other}</div>"):
            assert main_text(f"<html><body>{page}</body></html>") == ARTICLE_TEXT, page[:200]


def test_names_of_what_an_element_has():
    for name in ("page-with-comments", "content-ads-free", "no-sidebar", "has-cookie-notice", "layout-without-ads"):
        side = f"<div class=ads><p>{BODY}</p></div><div class=comments>{f'<p>{BODY}</p>' * 20}</div>"
        assert main_text(f"<div class='{name}'>{ARTICLE}{side}</div>") == ARTICLE_TEXT
