"""Main text of pages."""

from __future__ import annotations

from acctmart.llm.html_text import extract_pages, main_text

ARTICLE = "".join(f"<p>Paragraph {i}, with some words, and a comma or two, to make it long enough.</p>" for i in range(4))
TEXTS = [f"Paragraph {i}, with some words, and a comma or two, to make it long enough." for i in range(4)]


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_without_the_rest():
    links = "".join(f'<li><a href="/{i}">Link {i}, more</a></li>' for i in range(20))
    source = page(
        f"<nav><ul>{links}</ul></nav><div class='ad'>Buy, buy, buy, now, today, at once.</div>"
        f"<article><h1>A title</h1>{ARTICLE}<script>var p = '<p>no</p>';</script>"
        "<form><p>Your mail, please, here</p></form></article>"
        "<div id='comments'><p>First, I say, great, article, thanks, a lot, really.</p></div>"
        "<aside><p>See, also, this, and, that</p></aside><footer>&copy; all, rights</footer>"
    )
    assert main_text(source) == "\n\n".join(["A title", *TEXTS])


def test_plain_containers_and_siblings():
    source = page(f"<div><div class='menu'>x</div><div class='body'>{ARTICLE}</div><p>{'A last word, after all. ' * 5}</p></div>")
    assert main_text(source) == "\n\n".join([*TEXTS, ("A last word, after all. " * 5).strip()])


def test_references_white_space_and_unclosed_tags():
    source = page("<div><p>A &amp; B&nbsp;&lt;c&gt;\n\n  d<br>e<p><b>bold, text<p>third <i>it</i>em, &#233;&eacute;</div>")
    assert main_text(source) == "A & B <c> d e\n\nbold, text\n\nthird item, éé"


def test_nothing_and_odd_input():
    assert main_text(None) == "" and main_text("") == "" and main_text("<p></p><!-- a") == ""
    assert main_text("just text") == "just text"
    assert main_text(page("<script>only(1)</script>")) == ""
    assert main_text("<p title='it's>one, two</p><p>three, four</p>") != ""
    deep = "<div>" * 20_000 + "<p>deep, text</p>" + "</div>" * 20_000
    assert main_text(deep) == "deep, text"


def test_icons_lose_nothing_after_them():
    half = ARTICLE.index("<p>Paragraph 2")
    icons = ["<svg class='icon'/>", "<math/>", "<svg class='icon'>", "<svg><svg/><text>no</text></svg>"]
    icons += ["<svg><!-- <svg> --><script>'<svg>'</script><title>no</title></svg>", "<SVG><svg>no</svg>no</SVG>"]
    for icon in icons:
        for later in ("", "<p><svg><text>no</text></svg></p>", "<svg/>"):
            for body in (icon + f"<article>{ARTICLE}</article>", f"<article>{ARTICLE[:half]}{icon}{ARTICLE[half:]}</article>"):
                assert main_text(page(body + later)) == "\n\n".join(TEXTS), (icon, later)
    many = main_text(page("<svg>" * 20_000 + f"<article>{ARTICLE}</article>"))
    assert many == "\n\n".join(TEXTS)


def test_wrappers_with_marks_in_their_classes():
    text = "\n\n".join(TEXTS)
    aside = "<div class='widget'><p>Read, also, this, and, that, too.</p></div>"
    comments = "<div id='comments'>" + "<article class='comment'><p>I, too, say so, yes.</p></article>" * 3 + "</div>"
    for wrapper in ("container overflow-hidden", "layout with-sidebar", "no-sidebar", "navy-theme", "widget", "legal", "hidden"):
        for inside in (f"<article>{ARTICLE}</article>", f"<div>{ARTICLE}</div>"):
            for rest in ("", aside, comments):
                assert main_text(page(f"<div class='{wrapper}'>{inside}{rest}</div>")) == text, (wrapper, rest)
                assert main_text(page(f"<div id='{wrapper}'><div class='side'>{inside}</div></div>{rest}")) == text
    for mark in ("widget", "cookie-banner", "site-footer", "comments-area", "related_posts", "ad-1"):
        assert main_text(page(f"<div>{ARTICLE}<div class='x {mark}'><p>A, b, c, d, e, f.</p></div></div>")) == text, mark
    replies = "<p>Here, as ever, is what I think of it, at length, again.</p>" * 12
    assert main_text(page(f"<div>{ARTICLE}</div><div class='comments'>{replies}</div>")) == text
    assert main_text(page(f"<div class='discussion'>{ARTICLE}</div>")) == text


def test_rows(spark):
    rows = [(1, "u", page(ARTICLE), 5), (1, "u", page(ARTICLE), 5), (2, None, None, 5), (None, "v", "", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    found = sorted(map(tuple, extract_pages(pages).collect()), key=repr)
    text = "\n\n".join(TEXTS)
    assert found == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert extract_pages(pages.where("page_id > 5")).collect() == []
