"""No part of an article is lost by where it lies."""

import pytest

from pageloom.llm import html_extract


def para(n, word="Words"):
    return (f"{word}, and more of them, here. " * 60)[: n - 1].rstrip() + "."


@pytest.mark.parametrize(
    "around",
    [
        "<div id=story><div class=part>{long}</div><div class=part>{short}</div></div>",
        "<main><article>{long}</article><article>{short}</article></main>",
        "<div><ul>{items}</ul>{short}</div>",
        "<div><blockquote>{long}</blockquote>{short}</div>",
        "<div><table><tr><td>{long}</table>{short}</div>",
    ],
)
def test_all_parts_stay(around):
    longs, shorts = [para(600, f"Long{k}") for k in range(4)], [para(150, f"Short{k}") for k in range(3)]
    body = around.format(long="".join(f"<p>{x}</p>" for x in longs), short="".join(f"<p>{x}</p>" for x in shorts), items="".join(f"<li>{x}</li>" for x in longs))
    assert html_extract.extract(f"<html><body><nav>Home</nav>{body}<footer>End</footer></body></html>").split("\n") == longs + shorts


@pytest.mark.parametrize("name", ["overflow-hidden", "wrapper has-sidebar", "sidebar-right", "hidden lg:block", "page with-nav", "modal"])
def test_no_word_drops_the_article(name):
    text = "\n".join(para(300, f"Part{k}") for k in range(3))
    body = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    for inner in (f"<article>{body}</article>", f"<main>{body}</main>", f"<div>{body}</div>"):
        for attribute in ("class", "id"):
            page = f'<body><div class="site-nav">Home, news.</div><div {attribute}="{name}">{inner}</div><div class="sidebar"><p>Side text, short.</p></div><div id="comments"><article>A comment, short.</article></div></body>'
            assert html_extract.extract(page) == text, (name, inner[:9])


def test_a_layout_word_drops_no_part():
    first, second = para(600, "First"), para(200, "Second")
    assert html_extract.extract(f'<body><div><div><p>{first}</p></div><div class="overflow-hidden has-sidebar"><p>{second}</p></div></div></body>') == first + "\n" + second


def test_pages_of_links_only():
    assert html_extract.extract("<body><div><a href=x>Title</a></div></body>") == "Title"
    lists = "".join(f"<ul><li><a href=a>One {k}</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>" for k in range(2))
    want = "One 0\nTwo\nThree\nOne 1\nTwo\nThree"
    for page in (f"<body>{lists}</body>", f"<body><nav><a href=n>Home</a></nav><article><div>{lists}</div></article></body>", lists):
        assert html_extract.extract(page) == want


@pytest.mark.parametrize("name", ["article-comments", "post-comments", "main-nav", "footer-content", "related-content", "sponsored-content", "entry-footer", "content-sidebar"])
def test_parts_of_an_article_that_are_none_of_it(name):
    text = "\n".join(para(300, f"Part{k}") for k in range(3))
    body = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    for inner in ("<p>A reader says, with some words, that it is good.</p>", f"<p>{para(900, 'Foreign')}</p><p>{para(900, 'More')}</p>"):
        assert html_extract.extract(f'<body><article>{body}<div class="{name}">{inner}</div></article></body>') == text, name


@pytest.mark.parametrize("name", ["share", "related", "notice", "side", "comment-policy", "advertising-history", "cookie-recipes"])
def test_a_word_alone_makes_no_page_empty(name):
    text = "\n".join(para(300, f"Part{k}") for k in range(3))
    body = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    assert html_extract.extract(f'<body><nav><a href=x>Home</a></nav><div class="{name}">{body}</div><footer>End</footer></body>') == text


def test_hidden_and_deep_elements():
    text = para(400)
    assert html_extract.extract(f'<body><article><p>{text}</p><div hidden class="x"><p>{para(300, "Hidden")}</p></div></article></body>') == text
    deep = "<div>" * 520 + "<nav><p>Menu, of many words, here.</p></nav>" + f"<p>{text}</p>" + "<div class=comments><div><p>A comment, short.</p></div></div>" + "</div>" * 520
    assert html_extract.extract(f"<body>{deep}</body>") == text


def test_blocks_of_links_in_an_article():
    text = "\n".join(para(300, f"Part{k}") for k in range(3))
    body = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    links = "".join(f"<div><a href=x>Another page {k}</a></div>" for k in range(4))
    assert html_extract.extract(f"<body><article>{body}<div>See also: {links}</div></article></body>") == text
