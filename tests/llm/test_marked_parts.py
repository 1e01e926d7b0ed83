"""Parts of an article whose ids or classes hold a word of what usually isn't one, and forms around pages."""

import pytest

from mapledger.llm import html_density

from .test_texts import ARTICLE, LONG, PARTS, page

LINKS = "".join(f"<li><a href=/{i}>Another title number {i}</a>" for i in range(9))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (page(f"<article>{PARTS}<section id='discussion'><h2>Discussion</h2><p>Said.</p></section></article>"), ARTICLE + "\nDiscussion\nSaid."),
        (page(f"<article>{PARTS}<section id='related-work'><p>Others did it.</p></section></article>"), ARTICLE + "\nOthers did it."),
        (page(f"<article><h2 id='search-algorithms'>Search</h2>{PARTS}<h2 id=notice-of-appeal>N</h2></article>"), f"Search\n{ARTICLE}\nN"),
        (page(f"<article>{PARTS}<p class='ad-hoc'>So it went.</p></article>"), ARTICLE + "\nSo it went."),
        (page(f"<article>{PARTS}<section id='related-posts'><ul>{LINKS}</ul></section></article>"), ARTICLE),
        (page(f"<article>{PARTS}<section id='reader-comments'>{LONG}</section><p class='ad'>Buy.</p></article>"), ARTICLE),
        (page(f"<form id=f><nav>n</nav><article>{PARTS}</article><input></form>"), ARTICLE),
        (page(f"<form id=f><div><div>{PARTS}</div></div><button>b</button></form>"), ARTICLE),
        (page("<section id='search-algorithms'><p>Only this.</p></section>"), "Only this."),
    ],
)
def test_marked(html, text):
    assert html_density.main_text(html) == text


SLUGS = "content-sidebar entry-content_share-enabled post-with-comments article-header-body two-column-nav search-results widget-content layout-sidebar-right"


@pytest.mark.parametrize("slug", SLUGS.split())
def test_article_in_a_marked_element(slug):
    held = slug.replace("_", " ")
    around = "<nav>n</nav><div class='ad'>Buy it now.</div>{}<div class='site-footer'>All rights.</div>"
    assert html_density.main_text(page(around.format(f"<div class='{held}'>{PARTS}</div>"))) == ARTICLE
    assert html_density.main_text(page(around.format(f"<article><div class='{held}'>{PARTS}</div></article>"))) == ARTICLE
    inner = f"<div class='{held}'><div id='main-column-nav'>{PARTS}</div><div class='share-box'>Share it.</div></div>"
    assert html_density.main_text(page(around.format(inner))) == ARTICLE


@pytest.mark.parametrize("slug", ["site-sidebar", "cookie-bar", "user-comments", "related-posts", "newsletter-box", "share-buttons"])
def test_marked_element_beside_an_article(slug):
    assert html_density.main_text(page(f"<div><div>{PARTS}</div></div><div class='{slug}'><p>Some words of it.</p></div>")) == ARTICLE
    assert html_density.main_text(page(f"<article>{PARTS}<div class='{slug}'>Some words of it.</div></article>")) == ARTICLE


def test_long_comments_stay_out():
    comments = f"<div class='user-comments'>{LONG}{LONG}{LONG}</div>"
    assert html_density.main_text(page(f"<div><div>{PARTS}</div></div>{comments}")) == ARTICLE


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article>{}<math><mi>x</mi><mo>=</mo><mn>2</mn></math></article>", "{}\nx=2"),
        ("<article>{}<fieldset><legend>Note</legend><p>Kept.</p></fieldset></article>", "{}\nNote\nKept."),
        ("<article>{}<fieldset><label>Name <input></label></fieldset></article>", "{}"),
        ("<article>{}<label for=x>Name</label><input id=x></article>", "{}"),
        ("<article><header><div><h1>Title</h1></div><p>By me</p></header>{}</article>", "Title\n{}"),
        ("<article><header><nav><h2>Menu</h2></nav><h1>Title</h1></header>{}</article>", "Title\n{}"),
        ("<header><h1>Site</h1></header><article>{}</article>", "{}"),
    ],
)
def test_elements_of_an_article(html, text):
    assert html_density.main_text(page(html.format(PARTS))) == text.format(ARTICLE)


def test_deep_nesting_is_linear():
    deep = "<div class='a-sidebar'>" * 50_000 + PARTS + "</div>" * 50_000
    assert html_density.main_text(page(deep)) == ARTICLE
