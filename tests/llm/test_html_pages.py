"""Main text on pages with the class lists that real sites write, by hand and apart from the labelled table."""

import re
import time

import pytest

from utterlake.llm import html_text

TREE = html_text.grow_tree(*html_text.labelled_blocks())
P = (
    "<p>The river rose in the night and by the morning the lower fields were under water for the third time this year.</p>"
    "<p>Farmers moved their cattle to the hill and waited for the rain to stop, which it did on Friday.</p>"
)
TEXT = "\n".join(re.findall("<p>(.*?)</p>", P))
NOISE = "<p>I was there and it was not like that at all, my friend, it came later.</p>"


@pytest.mark.parametrize("page", [
    '<div class="post type-post category-social tag-form">%s</div>', '<div class="post-content category-notice">%s</div>', '<main><div class="search-result-article">%s</div></main>',
    '<div class="article promo-free">%s</div>', '<div class="layout sidebar-right">%s</div>', '<article><div id="menu-planning">%s</div></article>',
    '<article><section id="comments-on-the-law">%s</section></article>', '<article><div class="section header-image-on">%s</div></article>', '<article><section id="header-files">%s</section></article>',
    '<div class="content-sidebar-wrap"><main class="content">%s</main></div>', '<body class="sidebar-right page-template">%s</body>', '<div id="root"><div class="css-1x2y">%s</div></div>',
    '<div class="has-sidebar">%s</div>', '<div class="l-sidebar-left site"><div class="post-body entry-content">%s</div></div>', '<article class="post tag-newsletter category-comments-and-replies">%s</article>',
    '<article data-x="hidden" title="the hidden word; display:none">%s</article>', '<article><div aria-hidden="false">%s</div></article>',
])
def test_ordinary_pages_come_whole(page):
    assert html_text.main_text(page % P, TREE) == TEXT


@pytest.mark.parametrize("page", [
    '<article>%s<ol class="commentlist"><li>%s</li></ol></article>', '<article>%s</article><div class="usercomments">%s</div>', '<article>%s<h2>Reader comments</h2><div>%s</div></article>',
    "<main>%s<h3>3 Comments</h3>%s</main>", '<article>%s<section class="comments"><article class="comment">%s</article></section></article>', "<article>%s<div hidden>%s</div></article>",
    '<article>%s<div style="display: none">%s</div></article>', "<article>%s<span hidden>%s</span></article>", '<article>%s<![CDATA[ x > y ]]><div id="disqus_thread">%s</div></article>',
    "<article>%s</article><aside>%s</aside>", '<div class="post">%s</div><div class="widget widget_text">%s</div>', '<article>%s<div class="ad">%s</div></article>',
    '<article>%s<div class="cookie-notice">%s</div></article>', '<div class="content">%s</div><div id="siteFooter">%s</div>', '<article>%s</article><div class="related-posts">%s</div>',
    '<article>%s<div class="newsletter-signup-box">%s</div></article>', '<article>%s</article><div class="comments-area"><h2>2 thoughts on the river</h2><div class="comment-content">%s</div></div>',
    "<article>%s<div style='visibility:hidden'>%s</article>",
])
def test_what_stands_beside_the_article_goes(page):
    assert html_text.main_text(page % (P, NOISE), TREE) == TEXT


def test_comments_end_at_the_next_heading():
    page = f"<main><h1>A</h1>{P}<h2>Comments</h2>{NOISE}<h3>by Ann</h3>{NOISE}<h2>Sources</h2>{P}</main>"
    assert html_text.main_text(page, TREE) == f"A\n{TEXT}\nSources\n{TEXT}"


def test_unclosed_cdata_hides_nothing_more():
    assert html_text.main_text(f"<article><![CDATA[ x >{P}</article>", TREE) == TEXT


@pytest.mark.parametrize("name,kind", [
    ("sidebar", "side"), ("sidebarLeft", "side"), ("main-menu", "menu"), ("site-footer", "edge"), ("commentlist", "comments"), ("article-comments", "comments"), ("post-content", "main"), ("related-posts", "side"),
    ("category-social", None), ("tag-form", None), ("menu-planning", None), ("post-with-sidebar", None), ("has-header", None), ("commentary", None), ("homepage", None), ("address", None), ("header-files", None),
])
def test_kind_of_name(name, kind):
    assert html_text.kind_of_name(name) == (list(html_text.KINDS).index(kind) if kind else html_text.OTHER)


@pytest.mark.parametrize("part", ['<div class=ad>', "<span hidden>", "<![CDATA[", '<div style="', "<article>", "<h2>Comments</h2>", '<div class="commentlist">a', "<p hidden>"])
def test_linear_time(part):
    took = []
    for n in (20_000, 80_000):
        began = time.time()
        html_text.main_text(part * n, TREE)
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 0.5
