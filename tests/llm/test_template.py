"""Page scanner, landmarks, regions, and the template against vectors built by brute force."""

import random
import time
from collections import defaultdict

import pytest

from windrisk.llm import template


def text(page):
    return "\n".join(block for _, block in template.extract(page))


@pytest.mark.parametrize("page, expected", [
    ('<div class="story"><p>Main story body</p></div><div id="discussion"><article>reader says hi</article></div>', "Main story body"),
    ("<article>teaser</article><main><p>Main text</p></main>", "Main text"),
    ("<article>teaser</article><div><p>A story much longer than its teaser</p></div>", "teaser\nA story much longer than its teaser"),
    ("<main><div>by the way</div><article><p>The article of the page</p></article></main>", "The article of the page"),
    ('<article class="post has-comments"><h1>T</h1><p>Body text</p></article>', "T\nBody text"),
    ('<div class="layout no-sidebar">x y</div>', "x y"),
    ('<p class="share-price">9</p>', "9"),
    ('<body class="sidebar"><main id="menu">x</main></body>', "x"),
    ('<p>a</p><div class="cookie-notice">n</div><div class="siteFooter">f</div><div id="comments-list">c</div><div class="x ad-slot">b</div>', "a"),
    ('<div style="overflow: hidden" data-hidden>keep</div><div hidden>no</div><div aria-hidden=true>no</div>', "keep"),
    ("<p class=it's>Text one</p><p>we don't lose</p>", "Text one\nwe don't lose"),
    ('<p title="a > b">one</p><p title="open>two</p>', "one\ntwo"),
    ("1 < 2 <3 </ 4 <p>five", "1 < 2 <3 </ 4\nfive"),
    ("a<!-- <p>b</p>", "a"), ("a<!doctype html>b<?x?>c", "abc"), ("a <b no end", "a <b no end"),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", "a\nb\nc\nd"), ("<p>a<div>b</p>c</div>d", "a\nb\nc\nd"),
    ("<script>var a='<p>x</p>';</script>y<title>z", "y"), ("", ""), ("<>", "<>")])
def test_pages(page, expected):
    assert text(page) == expected


@pytest.mark.parametrize("page", [
    "<p" * 500_000, "<a " * 330_000, '<a x="> >"' * 100_000, '<a x="' * 170_000, "<a x='\">\"" * 100_000, "<div>" * 100_000 + "</x>" * 100_000,
    "<li><div>" + "<b>" * 500 + "<li></li>" * 50_000, "<!--" * 250_000, "</p   " * 150_000, "<b " + "= " * 400_000, "<title></title " * 60_000])
def test_hostile_pages_are_linear(page):
    start = time.time()
    template.extract(page)
    assert time.time() - start < 8


def test_deep_elements_keep_their_text():
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>") == "deep\nafter"


def test_long_page_is_kept_whole():
    words = [f"word{i}" for i in range(200_000)]
    page = "<article>" + "".join(f"<p>{' '.join(words[i:i + 100])}</p>" for i in range(0, len(words), 100)) + "</article>"
    assert text(page).split() == words


def test_scanner_loses_no_character():
    """Pieces of markup in random order: text runs, tags and what is between them add up to the page."""
    rng = random.Random(4)
    pieces = ["<p>", "</p>", "<p", "<", ">", "=", '"', "'", "<!--", "-->", "<a href='x'>", '<b c="d">', "t", " ", "<!", "/", "<script>", "</script>"]
    for _ in range(3000):
        page = "".join(rng.choices(pieces, k=rng.randint(0, 25)))
        at = 0
        for before, close, tag, rest, end in template._Scanner(page).parts():
            assert page.startswith(before, at)
            assert not tag or page[at + len(before):end].lower() == f"<{close}{tag}{rest.lower()}>"
            assert end >= at + len(before)
            at = end
        assert at == len(page)
        template.extract(page)


def test_templates_equal_vectors_by_brute_force(spark):
    """Occurrence vectors written out: classes, validity and nesting as in the module's text."""
    rng = random.Random(8)
    rows = []
    for host, n in (("a", 9), ("b", 4), ("c", 2)):
        for i in range(n):
            parts = ["<nav><ul><li>Home<li>News</ul></nav>", "<div class=frame><h2>Latest</h2><h3>Today</h3><p>%d</p></div>" % i]
            parts += ["<section id=s1><h4>Box</h4><i>in</i><u>it</u></section>"] * (rng.random() < 0.7)
            parts += ["<p>more</p>"] * rng.randint(0, 3)
            rows.append((len(rows), f"http://{host}/{i}", "".join(parts)))
        rows.append((len(rows), f"http://{host}/again", rows[-1][2]))
    got = {(r.host, r.token): (r["class"], r.inside, r.pages)
           for r in template.templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}

    expected = {}
    for host in "abc":
        pages = [dict((t, (parent, n)) for t, parent, n in template.page_tokens(page))
                 for page in sorted({h for _, u, h in rows if f"//{host}/" in u})]
        tokens = {t for page in pages for t in page}
        vector = {t: tuple(page.get(t, (0, 0))[1] for page in pages) for t in tokens}
        parent = {t: min(page[t][0] for page in pages if t in page) for t in tokens}
        on = {t: sum(map(bool, vector[t])) for t in tokens}
        classes = defaultdict(set)
        for t in tokens:
            if on[t] >= 3 and 2 * on[t] >= max(on.values()) and len(set(vector[t]) - {0}) == 1:
                classes[vector[t]].add(t)
        valid = {t: v for v, members in classes.items() if len(members) >= 3 for t in members}
        expected |= {(host, t): (v, valid.get(parent[t]), on[t]) for t, v in valid.items()
                     if parent[t] == 0 or (parent[t] in valid and on[parent[t]] >= on[t])}
    assert got.keys() == expected.keys() and any(h == "a" for h, _ in got) and not any(h == "c" for h, _ in got)
    assert all(got[k][2] == expected[k][2] for k in got)
    names = {}
    for (host, _), ours, theirs in ((k, got[k], expected[k]) for k in got):
        for a, b in zip(ours[:2], theirs[:2]):
            assert (a is None) == (b is None) and names.setdefault((host, a), b) == b
    assert len({(host, b) for (host, _), b in names.items()}) == len(names)  # different classes stay different
