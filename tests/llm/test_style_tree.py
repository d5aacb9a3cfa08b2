"""Names, links and few pages in the style tree, against what a reader would keep."""

import math

import pytest

from featureflow.llm import html_text
from featureflow.llm.common import Cuts

STORY = "<p>" + "A long story of many things and more. " * 20 + "</p>"
TEXT = ("A long story of many things and more. " * 20).strip()


@pytest.mark.parametrize("page", [
    '<div class="widget-container">%s</div>', '<div class="site no-sidebar"><nav><a>m</a></nav>%s</div>',
    '<div class="has-sidebar content">%s</div><div class="sidebar">aside</div>', '<div id="search-results">%s</div>',
    '<div class="post-related story">%s</div>', '<div class="notice-board">%s</div>', "<form><div>%s</div><input></form>",
    '<article><div class="widget-text">%s</div></article>', '<div class="single comments-open">%s</div>'])
def test_a_name_does_not_remove_the_article(page):
    assert html_text.main_text(f"<html><body>{page % STORY}</body></html>", set()) == TEXT


@pytest.mark.parametrize("kind", ["ad", "comments", "sidebar", "cookie notice"])
def test_a_long_branch_with_a_name_does_not_replace_the_article(kind):
    assert html_text.main_text(f'<body><article>Short one.</article><div class="{kind}">{STORY}</div></body>', set()) == "Short one."


def test_comments_longer_than_the_text_go():
    assert html_text.main_text(f'<body><p>Short one.</p><div class="comments">{STORY}</div></body>', set()) == "Short one."


def test_articles_compete():
    assert html_text.main_text(f"<body><article>Teaser</article><div class=story>{STORY}</div></body>", set()) == f"Teaser\n\n{TEXT}"
    assert html_text.main_text(f"<body><article>{STORY}</article><div class=story>Teaser</div></body>", set()) == TEXT


def test_long_classes_and_slashes_make_paths_of_their_own():
    a, b = "x" * 90 + " a", "x" * 90 + " b"
    assert html_text.path_name("div", a) != html_text.path_name("div", b)
    assert "/" not in html_text.path_name("div", "w-1/2")


def page(i: int) -> str:
    links = "".join(f'<li><a href="/{i}/{j}">Word{i * 31 + j}</a></li>' for j in range(6))
    return (f'<html><body><div class="q1"><ul>{links}</ul></div><div class="q2"><h1>Story {i}</h1><p>It tells of thing {i * 7}.</p>'
            f'<p>More about <a href="/x">number {i * 13}</a>.</p></div><div class="q3">Kept by us</div></body></html>')


@pytest.mark.parametrize("pages", [12, 40])
def test_neutral_names_lose_furniture_through_the_tree(spark, pages):
    rows = [(i, f"http://h.example/{i}", page(i), 1, 2) for i in range(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, site_host_ int, low_paths_ int")
    with Cuts(spark) as cuts:
        got = html_text.extract(df, cuts).collect()
    assert {r.page_id: r.text for r in got} == {
        i: f"Story {i}\n\nIt tells of thing {i * 7}.\n\nMore about number {i * 13}." for i in range(pages)}
    assert {(r.site_host_, r.low_paths_) for r in got} == {(1, 2)}


def test_importance_by_brute_force(spark):
    pages = [page(i) for i in range(6)] + [page(0).replace("q3", "q4")]
    parsed = [html_text.Page(p) for p in pages]
    want = {}
    for path in {p for x in parsed for p in x.styles}:
        have = [x for x in parsed if path in x.styles]
        m = len(have)
        if m < 2:
            want[path] = 1.0
            continue
        looks, texts, chars, plain = {}, {}, 0, 0
        for x in have:
            for children in {" ".join(n.children) for n in x.styles[path]}:
                looks[children] = looks.get(children, 0) + 1
            for leaf, t in {(n.path, t) for n, t in x.blocks if (n.path + "/").startswith(path + "/")}:
                texts[leaf, t] = texts.get((leaf, t), 0) + 1
            for (n, t), c in zip(x.blocks, x.unlinked, strict=True):
                if (n.path + "/").startswith(path + "/"):
                    chars, plain = chars + len(t), plain + c
        s = sum(looks.values())
        look = -sum(n / s * math.log(n / s, max(m, 2)) for n in looks.values())
        say = 1 - sum(math.log(n, max(m, 2)) for n in texts.values()) / len(texts) if texts else 0.0
        found = 0.5 * look + 0.5 * say * (plain / chars if chars else 1.0)
        want[path] = (found * m + html_text.PRIOR_PAGES) / (m + html_text.PRIOR_PAGES)
    df = spark.createDataFrame([("h", p, None) for p in pages], "host string, html string, copies long")
    got = {r.path: r.importance for r in html_text.importance(html_text.site_counts(df)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-3 for p in want), [(p, got[p], want[p]) for p in want if abs(got[p] - want[p]) >= 1e-3]


def test_text_at_the_top_of_a_page():
    from featureflow.llm import html_text

    assert html_text.main_text("--><p>x", {"/p"}) is not None
    way, at = html_text.text_branch([((n, t), len(t)) for n, t in html_text.Page("<body><div class=story><p>one two</p><p>three four</p></div></body>").blocks])
    assert way[at].endswith("/div.story")
