"""Main text of hosts whose pages are copies, outside article and main elements."""

from featureflow.llm import html_text
from featureflow.llm.common import Cuts

TOP = '<div class="top1"><a href="/">Home</a> <a href="/s">Shop of many things and more things than that</a></div>'


def texts(spark, bodies):
    rows = [(i, "http://site.example/", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    with Cuts(spark) as cuts:
        got = {r.page_id: r.text for r in html_text.extract(df, cuts).collect()}
    return [got[i] for i in range(len(rows))]


def test_copies_of_a_page_keep_their_text(spark):
    assert set(texts(spark, ["<div class=story><p>The same text.</p></div>"] * 30)) == {"The same text."}
    bodies = [f"<div class=story><p>Article {i % 8} about {i % 8 * 7}.</p></div>" for i in range(96)]
    assert texts(spark, bodies) == [f"Article {i % 8} about {i % 8 * 7}." for i in range(96)]


def test_copies_count_once_in_the_tree(spark):
    # eight different pages by 20 copies, and what the site repeats still goes
    bodies = [f"{TOP}<div class=story><p>Article {i % 8} about {i % 8 * 7}.</p></div><div class=end1>Kept</div>" for i in range(160)]
    assert texts(spark, bodies) == [f"Article {i % 8} about {i % 8 * 7}." for i in range(160)]


def test_a_text_on_pages_that_differ_elsewhere_stays(spark):
    for tag in ("div", "section", "td"):
        story = f"<{tag} class=story><h2>Title</h2><p>The same long text of the page, word for word.</p></{tag}>"
        story = f"<table><tr>{story}</tr></table>" if tag == "td" else story
        bodies = [f"<!-- {i} -->{TOP}{story}" for i in range(30)]
        assert set(texts(spark, bodies)) == {"Title\n\nThe same long text of the page, word for word."}
