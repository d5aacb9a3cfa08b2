"""Benchmark decontamination against windows compared one by one. The query's
SQL is in test_llm_oracle."""

import re

import pytest
from llm_fixtures import awkward, lower_ascii

from featureflow.llm.common import Cuts
from featureflow.llm.decontaminate import remove_documents, remove_spans, with_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def brute(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for i, t in items:
        v = words(t)
        n = min(window, len(v))
        parts = {tuple(v[s:s + n]) for s in range(len(v) - n + 1)} if n else set()
        for s in range(len(w) - n + 1):
            if n and tuple(w[s:s + n]) in parts:
                hit |= set(range(s, s + n))
                if i is not None:
                    names.add(str(i))
    return len(w), len(hit), sorted(names), sorted(hit)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from all"), (2, "quick brown FOX jumps over the lazy dog and runs"),
    (10, "fox jumps"), (3, "mit license"), (4, ""), (5, None), (None, "any words here that nobody else has in a row at all ok"),
    (6, "the quick brown fox jumps over the lazy dog and runs far away"), (7, "ÉTÉ DÉJÀ vu"), (8, "été déjà vu"), (9, "tail"), (11, "Kİ"),
]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_awkward_rows(spark, broadcast_bytes):
    items = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id int, text string").repartition(3)
    more = spark.createDataFrame(
        [(50, "say any WORDS here that-nobody else has in a row at all, ok? yes", None, "a", 1),
         (51, "x " * 30_000 + "fox jumps " * 500, None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    df = awkward(spark).unionByName(more, allowMissingColumns=True).selectExpr("*", "'h' AS hits_", "1 AS n_hit", "2 AS window", "3 AS gram", "4 AS n")
    with Cuts(spark) as cuts:
        found = with_contamination(df, items, cuts, broadcast_bytes=broadcast_bytes)
        got = found.collect()
        cleaned = {(r.doc_id, r.n_words): r.text for r in remove_spans(found).collect()}
        clean = remove_documents(found).count()
    assert len(got) == df.count()
    for r in got:
        n, n_hit, names, hit = brute(r.text, ITEMS)
        assert (r.n_words, r.n_hit, r.hit_items) == (n, n_hit, names), r.doc_id
        assert [k for s in r.hit_spans for k in range(s.start, s.end)] == hit
        assert all(a.end < b.start for a, b in zip(r.hit_spans, r.hit_spans[1:]))
        assert (r.hits_, r.window) == ("h", 2)
        rest = [w for k, w in enumerate(words(r.text)) if k not in set(hit)]
        out = cleaned[(r.doc_id, r.n_words)]
        assert words(out) == rest if hit else out == r.text
    assert clean == sum(r.n_hit == 0 for r in got) and any(r.n_hit for r in got)


def test_empty_tables(spark):
    df = awkward(spark, extra=False)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    with Cuts(spark) as cuts:
        assert with_contamination(df.limit(0), items, cuts).collect() == []
        got = with_contamination(df, items.limit(0), cuts).collect()
    assert len(got) == df.count() and all(r.n_hit == 0 and r.hit_items == [] and r.hit_spans == [] for r in got)


def test_other_windows(spark):
    rows = [(i, f"a b c d e f{i % 3} g h") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([("q", "b c d e f1 g"), ("r", "g h"), ("s", "c d")], "item_id string, text string")
    for window in (1, 2, 3, 5, 7):
        with Cuts(spark) as cuts:
            for r in with_contamination(df, items, cuts, window=window).collect():
                n, n_hit, names, _ = brute(r.text, [("q", "b c d e f1 g"), ("r", "g h"), ("s", "c d")], window)
                assert (r.n_words, r.n_hit, r.hit_items) == (n, n_hit, names)


def test_main_path_is_native(spark):
    df, items = awkward(spark, extra=False), spark.createDataFrame(ITEMS, "item_id int, text string")
    with Cuts(spark) as cuts:
        plan = with_contamination(df, items, cuts)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan
