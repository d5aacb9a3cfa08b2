"""Row-wise operators: token counts, language, licenses, page text, packing, mixing."""

import math
import re
import zlib

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import DOC_SCHEMA, WORD, awkward, awkward_rows, documents, lower_ascii
from pyspark.sql import functions as F

from featureflow.llm import bpe, html_text, langid, licenses, packing
from featureflow.llm.common import Cuts
from featureflow.llm.mixing import mix
from featureflow.llm.queries import queries

Q = queries()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ token counts

@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " ", "it's", "ΣΑΣ", "\x1c", "é", "é", "9a", "\n", "<|"])).map("".join))
def test_token_count_equals_the_library(text):
    from tokenizers import Tokenizer

    global _TOKENIZER
    if "_TOKENIZER" not in globals():
        _TOKENIZER = Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json"))
    path = bpe.vocabulary("word_bpe_49k.json")
    ids = ids_of(_TOKENIZER, text)
    assert bpe.load(path).count(text) == len(ids)
    assert packing.load(path).text(text) == np.asarray(ids, "<u4").tobytes()


@pytest.mark.parametrize("text", [":\U0003d000", "a\ua7cf Σ\U000191a0x", "1\U00011de0\U000323b0,", "a\u0558b", "\u1c89\ua7ce \U00010d50\U00016ea0"])
def test_letters_newer_than_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = bpe.vocabulary("word_bpe_49k.json")
    ids = ids_of(Tokenizer.from_file(path), text)
    assert bpe.load(path).count(text) == len(ids)
    assert packing.load(path).text(text) == np.asarray(ids, "<u4").tobytes()


def test_merges_pop_lowest_rank_then_leftmost():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("aa", "a"): 4, ("a", "a"): 3}
    assert bpe.merges_of(list("abc"), ranks) == 2  # bc first, then a+bc
    assert bpe.merges_of(list("aaaa"), ranks) == 2
    assert bpe.merges_of(["a"], ranks) == bpe.merges_of([], ranks) == 0


def test_recent_keeps_at_most_its_size():
    made = []
    seen = bpe.Recent(lambda t: made.append(t) or len(t), 10)
    for i in range(100):
        assert seen["hot"] == 3 and seen[f"w{i}"] == len(f"w{i}")
        assert len(seen) + len(seen.old) <= 10
    assert made.count("hot") == 1


def test_token_counts_of_tables(spark, tokenizer):
    got = {r.doc_id: r for r in Q["op3_token_counts"](spark, SF001).collect()}
    for i, t in documents(spark, SF001):
        n = len(ids_of(tokenizer, t))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 2048)
    rows = bpe.count_tokens(awkward(spark)).select("doc_id", "text", "n_tokens").collect()
    assert len(rows) == len(awkward_rows())
    assert all(r.n_tokens == len(ids_of(tokenizer, r.text)) for r in rows)
    assert bpe.count_tokens(awkward(spark).limit(0)).count() == 0


# ------------------------------------------------------------------ language

def test_windows_cover_every_byte():
    for n in (0, 1, 127, 128, 129, 1000):
        data = bytes(i % 251 + 1 for i in range(n))
        w = langid.windows(data)
        assert w.shape[1] == langid.LENGTH
        step = langid.LENGTH - langid.OVERLAP
        assert b"".join(bytes(r[:step]) for r in w[:-1]) + bytes(w[-1]).rstrip(b"\0") == data


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    m = langid.ByteCnn(["a", "b", "c"], seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = rng.integers(0, 256, (4, 40)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        _, conv = m.pooled(x)
        h = np.maximum(conv.max(axis=1) + m.p["bias"], 0)
        p = langid.softmax(h @ m.p["out"] + m.p["out_bias"])
        return -np.log(p[np.arange(4), y]).mean()

    for name, g in m.gradients(x, y).items():
        where = np.argwhere(np.abs(g) > 1e-4)
        for at in map(tuple, where[rng.permutation(len(where))[:4]]):
            keep = m.p[name][at]
            m.p[name][at] = keep + 1e-6
            up = loss()
            m.p[name][at] = keep - 1e-6
            down = loss()
            m.p[name][at] = keep
            assert math.isclose((up - down) / 2e-6, g[at], rel_tol=1e-3, abs_tol=1e-6), name


def test_language_of_held_out_documents(spark):
    got = Q["op1_language_id"](spark, SF001)
    truth = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95


def test_held_out_rows_and_labels_are_not_learnt(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.is_held_out("doc_id"), "zz").otherwise(F.col("lang")))
    a, b = langid.train(docs, epochs=1, steps=5), langid.train(changed, epochs=1, steps=5)
    assert a.labels == b.labels and all(np.array_equal(a.p[k], b.p[k]) for k in a.p)


def test_language_edge_rows(spark):
    model = langid.train(awkward(spark), epochs=1, steps=5)
    rows = langid.with_language(awkward(spark), model, score_out="score").collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        letters = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (r.score == 0) == (not letters)
    empty = awkward(spark).limit(0)
    none = langid.train(empty)
    assert none.labels == [] and langid.with_language(empty, none).count() == 0
    assert {r.lang_pred for r in langid.with_language(awkward(spark), none).collect()} == {"und"}


# ------------------------------------------------------------------ licenses

def licence_brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    hits = [(i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    places = [i for i, _ in hits]
    return (len(words), len(hits), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in hits})))


def test_license_places_and_labels(spark):
    texts = ["MIT License mit license mit", "Licensed under CC BY-NC 4.0. cc by!", "GNU general  public-license",
             "gnu general public", "apache apache license license", "bacK mit lıcense mit lİcense",
             " ".join(w for i, w in enumerate(licenses.NOTICES[0][1].split()) if i % 17),
             "of the software and the use of this software without any warranty " * 30]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.label_documents(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == licence_brute(t), t
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert got[1].labels == "cc-by,cc-by-nc" and got[6].labels == "mit" and 0.6 <= got[6].score < 1
    assert got[7].labels == "" and got[7].score == 0


def test_licenses_of_tables(spark):
    got = {r.doc_id: r for r in Q["op10_license_scan"](spark, SF001).collect()}
    for i, t in documents(spark, SF001):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == licence_brute(t)
    rows = licenses.label_documents(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert [(r.n_base, r.labels) for r in rows if r.doc_id == 9] == [(3, "gpl,mit")]
    assert licenses.label_documents(awkward(spark).limit(0)).count() == 0


def test_license_scan_has_no_python(spark):
    plan = Q["op10_license_scan"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapInArrow", plan) and "Cartesian" not in plan


# ------------------------------------------------------------------ page text

PAGE = ('<html><body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use</div>'
        '<article><h1>Ti&amp;tle&nbsp;x</h1><p>One <b>bo\n ld</b><br>two<script>if (a<b) {"</p>"}</script>'
        '<p>three &lt;3<ul><li>a<li>b</ul><aside>s</aside><section id="comments"><p>nice</p></section>tail</article>'
        '<form>f</form><footer>f</footer></body>')


def test_page_text():
    assert html_text.main_text(PAGE, set()) == "Ti&tle x\n\nOne bo ld two\n\nthree <3\n\na\n\nb\n\ntail"
    assert html_text.main_text(None, set()) == html_text.main_text("", set()) == ""
    assert html_text.main_text("plain &amp; text <!-- open", set()) == "plain & text"
    assert html_text.main_text("<div>" * 3000 + "deep", set()) == "deep"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "x", " ", "&amp", "&#", "<",
                                 "<!--", "-->", "<![CDATA[", "]]>", "<td>", "<tr>", "<table>", "<script>", "</script>", "<b", ">"])))
def test_any_markup_parses(parts):
    html_text.main_text("".join(parts), {"/p"})


def test_style_tree_cuts_what_a_site_repeats(spark):
    def page(i):
        return (f'<html><body><div class="top1"><span>Home</span><span>Shop</span></div><div class="story"><p>Story {i} tells '
                f'of thing number {i * 7}.</p><p>More about {i * 13}.</p></div><div class="end1">All rights kept</div></body></html>')
    rows = [(i, f"http://site.example/{i}", page(i)) for i in range(20)] + [(99, "http://other.example/x", page(99)), (100, None, page(100))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("mine")).withColumn("low", F.lit(1))
    with Cuts(spark) as cuts:
        got = {r.page_id: r.text for r in html_text.extract(df, cuts).collect()}
    assert all(got[i] == f"Story {i} tells of thing number {i * 7}.\n\nMore about {i * 13}." for i in range(20))
    assert got[99].startswith("HomeShop") and got[100].startswith("HomeShop")  # one page: nothing is known to repeat


def test_copied_articles_stay(spark):
    rows = [(i, "http://site.example/", "<body><article><p>The same text.</p></article></body>") for i in range(30)]
    with Cuts(spark) as cuts:
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        assert {r.text for r in html_text.extract(df, cuts).collect()} == {"The same text."}
        assert html_text.extract(df.limit(0), cuts).count() == 0


def test_pages_of_tables(spark):
    got = Q["op9_main_text"](spark, SF001).join(spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "html"), "page_id")
    for r in got.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        import html

        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x)))).strip()
                  for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# ------------------------------------------------------------------ packing

def check_packing(pieces, texts, tokenizer):
    """texts: (doc_id, text) with different ids."""
    ids = {i: np.asarray([*ids_of(tokenizer, t), 2], "<u4") for i, t in texts}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        whole = ids[p.doc_id]
        assert p.doc_tokens == len(whole) and p.length > 0
        assert zlib.crc32(whole[p.start:p.start + p.length].tobytes()) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, whole in ids.items():
        at = 0
        for start, n in sorted(by_doc[i]):
            assert start == at
            at += n
        assert at == len(whole)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert 0 < at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding == 0


def test_packing_of_tables(spark, tokenizer):
    check_packing(Q["op7_pack_sequences"](spark, SF001).collect(), documents(spark, SF001), tokenizer)
    texts = [(i, t) for i, t in {r[0]: r[1] for r in awkward_rows()}.items() if i is not None]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("x"))
    check_packing(packing.pack_texts(df).collect(), texts, tokenizer)
    assert packing.pack_texts(df.limit(0)).count() == 0
    twice = packing.pack_texts(awkward(spark)).filter("doc_id = 2").groupBy().agg(F.sum("length"), F.first("doc_tokens")).first()
    assert twice[0] == 2 * twice[1]


def test_fill_takes_the_largest_dot_product():
    demand = np.array([[1000, 1, 0], [3000, 1, 3000], [1096, 1, 1000], [2000, 1, 100]], float)
    chosen, left = packing.fill(demand, np.array([4096, 10, 4096]))
    assert chosen[0] == 1 and set(chosen) == {1, 2} and left.tolist() == [0, 8, 96]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 40)), max_size=60), st.booleans())
def test_all_limits_hold(items, cut):
    limits = packing.Limits(tokens=40, segments=3, loss=25)
    items = [(n, min(n, x, 25)) for n, x in items]
    p = packing.Packer(limits, cut)
    out = [x for k, (n, loss) in enumerate(items) for x in p.add((k, loss), bytes(4 * n), loss)] + list(p.pack())
    per: dict = {}
    for (k, loss), start, ids, sequence, offset in out:
        n = len(ids) // 4
        s = per.setdefault(sequence, [0, 0, 0])
        assert offset == s[0]
        s[0] += n
        s[1] += 1
        s[2] += max(0, min(loss, start + n) - start)
    assert all(a <= 40 and b <= 3 and c <= 25 for a, b, c in per.values())
    assert sum(len(x[2]) // 4 for x in out) == sum(n for n, _ in items)


def test_pack_examples_uncut(spark):
    rows = [(i, 1 + i * 37 % 900, (i * 37 % 900) // 2) for i in range(200)] + [(500, 0, 0), (501, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, n int, loss int")
    limits = packing.Limits(tokens=1024, segments=6, loss=512)
    got = packing.pack_examples(df, "conv_id", "n", "loss", limits).join(df.withColumnRenamed("conv_id", "id"), "id")
    assert got.count() == len(rows)
    sums = got.filter("tokens > 0").groupBy("sequence_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("c"), F.sum("loss").alias("l")).collect()
    assert all(r.t <= 1024 and r.c <= 6 and r.l <= 512 for r in sums)
    with pytest.raises(Exception, match="more than a sequence holds"):
        packing.pack_examples(spark.createDataFrame([(1, 2000, 0)], "conv_id long, n int, loss int"), "conv_id", "n", "loss", limits).collect()


# ------------------------------------------------------------------ mixing

def targets_brute(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in over})


def check_mix(rows, texts):
    sizes: dict = {}
    for _, t, s in texts:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = targets_brute(sizes) if sizes else {}
    by: dict = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.copies <= 3
        by[r.source] = by.get(r.source, 0) + r.copies * r.size
    largest = {s: max(len(WORD.findall(t or "")) for _, t, x in texts if x == s) for s in sizes}
    for s in sizes:
        assert abs(by[s] - want[s]) <= 3 * largest[s] + 1


def test_mix_of_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    with Cuts(spark) as cuts:
        rows = mix(docs, cuts).collect()
        check_mix(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
        again = mix(docs.repartition(7), cuts).collect()
        assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
        odd = awkward(spark)
        rows = mix(odd, cuts).collect()
        assert len(rows) == len(awkward_rows())
        check_mix(rows, [(r[0], r[1], r[3]) for r in awkward_rows()])
        assert mix(odd.limit(0), cuts).count() == 0
        blank = spark.createDataFrame([(1, None, "en", None, 0), (2, "", "en", "a", 0)], DOC_SCHEMA)
        assert {(r.target, r.copies) for r in mix(blank, cuts).collect()} == {(0.0, 0)}


def test_expected_copies_round_up_or_down(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "big" if i % 3 else "small", 0) for i in range(900)]
    with Cuts(spark) as cuts:
        got = mix(spark.createDataFrame(rows, DOC_SCHEMA), cuts).collect()
    for r in got:
        rate = r.target / r.source_size
        assert r.copies in (math.floor(rate), math.ceil(rate))
    for s in ("big", "small"):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.copies for r in mine) - len(mine) * mine[0].target / mine[0].source_size) <= 1
        assert abs(sum(r.copies * r.size for r in mine) / mine[0].target - 1) < 0.02
