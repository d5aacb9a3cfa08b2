"""Operators on pairs, and the pipeline: against brute force on small tables."""

import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import DOC_SCHEMA, WORD, awkward, awkward_rows, components, cut_brute, documents, lower_ascii
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from featureflow.llm import embed_dedup, kdtree, simhash, suffix_dedup
from featureflow.llm.common import Cuts, connected_components, global_rank, spread_blocks
from featureflow.llm.queries import queries

Q = queries()
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


@pytest.fixture()
def cuts(spark):
    with Cuts(spark) as c:
        yield c


# ------------------------------------------------------------------ shared helpers

def test_components_of_chains_stars_and_rings(spark, cuts):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 501), (501, 502), (502, 500)]
    edges += [(int(a), int(b)) for a, b in rng.integers(1000, 1080, (60, 2))]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), cuts).collect()}
    want = components(1100, edges)
    assert got == {n: want[n] for n in {x for e in edges if e[0] != e[1] for x in e}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), cuts).count() == 0


def test_every_two_members_of_a_bucket_meet_once(spark, cuts):
    rows = spark.createDataFrame([(0, i) for i in range(50)] + [(1, 7), (1, 9)], "bucket int, m long")
    met = spread_blocks(cuts, rows, ["bucket"], "m", 8).collect()
    cells = {}
    for r in met:
        cells.setdefault((r.bucket, r.cell_i, r.cell_j), []).append((r.m, r.own))
    seen: dict = {}
    for (b, i, j), members in cells.items():
        for m, own in members:
            for n, other in members:
                if m < n and (i == j or own != other):
                    seen[b, m, n] = seen.get((b, m, n), 0) + 1
    assert len(seen) == 50 * 49 // 2 + 1 and set(seen.values()) == {1}


def test_global_rank(spark, cuts):
    rows = spark.createDataFrame([(i * 7919 % 1009, None if i == 5 else str(i)) for i in range(1000)], "a int, b string")
    got = sorted((r.place, r.a) for r in global_rank(rows, [F.col("a")], "place", cuts).collect())
    assert [p for p, _ in got] == list(range(1000)) and [a for _, a in got] == sorted(a for _, a in got)


# ------------------------------------------------------------------ SimHash

def fingerprint_brute(text):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def check_simhash(rows, texts):
    """texts: (id, text) in the order of no consequence; rows: id, fp, component_id."""
    fps = [fingerprint_brute(t) for _, t in texts]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    comp = components(len(fps), near)
    low: dict = {}
    for (i, _), c in zip(texts, comp, strict=True):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    want = sorted(((-1 if i is None else i), f, low.get(c, -1)) for (i, _), f, c in zip(texts, fps, comp, strict=True))
    got = sorted(((-1 if r.id is None else r.id), r.fp % 2 ** 64, -1 if r.component_id is None else r.component_id) for r in rows)
    assert got == want


def test_simhash_of_tables(spark, cuts):
    check_simhash(simhash.near_duplicates(spark.read.parquet(f"{SF001}/documents.parquet"), cuts).collect(), documents(spark, SF001))
    check_simhash(simhash.near_duplicates(awkward(spark), cuts).collect(), [(r[0], r[1]) for r in awkward_rows()])
    assert simhash.near_duplicates(awkward(spark).limit(0), cuts).count() == 0
    one = Q["op5_simhash_near_dedup"](spark, SF001).first()
    assert len(one.fingerprint) == 16 and one.fingerprint == one.fingerprint.lower()


@pytest.mark.parametrize("bits", [2, 4, 7])
def test_grid_join_loses_no_link(spark, cuts, bits, monkeypatch):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2 ** 64, 30, dtype=np.uint64)
    fps = {int(x) for x in base}
    for x in base:
        for _ in range(12):
            y = int(x)
            for b in rng.choice(64, int(rng.integers(1, bits + 3)), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    links = {(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= bits}
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    for block in (simhash.BLOCK, 5):
        cells = simhash.grid_rows(spark.createDataFrame([(x,) for x in signed], "fp long"), bits)
        found = simhash.links_in_cells(spread_blocks(cuts, cuts.save(cells), ["cell"], "fp", block), bits).collect()
        at = {f: i for i, f in enumerate(fps)}
        want = components(len(fps), [(at[a], at[b]) for a, b in links])
        got = components(len(fps), [(at[r.a % 2 ** 64], at[r.b % 2 ** 64]) for r in found])
        assert got == want


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.integers(0, 2 ** 64 - 1))
def test_popcount_distance_is_a_lower_bound(a, b):
    p = simhash.popcounts(np.array([a, b], np.uint64))
    manhattan = sum(abs(int(p[0] >> np.uint64(2 * j)) % 4 - int(p[1] >> np.uint64(2 * j)) % 4) for j in range(32))
    assert manhattan <= (a ^ b).bit_count()


# ------------------------------------------------------------------ vectors

def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(8):
            x = centre + rng.normal(size=16) * rng.choice([0.01, 0.05, 0.1])
            rows.append((len(rows), [float(np.float32(v)) for v in x * rng.choice([1, 3])], int(c % 3)))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(70)]  # copies
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, rows[1][1], None),
             (n + 4, [], 0), (n + 5, [1.0, 2.0], 0), (n + 6, [2.0, 4.0], 0), (n + 7, [None] + [1.0] * 15, 1),
             (n + 8, [float("inf")] + [1.0] * 15, 1), (None, rows[2][1], 0), (n + 9, [-0.0] + [1.0] * 15, 1),
             (n + 10, [0.0] + [1.0] * 15, 1), (3, rows[3][1], rows[3][2])]
    return rows


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def check_near_vectors(got, rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    at = {i: k for k, i in enumerate(ids)}
    by = {r[0]: r for r in rows if r[0] is not None}
    links = []
    for i in ids:
        for j in ids[:at[i]]:
            (_, a, la), (_, b, lb) = by[i], by[j]
            if la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            a, b = np.array(a, float), np.array(b, float)
            if a.any() and b.any() and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links.append((at[i], at[j]))
    comp = components(len(ids), links)
    n = np.bincount(np.array(links, int).ravel(), minlength=len(ids)) if links else np.zeros(len(ids), int)
    assert len(got) == len(rows)
    for r in got:
        if r.id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[at[r.id]], ids[comp[at[r.id]]], ids[comp[at[r.id]]] == r.id)


def test_near_vectors(spark, cuts, monkeypatch):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumn("rep", F.lit(1)).withColumn("links", F.lit(1)).withColumn("id", F.lit("x"))
    check_near_vectors(embed_dedup.near_vectors(df, cuts).collect(), rows)
    monkeypatch.setattr(embed_dedup, "BLOCK", 3)  # every bucket is a hot one
    check_near_vectors(embed_dedup.near_vectors(df, cuts).collect(), rows)
    assert embed_dedup.near_vectors(df.limit(0), cuts).count() == 0


def test_near_vectors_of_tables(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = Q["op4_embedding_near_dedup"](spark, SF001).withColumnRenamed("vec_id", "id").collect()
    check_near_vectors(got, rows)


# ------------------------------------------------------------------ top k

def top_brute(rows, asked, k=5):
    by = {}
    for i, v in rows:
        if i is not None and usable(v):
            by[i] = min(by.get(i, v), v)
    out = []
    for q in sorted({i for i in asked if i in by}):
        x = [math.floor(256 * c) for c in by[q]]
        cut = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
        scores = sorted(((-cut(sum(a * math.floor(256 * b) for a, b in zip(x, v, strict=True))), i) for i, v in by.items()
                         if i != q and len(v) == len(x)))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k_with_awkward_vectors(spark, cuts):
    rows = [(i, v) for i, v, _ in vector_rows()] + [(700, [3e25] * 16), (701, [-3e25] * 16), (702, [7.0] * 16)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("rank", F.lit(1)).withColumn("score", F.lit("s"))
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    asked = [i for i, _ in rows if i is not None and (i % 10 == 0 or i > 160)]
    for shard in (4096, 16):
        got = kdtree.top_k(df, df.filter((F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 160)), cuts, shard_rows=shard)
        assert sorted(tuple(r) for r in got.collect()) == top_brute(rows, asked)
    assert kdtree.top_k(df.limit(0), df, cuts).count() == kdtree.top_k(df, df.limit(0), cuts).count() == 0
    few = spark.createDataFrame([(50, [1.0], 0), (51, [1.0], 0)], VECTORS)
    assert [tuple(r) for r in kdtree.top_k(few, few.filter("vec_id = 50"), cuts).collect()] == [(50, 1, 51, 65536)]


def test_top_k_of_tables(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in Q["op6_exact_top_k"](spark, SF001).collect())
    assert got == top_brute(rows, [i for i, _ in rows if i % 50 == 0])


def test_tree_boxes_and_bounds():
    rng = np.random.default_rng(0)
    x = rng.integers(-40, 40, (500, 6)).astype(float)
    tree = kdtree.Tree(x, np.arange(500), leaf=16)
    q = rng.integers(-40, 40, (5, 6)).astype(float)
    bounds = tree.bounds(q)
    for n, (a, b) in enumerate(tree.span):
        if not tree.child[n]:
            assert b - a <= 16
            assert (tree.x[a:b] >= tree.low[n]).all() and (tree.x[a:b] <= tree.high[n]).all()
            assert ((q @ tree.x[a:b].T).max(axis=1) <= bounds[:, n]).all()


# ------------------------------------------------------------------ repeated passages

@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=3, max_size=30).map(lambda b: bytes(c % 3 for c in b)), st.integers(0, 9)), min_size=1, max_size=25))
def test_merged_transforms_find_the_smallest_holder(strings):
    first: dict = {}
    for s, h in strings:
        for i in range(len(s) - 2):
            first[s[i:i + 3]] = min(first.get(s[i:i + 3], h), h)
    got = suffix_dedup.smallest_holders([s for s, _ in strings], np.array([h for _, h in strings]), 3)
    assert [g.tolist() for g in got] == [[first[s[i:i + 3]] for i in range(len(s) - 2)] for s, _ in strings]


def test_transform_is_the_suffix_order():
    strings = [b"banana", b"ananas", b"", b"bandana\xff\x00", b"a" * 40]
    order, before, longer = suffix_dedup.shard_transform(strings)
    suffixes = [(list(s[i:]), k) for k, s in enumerate(strings) for i in range(len(s) + 1)]
    want = sorted(range(len(suffixes)), key=lambda n: ([c + 1 for c in suffixes[n][0]] + [0], suffixes[n][1]))
    assert order.tolist() == want
    text = [c for s in strings for c in [*[x + 1 for x in s], 0]]
    assert before.tolist() == [text[p - 1] if p else 0 for p in order.tolist()]
    assert sorted(longer.tolist()) == list(range(len(order)))


@pytest.mark.parametrize("letters", [2, 256])
@pytest.mark.parametrize("length", [1, 2, 5, 12])
def test_merge_carries_only_starts_of_strings(monkeypatch, letters, length):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 50)  # many shards
    rng = np.random.default_rng(letters + length)
    texts = [bytes(rng.integers(0, letters, int(rng.integers(length, 40)), dtype=np.uint8)) for _ in range(60)]
    texts += [texts[3][2:] + texts[4], texts[5], bytes([255]) * 40]
    shards = [suffix_dedup.shard_transform(texts[i:i + 21]) for i in range(0, 63, 21)]
    place = np.concatenate([s[0] + sum(len(x[0]) for x in shards[:i]) for i, s in enumerate(shards)])
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    tails = [b + i for b, t in zip(begin, texts) for i in range(length, len(t) + 1)]
    order, block = suffix_dedup.merge_transforms(shards, np.flatnonzero(np.isin(place, tails)), length)
    at = place[order]
    number = np.searchsorted(begin, at, side="right") - 1
    got = [(int(b), texts[k][p - begin[k]:p - begin[k] + length]) for b, k, p in zip(block, number, at)]
    assert all(len(x) == length for _, x in got) and len({b for b, _ in got}) == len({x for _, x in got}) == len(set(got))
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    seen = Counter(x for _, x in got)
    assert all(seen[x] == n for x, n in count.items() if n > 1)  # all of a repeated string's starts; others may be left out
    assert sum(seen.values()) <= len(tails) < len(place)
    holder = rng.permutation(len(texts))
    low = {x: min(int(h) for t, h in zip(texts, holder) if x in t) for x in count}
    want = [[low[t[i:i + length]] for i in range(len(t) - length + 1)] for t in texts]
    assert [g.tolist() for g in suffix_dedup.smallest_holders(texts, holder, length)] == want


def test_long_shards_sort_alike(monkeypatch):
    rng = np.random.default_rng(3)
    key, at = rng.integers(0, 50, 1000), rng.permutation(1000)
    assert [x.tolist() for x in suffix_dedup.by_key(key, at, 10)] == [x.tolist() for x in suffix_dedup.by_key(key, at, 22)]


def passages():
    rng = np.random.default_rng(9)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words, n))
    shared = [text(30) for _ in range(4)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join([text(int(rng.integers(0, 20))), shared[int(rng.integers(4))], text(5), shared[0][:int(rng.integers(40, 60))]])))
    rows += [(100, rows[3][1]), (101, rows[3][1] + " é" * 30), (102, "é" * 80), (103, "ü" + "é" * 80 + "z"), (104, "a" * 500), (105, "a" * 49),
             (106, "a" * 50), (107, "b" * 30 + "a" * 70), (108, None), (109, ""), (-5, "late but smallest " * 9), (110, "late but smallest " * 9)]
    return rows


def check_cut(df, rows, cuts):
    got = suffix_dedup.cut_repeats(df, cuts).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("gone"),
        F.size("spans").alias("k"), F.sha2("kept", 256).alias("sha")).collect()
    key = lambda t: (t[0] is not None, t[0] or 0, t[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(cut_brute(rows), key=key)


@pytest.mark.parametrize("key_pieces", [2048, 2])
def test_repeats_against_brute_force(spark, cuts, monkeypatch, key_pieces):
    monkeypatch.setattr(suffix_dedup, "KEY_PIECES", key_pieces)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("starts_", F.lit(1))
    check_cut(df.repartition(5), rows, cuts)


def test_repeats_in_awkward_tables(spark, cuts):
    check_cut(awkward(spark), [(r[0], r[1]) for r in awkward_rows()], cuts)
    assert suffix_dedup.cut_repeats(awkward(spark).limit(0), cuts).count() == 0


def test_pieces_share_more_than_a_short_gram(spark):
    """Texts of the same 24-byte words in any order: many 16-byte grams stand in other texts, few 50-byte strings do."""
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 23)) + " " for _ in range(400)]
    rows = [(i, "".join(words[j] for j in rng.permutation(400)[:30])) for i in range(60)]
    rows += [(100, rows[7][1][100:300]), (101, "x" * 30 + rows[9][1][200:260])]
    d = spark.createDataFrame([(i, 0, t.encode()) for i, t in rows], "id long, text_key long, data binary")
    bloom = suffix_dedup.shared_keys(d, 50, sum(len(t) for _, t in rows))
    bloom = spark.sparkContext.broadcast(getattr(bloom, "bloom", bloom))
    pieces = suffix_dedup.piece_rows(d, bloom, 50, True).collect()
    firsts = {}
    for i, t in rows:
        for a in range(len(t) - 49):
            firsts.setdefault(t[a:a + 50].encode(), set()).add(i)
    shared = {s for s, ids in firsts.items() if len(ids) > 1}
    held = [{bytes(r.piece[a:a + 50]) for a in range(len(r.piece) - 49)} for r in pieces]
    assert shared <= set().union(*held)  # none is left out
    assert len(held) < 100  # of 1700 in all


def test_repeats_in_ranges_and_parts(spark, cuts, monkeypatch):
    """Keys go through range by range and part by part: no part has many of the pieces, all together give the same."""
    seen, first_holders = [], suffix_dedup.first_holders

    def spy(pieces, *rest):
        seen.append(pieces.count())
        return first_holders(pieces, *rest)

    monkeypatch.setattr(suffix_dedup, "first_holders", spy)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_cut(df, rows, cuts)
    monkeypatch.setattr(suffix_dedup, "LEAST_PART", 1, raising=False)
    monkeypatch.setattr(suffix_dedup, "FILTER_TEXT", 10_000, raising=False)
    check_cut(df, rows, cuts)
    assert len(seen) > 4 and 0.9 * seen[0] < sum(seen[1:]) < 1.1 * seen[0] and max(seen[1:]) < seen[0] / 2


def test_repeats_of_tables(spark):
    got = sorted(tuple(r) for r in Q["op8_suffix_dedup"](spark, SF001).collect())
    assert got == sorted(cut_brute(documents(spark, SF001)))


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages_against_brute_force(spark, cuts):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([r for r in awkward_rows()], DOC_SCHEMA).withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = docs.unionByName(odd).withColumn("kept_", F.lit(1)).withColumn("i", F.lit(2))
    before = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(cuts.save(stage(spark, frames[-1], SF001)))
    lang, unique, cut, mixed, packed = ([tuple(r) for r in f.collect()] for f in frames[1:])
    for f in frames[1:5]:
        assert f.columns == corpus_pipeline.COLUMNS
    # 1: texts with a letter stay, others go
    has = lambda t: bool(t) and any(c.isalpha() for c in t)
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r[:2])
    assert sorted(lang, key=key) == sorted((r for r in before if has(r[1])), key=key)
    # 2: one document of each group
    fps = [fingerprint_brute(r[1]) for r in lang]
    comp = components(len(lang), [(i, j) for i in range(len(lang)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    groups: dict = {}
    for r, c in zip(lang, comp, strict=True):
        groups.setdefault(c, []).append(r)
    want = set()
    for rows in groups.values():
        named = [r for r in rows if r[0] is not None]
        low = min((r[0] for r in named), default=None)
        want |= {r for r in rows if r[0] == low}
    assert sorted(unique, key=key) == sorted(want, key=key)
    # 3: repeated strings go
    sizes = {(i, n, gone) for i, n, gone, *_ in cut_brute([(r[0], r[1]) for r in unique])}
    after = {r[0]: r for r in cut}
    assert len(cut) == len(unique)
    for i, n, gone in sizes:
        if i is not None:
            left = len(after[i][1].encode())
            assert n - gone - 6 * bool(gone) - gone // 10 <= left <= n - gone and after[i][4] == len(after[i][1])
    # 4: whole copies, at most three of each
    counts: dict = {}
    for r in mixed:
        counts[r] = counts.get(r, 0) + 1
    assert set(counts) <= set(cut) and max(counts.values()) <= 3
    # 5: every copy's ids, each once
    tokens = sum(p[2] for p in packed)
    from featureflow.llm import bpe

    tokenizer = bpe.load(bpe.vocabulary("word_bpe_49k.json"))
    assert tokens == sum(tokenizer.count(r[1]) + 1 for r in mixed)


def test_pipeline_runs_and_takes_empty_tables(spark, cuts):
    from featureflow.llm.queries import queries as q

    assert "pipeline" in corpus_pipeline.queries() and corpus_pipeline.ORACLE_SQL is None and len(q()) == 13
    empty = spark.createDataFrame([], DOC_SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        out = cuts.save(stage(spark, empty, SF001))
        assert out.count() == 0
