"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from conftest import SF001
from llm_fixtures import awkward, documents

from featureflow.llm.periodic import collapse, extensions, grammar, numbered, text_runs, with_runs
from featureflow.llm.queries import queries


def brute(w, least=24, exponent=3):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, exponent * q):
                found.setdefault((i, n), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_texts(rnd):
    for _ in range(rnd.randint(1, 6)):
        n = rnd.choice([0, 1, 5, 23, 24, 30, 60, 150, 300])
        w = [b"%d" % rnd.randrange(rnd.choice([1, 2, 3, 5, 50])) for _ in range(n)]
        for _ in range(rnd.randint(0, 3)):
            if n > 10:
                s, p = rnd.randrange(n), rnd.choice([1, 2, 3, 5, 8, 13, rnd.randint(1, n)])
                for i in range(s + p, min(n, s + rnd.randint(1, n))):
                    w[i] = w[i - p]
        yield w


def test_runs_equal_the_scan():
    rnd = random.Random(7)
    for _ in range(300):
        texts = list(random_texts(rnd))
        for rule in ({}, {"least": 2}, {"least": 6, "exponent": 4}):
            assert text_runs(texts, **rule) == [brute(w, **rule) for w in texts]


def test_extensions_equal_word_by_word():
    rnd = random.Random(3)
    for _ in range(60):
        texts = [w for w in random_texts(rnd) if len(w) > 3] or [[b"a"] * 9]
        symbol, begin, size, marks = numbered(texts)
        levels, top = grammar(symbol, marks)
        x, y = [], []
        for b, n in zip(begin.tolist(), size.tolist(), strict=True):
            for _ in range(40):
                i, j = sorted(rnd.sample(range(n), 2))
                x.append(b + i)
                y.append(b + j)
        x, y = np.array(x), np.array(y)
        for step in (1, -1):
            got = extensions(levels, top, x, y, step)
            for i, j, n in zip(x.tolist(), y.tolist(), got.tolist(), strict=True):
                k = 0
                while symbol[i + k * step] == symbol[j + k * step]:
                    k += 1
                assert n == k


def test_long_texts():
    one = [b"a"] * 60_000
    assert text_runs([one, [b"a", b"b"] * 20_000]) == [[(0, 60_000, 1)], [(0, 40_000, 2)]]
    rnd = random.Random(5)
    part = [b"%d" % rnd.randrange(1000) for _ in range(9000)]
    assert text_runs([part * 3 + part[:10]]) == [[(0, 27_010, 9000)]]
    assert text_runs([part * 2 + part[:8999]]) == [[]]  # not three periods


def planted(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_against_the_scan(spark):
    got = {r.doc_id: r for r in queries()["op13_periodic_runs"](spark, SF001).collect()}
    docs = documents(spark, SF001)
    assert len(got) == len(docs)
    some = 0
    for i, text in docs:
        w = planted(i, text)
        runs = brute(w) if len(w) <= 3000 else text_runs([w])[0]
        r = got[i]
        best = min(runs, key=lambda x: (Fraction(-x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()
        some += bool(runs)
    assert some >= 10


def test_awkward_rows(spark):
    df = awkward(spark).selectExpr("*", "'x' AS runs", "'y' AS collapsed")
    got = with_runs(df).collect()
    assert len(got) == df.count()
    for r in got:
        w = (r.text or "").encode().split()
        runs = [tuple(x) for x in r.runs]
        assert runs == (brute(w) if len(w) < 2000 else text_runs([w])[0])
        assert r.collapsed == collapse(w, runs).decode()
    assert with_runs(df.limit(0)).collect() == []
