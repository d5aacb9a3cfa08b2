"""Small tables with the awkward cases, and brute-force versions."""

from __future__ import annotations

import hashlib
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from all of them today"
    long = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
    return [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base + " again", "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \n\t", "de", None, 3), (7, long, "en", "c", 9),
        (None, "row without an id and with some words in it", "en", "a", 7), (8, "12 34 !!", "fr", "é", 8),
        (9, "mit license and MIT License; the gnu General public LICENSE", "en", "c", 2),
        (10, "x" * 3000, "en", "c", 2), (11, "été déjà vu à l'école où ça va très bien", "fr", "é", 2),
        (12, long[:90_000] + " tail", "en", "c", 9), (13, "a\u0000b Kİ <|endoftext|> it's", None, "", 4),
    ]


def awkward(spark, extra: bool = True):
    df = spark.createDataFrame(awkward_rows(), DOC_SCHEMA)
    if extra:  # names that operators use themselves
        for c in ("id", "fp", "size", "copies", "target", "place", "kept", "spans", "n_tokens", "lang_pred", "score",
                  "starts_", "counts_", "cell", "bucket", "label", "w", "pos", "rep", "root", "text_", "text_key", "i", "k"):
            df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def components(n: int, linked) -> list[int]:
    """Smallest index reachable, from pairs of indices."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def cut_brute(rows, length=50):
    """(id, text) -> (bytes, removed, spans, sha256 of the rest), strings judged on the input."""
    holders = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for s in range(len(b) - length + 1):
                w = b[s:s + length]
                holders[w] = min(holders.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if i is not None and holders[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
