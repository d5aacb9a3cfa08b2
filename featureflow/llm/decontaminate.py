"""Benchmark decontamination, in DataFrame functions alone.

The windows of ``window`` consecutive words of all benchmark items, each
different one once, are a hash set that every executor gets. All windows of the
documents' words are looked up in it. The hash of a window is put together from
hashes of half as many words, so a word costs a few hash calls, and a window is
one number on its way to the lookup. Hits are then verified: the words at the
place have to be those of the item's window. Words inside a verified window are
hit; their spans, or their documents, can be removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import Cuts, spare_name

WINDOW = 10
#: A set of windows up to this size is broadcast; a larger one is joined by shuffling.
BROADCAST_BYTES = 64 << 20
#: Words of digits, letters and what isn't ASCII, and what stands between them.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def plain(word: Column) -> Column:
    """A-Z lower-cased and no other letter (``lower`` does just that to ASCII)."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def window_hashes(df: DataFrame, words_col: str, lengths: list[int]) -> DataFrame:
    """Replace an array of words by ``h<n>`` for each n of ``lengths``: the hash
    of the n words from each word on, null where fewer are left. Hashes of 1, 2,
    4, ... words are put together as the bits of n say. Each step is a projection
    of its own: the optimizer doesn't merge those that would repeat work."""
    keep = [c for c in df.columns if c != words_col]

    def put(df: DataFrame, a: int, b: int) -> DataFrame:  # a words and the b words after them
        if f"h{a + b}" in df.columns:
            return df
        later = F.slice(f"h{b}", F.lit(a + 1), F.greatest(F.size(f"h{b}") - a, F.lit(0)))
        # the shorter side is filled with nulls, which xxhash64 would pass over
        both = F.zip_with(f"h{a}", later, lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.xxhash64(x, y)))
        return df.withColumn(f"h{a + b}", both)

    df = df.select(*keep, F.transform(words_col, lambda w: F.xxhash64(plain(w))).alias("h1"))
    n = 1
    while 2 * n <= max(lengths):
        df = put(df, n, n)
        n *= 2
    for length in lengths:
        whole = 0
        for p in (1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1):
            df = put(df, whole, p) if whole else df
            whole += p
    return df.select(*keep, *[f"h{n}" for n in lengths])


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``window`` (its words, joined by a space), ``n`` and ``items`` (the ids that
    have it, as sorted strings, without null ids): the different windows of all
    items. An item of fewer words is one window; one without words has none."""
    w = items.select(F.col(id_col).cast("string").alias("item"),
                     F.transform(raw_words(F.col(text_col)), plain).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    w = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("part"))
    return w.groupBy(F.array_join("part", " ").alias("window"), F.size("part").alias("n")).agg(
        F.array_sort(F.collect_set("item")).alias("items"))


def find_hits(docs: DataFrame, items: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``id, text_key, hits`` for each text (under its id) that has a window's
    hash: an array of place, window, its words and items, not verified yet."""
    lookup = cuts.save(benchmark_windows(items, item_id_col, item_text_col, window))
    size = F.octet_length("window") + F.aggregate("items", F.lit(100), lambda n, i: n + 16 + F.octet_length(i))
    found = lookup.agg(F.sum(size), F.collect_set("n")).first()  # ``window`` lengths at most
    lengths = sorted(found[1]) or [window]
    grams = window_hashes(lookup.withColumn("w", F.split("window", " ")), "w", lengths)
    gram = F.coalesce(*[F.when(F.col("n") == n, F.get(f"h{n}", F.lit(0))) for n in lengths])
    grams = grams.select(gram.alias("gram"), "window", "n", "items")
    if (found[0] or 0) <= broadcast_bytes:
        grams = F.broadcast(grams)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), raw_words(F.col(text_col)).alias("w"))
    texts = window_hashes(texts, "w", lengths)
    # outer: else the optimizer filters on the array's size and makes it once more
    if len(lengths) == 1:
        rows = texts.select("id", "text_key", F.posexplode_outer(f"h{lengths[0]}").alias("pos", "gram"))
    else:
        rows = texts.select("id", "text_key", F.posexplode_outer(F.arrays_zip(*[f"h{n}" for n in lengths])).alias("pos", "z"))
        rows = rows.select("id", "text_key", "pos", F.explode(F.array(*[f"z.h{n}" for n in lengths])).alias("gram"))
    return rows.join(grams, "gram").groupBy("id", "text_key").agg(
        F.collect_set(F.struct("pos", "window", "n", "items")).alias("hits"))


def with_contamination(docs: DataFrame, items: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurring window),
    ``hit_spans`` (maximal stretches of hit words: array of start, end, words from
    0, end not included) and ``hit_items`` (sorted strings: items with occurring
    windows). One row per input row; other columns pass through, columns already
    called so are replaced.

    Null and empty texts, on either side, have no words; repeated rows get equal
    results; a null id is an id like others. A null item id has windows, which
    are hit, but is not named. Either table may be empty."""
    docs = docs.drop("n_words", "n_hit", "hit_spans", "hit_items")
    hits, key, i, w = (spare_name(docs, c) for c in ("hits_", "hit_key_", "hit_id_", "hit_words_"))
    found = find_hits(docs, items, cuts, id_col, text_col, item_id_col, item_text_col, window, broadcast_bytes)
    found = found.select(F.col("id").alias(i), F.col("text_key").alias(key), F.col("hits").alias(hits))
    df = docs.join(found, docs[id_col].eqNullSafe(found[i]) & (F.xxhash64(docs[text_col]) == found[key]), "left")
    mine = F.when(F.col(hits).isNotNull(), F.transform(raw_words(F.col(text_col)), plain))
    df = df.select(*docs.columns, hits, mine.alias(w))

    def stands(h: Column) -> Column:
        there = F.transform(F.sequence(F.lit(0), h["n"] - 1), lambda k: F.get(w, h["pos"] + k))
        return F.array_join(there, " ") == h["window"]

    # named twice, the words are made before the lambda function and not for each hit in it
    df = df.select(*docs.columns, F.when(F.size(w) > 0, F.filter(hits, stands)).alias(hits))
    hit = F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["n"] - 1)))
    df = df.select(*docs.columns, hits, F.coalesce(F.array_sort(F.array_distinct(hit)), F.array().cast("array<int>")).alias(w))
    # a hit word begins a span if the one before it isn't hit, and ends it if the next isn't
    before = F.concat(F.array(F.lit(-9)), F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))))
    after = F.concat(F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), F.array(F.lit(-9)))
    edge = F.filter(F.zip_with(w, before, lambda p, q: F.when(p - 1 != q, p)), lambda p: p.isNotNull())
    last = F.filter(F.zip_with(w, after, lambda p, q: F.when(p + 1 != q, p + 1)), lambda p: p.isNotNull())
    spans = F.zip_with(edge, last, lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end")))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["items"]))))
    return df.select(
        *docs.columns, F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.size(w).cast("long").alias("n_hit"), F.when(F.size(w) > 0, spans).otherwise(
            F.array().cast("array<struct<start:long,end:long>>")).alias("hit_spans"),
        F.coalesce(names, F.array().cast("array<string>")).alias("hit_items"))


def remove_documents(df: DataFrame) -> DataFrame:
    """The rows of ``with_contamination`` without a hit word."""
    return df.filter(F.col("n_hit") == 0)


def remove_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``with_contamination`` with their hit words, and what follows
    each up to the next word, taken out of the text. Texts without a hit word,
    null ones too, stay as they are."""
    text = F.col(text_col)
    gaps, breaks = F.split(text, WORD), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    units, cuts = spare_name(df, "units_"), spare_name(df, "cuts_")
    hit = F.col("n_hit") > 0
    # the first unit is what stands before the first word, the others are words and what follows them
    made = F.concat(F.slice(gaps, 1, 1), F.zip_with(breaks, F.slice(gaps, F.lit(2), F.size(gaps)), lambda a, b: F.concat(a, b)))
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform("hit_spans", lambda s: F.array(s["start"] + 1, s["end"] + 1))),
                     F.array(F.col("n_words") + 1))
    out = df.withColumn(units, F.when(hit, made)).withColumn(cuts, F.when(hit, edges))
    kept = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2, F.lit(2)), lambda k: F.array_join(F.slice(
        units, (F.get(cuts, k) + 1).cast("int"), (F.get(cuts, k + 1) - F.get(cuts, k)).cast("int")), ""))
    # the size names the units a second time, so that they aren't made for each gap in the lambda function
    return out.select(*[F.when(hit & (F.size(units) > 0), F.array_join(kept, "")).otherwise(text).alias(c) if c == text_col else c for c in df.columns])
