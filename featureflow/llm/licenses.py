"""License scans by diagonal voting, in DataFrame functions alone.

The rolling word k-grams of all texts are joined to the places they have in the
templates (k = 2 for short phrases, 4 for notices). A run of text that follows a
template lies on one diagonal, text place minus template place, so the hits are
aggregated by diagonal. Words put in or left out shift a notice to a diagonal
nearby: neighbouring diagonals are merged. A span counts if enough of its
template's words are in it; a phrase has to stand there word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters that end a word: ASCII but for digits and lower-case letters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lower-cased.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DRIFT = 4
COVERED = 0.6
STRETCH = 1.5

# Phrases whose words make a label wherever they stand.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# More phrases, with labels of the method's own.
PHRASES = {
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "2 clause bsd license": "bsd",
    "3 clause bsd license": "bsd",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
}
# Public license notices, matched with gaps and small changes.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software and to permit persons to whom the software is furnished to do so"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license "
               "at http www apache org licenses license 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
            "was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy "
                  "modify publish use compile sell or distribute this software"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license to view a copy "
              "of this license visit"),
]


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased (null: none). ``lower`` is the ASCII
    rule here: other letters may change, but never into a template's word, as
    the one letter whose lower case is ASCII (the Kelvin sign) is put aside."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")))
    return F.array_remove(F.split(plain, BREAKS), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long")


def template_grams(spark, base: dict[str, str], phrases: dict[str, str], notices) -> DataFrame:
    """One row per k-gram of each template: a fixed list, some hundred rows."""
    rows = []
    for kind, items in (("base", base.items()), ("phrase", phrases.items()), ("notice", [(t, n) for n, t in notices])):
        k = 4 if kind == "notice" else 2
        for text, label in items:
            w = text.split(" ")
            for i in range(len(w) - k + 1):
                four = [*w[i:i + k], None, None][:4]
                rows.append((len(rows) - i, label, kind == "base", k == 2, len(w), i, *four))
    made = spark.createDataFrame(
        rows, "template int, label string, base boolean, exact boolean, length int, t_pos int, t1 string, t2 string, "
              "t3 string, t4 string")
    return made.withColumn("gram", F.xxhash64("t1", "t2"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None, notices=None, covered: float = COVERED) -> DataFrame:
    """The verified spans: ``id, text_key, template, label, base, first_word,
    last_word, coverage``, one row per span; ``last_word`` is its last word.

    ``text_key`` tells texts under one id apart; a text that is there twice
    under one id counts once. Null and empty texts have no spans; a null id is
    kept as an id. Other columns don't matter.
    """
    grams = template_grams(docs.sparkSession, BASE_PHRASES if base is None else base,
                           PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    w, n = F.col("w"), F.size("w")
    rolled = F.arrays_zip(w.alias("a"), F.slice(w, F.lit(2), n).alias("b"), F.slice(w, F.lit(3), n).alias("c"),
                          F.slice(w, F.lit(4), n).alias("d"))
    # outer: else the optimizer filters on the array's size and splits each text once more
    rows = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"),
                        words(F.col(text_col)).alias("w"))
            .select("id", "text_key", rolled.alias("rolled"))
            .select("id", "text_key", F.posexplode_outer("rolled").alias("pos", "g"))
            .select("id", "text_key", "pos", *[F.col(f"g.{c}").alias(f"w{i}") for i, c in enumerate("abcd", 1)]))
    # the hash joins, the words decide; a quarter-kilobyte list a template, so a broadcast
    hits = rows.withColumn("gram", F.xxhash64("w1", "w2")).join(F.broadcast(grams), "gram").filter(
        "w1 = t1 AND w2 = t2 AND (exact OR (w3 = t3 AND w4 = t4))")
    span = ["id", "text_key", "template", "label", "base", "exact", "length"]
    diagonals = hits.groupBy(*span, (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.collect_set("t_pos").alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    # neighbours merge into a notice while the diagonals and the text places go on closely
    order = Window.partitionBy("id", "text_key", "template").orderBy("diagonal")
    far = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT)
    diagonals = diagonals.withColumn("far", F.coalesce(far, F.lit(True)).cast("int"))
    diagonals = diagonals.withColumn("band", F.sum("far").over(order))
    bands = diagonals.groupBy(*span, "band").agg(
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.min("diagonal").alias("diagonal"))
    k = F.when(F.col("exact"), 2).otherwise(4)
    seen = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1)))))
    bands = bands.withColumn("coverage", seen / F.col("length")).withColumn("end", F.col("last") + k - 1)
    whole = F.col("exact") & (F.size("places") == F.col("length") - 1)
    like = ~F.col("exact") & (F.col("coverage") >= covered) & (
        F.col("end") - F.col("first") + 1 <= F.col("length") * STRETCH)
    return bands.filter(whole | like).select(
        "id", "text_key", "template", "label", "base", F.col("first").cast("long").alias("first_word"),
        F.col("end").cast("long").alias("last_word"), "coverage")


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``. Documents without a span have empty label
    strings, null places and score 0."""
    base = F.col("base")
    joined = F.when(base, F.col("label"))
    found = scan(docs, id_col, text_col).groupBy("id", "text_key").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(joined)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("coverage").alias("score"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), n_words(F.col(text_col)).alias("n_words"))
    none = F.lit("")
    return d.join(found, d.doc_id.eqNullSafe(found.id) & (d.key == found.text_key), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
