"""Stages of the pipeline on unlabelled tables, repeated ids and rows that differ in one column."""

import corpus_pipeline
from llm_fixtures import DOC_SCHEMA, cut_brute
from pyspark.sql import functions as F

from featureflow.llm import langid
from featureflow.llm.common import Cuts
from featureflow.llm.suffix_dedup import cut_repeats


def words(i, n, alphabet="abcdefgh"):
    return " ".join(alphabet[(i * 7 + j * 3 + j * j) % len(alphabet)] * (1 + (i + j) % 4) for j in range(n))


def test_unlabelled_documents_with_letters_stay(spark):
    rows = [(i, words(i, 20), None, "a", 5) for i in range(60)] + [(90, "12 34", None, "a", 5), (91, None, None, "a", 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()) == list(range(60))
    one = docs.withColumn("lang", F.lit("en"))
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, one, "").collect()) == list(range(60))


def test_the_network_decides(spark, monkeypatch):
    rows = [(i, words(i, 20, "abcd" if i % 2 else "wxyz"), "ad" if i % 2 else "wz", "a", 5) for i in range(80)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert corpus_pipeline.language_id(spark, docs, "").count() == 80

    def unsure(df, model, label_out, score_out):
        return df.withColumn(label_out, F.lit("ad")).withColumn(score_out, F.when(F.col("doc_id") < 10, 0.5).otherwise(0.9))

    monkeypatch.setattr(corpus_pipeline, "with_language", unsure)
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()) == list(range(10, 80))


def test_languages_of_one_id_are_learnt(spark):
    """Rows of one language under one id: drawn by their texts, each text once."""
    for shared in (7, 3, 11):  # none of them held out
        rows = [(shared, words(i, 30, "abcd"), "ad", "a", 0) for i in range(700)] + [(1000 + i, words(i, 30, "wxyz"), "wz", "a", 0) for i in range(700)]
        rows += [(shared, words(0, 30, "abcd"), "ad", "a", 0)] * 300
        docs = spark.createDataFrame(rows, DOC_SCHEMA).filter(~langid.is_held_out("doc_id"))
        if docs.filter(F.col("doc_id") == shared).isEmpty():
            continue
        model = langid.train(docs, per_label=50, epochs=2, steps=100)
        got = langid.with_language(docs, model).groupBy("lang", "lang_pred").count().collect()
        assert model.labels == ["ad", "wz"]
        assert sum(r["count"] for r in got if r.lang == r.lang_pred) > 0.95 * sum(r["count"] for r in got)


def test_which_repeated_row_stays_depends_on_its_columns(spark):
    text = words(3, 40)
    rows = [(1, text, "fr", "b", 2), (1, text, "en", "c", 3), (1, text, "en", "a", 9), (2, words(9, 50), "de", None, 1),
            (2, words(9, 50), "de", "z", 1)]
    for n in (1, 5):
        docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(n)
        got = sorted(tuple(r) for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect())
        assert got == [rows[2], rows[3]]
        mixed = {tuple(r) for r in corpus_pipeline.mix_sources(spark, docs, "").collect()}
        assert mixed <= {rows[2], rows[3]}


def test_a_passage_in_a_third_of_the_documents(spark):
    passage = words(5, 40, "klmnop")
    rows = [(i, words(i, 12 + i % 9) + (f" {passage} " if i % 3 == 0 else " ") + words(i + 1, 9, "stuvwx")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    want = {i: (n, gone, spans) for i, n, gone, spans, _ in cut_brute(rows)}
    with Cuts(spark) as cuts:
        for r in cut_repeats(docs, cuts).collect():
            assert (len(r.text.encode()), len(r.text.encode()) - len(r.kept), len(r.spans)) == want[r.doc_id]
