"""Every label of a corpus is learnt, however many there are."""

from llm_fixtures import DOC_SCHEMA

from featureflow.llm import langid


def text(label, i):
    return " ".join(chr(0x4E00 + 40 * label + (i * 7 + j) % 5) * 3 for j in range(12))


def test_no_label_is_dropped(spark):
    n = 230  # the last ones are the rarest
    rows = [(label * 100 + i, text(label, i), f"l{label:03}", "a", 0) for label in range(n) for i in range(9 if label < 200 else 6)]
    model = langid.train(spark.createDataFrame(rows, DOC_SCHEMA), epochs=1, steps=5)
    assert model.labels == [f"l{label:03}" for label in range(n)]


def test_fewer_rows_a_label_still_tell_all_labels(spark):
    rows = [(label * 1000 + i, text(label, i), f"l{label:03}", "a", 0) for label in range(8) for i in range(60)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = langid.train(docs, max_rows=1, steps=200)
    got = langid.with_language(docs, model).filter(langid.is_held_out("doc_id")).collect()
    assert len(model.labels) == 8 and sum(r.lang == r.lang_pred for r in got) > 0.9 * len(got)
