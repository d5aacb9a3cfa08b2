"""Near-dedup of the pipeline decides per row, also where ids repeat or are null."""

import corpus_pipeline
from llm_fixtures import DOC_SCHEMA


def test_rows_of_one_id_are_judged_apart(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from all of them today"
    unique = [" ".join(f"w{i}x{j * 7 + i}" for j in range(30)) for i in range(6)]
    rows = [(1, base, "en", "a", 5), (None, base, "en", "a", 5), (5, base, "en", "b", 5),
            *[(None, t, "en", "a", 5) for t in unique[:3]], (5, unique[3], "en", "b", 5), (5, unique[4], "en", "b", 5),
            (None, unique[5], "en", "a", 5), (None, unique[5], "en", "a", 5), (None, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()]
    want = [(1, base), *[(None, t) for t in unique[:3]], (5, unique[3]), (5, unique[4]), (None, unique[5]), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)
