"""The corpus pipeline: five stages over ``documents``, each a table of its own.

1. ``language_id``: documents in none of the languages learnt go.
2. ``simhash_near_dedup``: of each near-duplicate group the smallest id stays.
3. ``suffix_dedup``: passages that an earlier document has are cut out.
4. ``mix_sources``: documents are taken as often as their source's target asks.
5. ``pack_sequences``: the pieces of all documents in training sequences.

All stages but the last return the columns of ``documents``. A stage's rows are
written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm.common import Cuts, table
from featureflow.llm.langid import UNKNOWN, train, with_language
from featureflow.llm.mixing import mix
from featureflow.llm.packing import pack_texts
from featureflow.llm.simhash import near_duplicates
from featureflow.llm.suffix_dedup import cut_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: A text stays if its best language is this many times as likely as a guess.
LIFT = 1.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: null, empty and letterless texts go, and those for
    which no language is ``LIFT`` times as likely as a guess among those learnt.
    With one language or none to learn there is no such choice: texts with a
    letter stay."""
    docs = docs.select(*COLUMNS)
    model = train(docs)
    if len(model.labels) < 2:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    labelled = with_language(docs, model, label_out="lang_pred_", score_out="lang_score_")
    return labelled.filter((F.col("lang_pred_") != UNKNOWN) & (F.col("lang_score_") >= LIFT / len(model.labels))).select(*COLUMNS)


def one_of_each(rows: DataFrame, also: str | None = None) -> DataFrame:
    """Of rows equal in id and text the one whose other columns come first
    (nulls before all); a column named ``also`` is equal in them."""
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")] + ([also] if also else [])
    first = rows.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("first_"))
    return first.select("doc_id", "text", "first_.*").select(*COLUMNS, *([also] if also else []))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with each group's smallest id. A row that is there twice
    under its id stays once; a row with a null id goes if a document with an id
    is like it. Rows are told apart by id and text, as ids may repeat. Decisions
    are made on ids and hashes; texts move once, in one sort-merge join at any
    size, as what goes grows with the documents."""
    docs = docs.select(*COLUMNS)
    with Cuts(spark) as cuts:
        found = near_duplicates(docs, cuts, shingle=4, max_bits=4, text_key=True)
        found = cuts.save(found.groupBy(F.col("id").alias("i"), F.col("text_key").alias("k")).agg(
            F.min("component_id").alias("c"), F.count(F.lit(1)).alias("rows")))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("k"))
    gone = found.filter(~F.col("i").eqNullSafe(F.col("c"))).select("i", "k")
    kept = docs.join(gone.hint("merge"), same, "left_anti")
    again = found.filter("rows > 1 AND i <=> c").select("i", "k")
    if again.isEmpty():
        return kept
    return kept.join(again.hint("merge"), same, "left_anti").unionByName(
        one_of_each(kept.join(again.hint("merge"), same, "left_semi")))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 50-byte strings. Where a cut goes
    through a character, the rest of that character goes too; a text that all
    goes stays as ''."""
    with Cuts(spark) as cuts:
        found = cut_repeats(docs.select(*COLUMNS), cuts, kept_col="kept_", spans_col="spans_", as_text=True)
    text = F.when(F.size("spans_") == 0, F.col("text")).otherwise(F.col("kept_"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Equal rows under one id
    together get the copies of all of them."""
    docs = docs.select(*COLUMNS)
    with Cuts(spark) as cuts:
        taken = mix(docs, cuts).groupBy(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).agg(
            F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).filter("copies > 0")
        taken = cuts.save(taken)
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("k"))
    joined = docs.join(taken, same)
    if not taken.filter("rows > 1").isEmpty():
        joined = joined.filter("rows = 1").select(*COLUMNS, "copies").unionByName(one_of_each(joined.filter("rows > 1"), "copies"))
    return joined.withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, each with the end id, in sequences of up to 4096."""
    return pack_texts(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: A model, fingerprints and a tokenizer: not for SQL. tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    with Cuts(spark) as cuts:
        for _, stage in STAGES[:-1]:
            docs = cuts.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
