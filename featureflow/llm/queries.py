"""The registered queries of this subpackage: each operator over its whole
table with production parameters, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm.common import Cuts, table

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@register("op2_mix_sources", r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-')), 1, 15))::BIGINT AS draw
  FROM documents
),
c AS (
  SELECT *, length(bin(size + 1)) * 16 + (((size + 1) >> greatest(length(bin(size + 1)) - 5, 0)) & 15) AS size_class FROM base
),
slices AS (
  SELECT greatest(1, CAST(ceil(max(n) / 20000) AS BIGINT)) * 16 AS slices
  FROM (SELECT count(*) AS n FROM c GROUP BY source, size_class) t
),
placed AS (
  SELECT c.*, row_number() OVER (PARTITION BY source ORDER BY size_class, draw % slices, draw, doc_id, size) AS place
  FROM c, slices
),
w AS (
  SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM c GROUP BY source) t
),
filled AS (  -- sources reach three times their size in the order of size over weight
  SELECT *, (sum(s) OVER () - coalesce(sum(3.0::DOUBLE * s) OVER (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY s / w, source) AS n
  FROM w
),
lev AS (SELECT arg_min(level, n) AS level FROM filled WHERE 3.0::DOUBLE * s >= w * level),
t AS (
  SELECT source, s AS source_size, least(3.0::DOUBLE * s, w * lev.level) AS target,
         ('0x' || substr(md5('7:' || coalesce(source, '-')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS off
  FROM w, lev
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM (
  SELECT p.doc_id, p.source, p.size, t.source_size, t.target,
         CASE WHEN source_size > 0 THEN CAST(floor(place * (target / source_size) + off)
              - floor((place - 1) * (target / source_size) + off) AS BIGINT) ELSE 0 END AS copies
  FROM placed p JOIN t ON p.source IS NOT DISTINCT FROM t.source) x""")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies per document so that sources weigh 5, 2, 1, ... in words."""
    from featureflow.llm.mixing import mix

    with Cuts(spark) as cuts:
        m = mix(table(spark, sf_dir, "documents"), cuts)
    return m.select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by byte-pair merging."""
    from featureflow.llm.bpe import count_tokens

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: 4-word shingles, up to 4 differing bits."""
    from featureflow.llm.simhash import near_duplicates

    with Cuts(spark) as cuts:
        found = near_duplicates(table(spark, sf_dir, "documents"), cuts, shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op7_pack_sequences")
def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of up to 4096."""
    from featureflow.llm.packing import pack_texts

    return pack_texts(table(spark, sf_dir, "documents"))


@register("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    from featureflow.llm.licenses import label_documents

    return label_documents(table(spark, sf_dir, "documents"))


@register("op4_embedding_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v
          UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(low.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(low.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN low ON e.vec_id = low.a LEFT JOIN n ON e.vec_id = n.a""")
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within a label, at cosine 0.98."""
    from featureflow.llm.embed_dedup import near_vectors

    with Cuts(spark) as cuts:
        found = near_vectors(table(spark, sf_dir, "embeddings"), cuts)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


@register("op6_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 5""")
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    from featureflow.llm.kdtree import top_k

    vectors = table(spark, sf_dir, "embeddings")
    with Cuts(spark) as cuts:
        return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), cuts)


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those not held out."""
    from featureflow.llm.langid import is_held_out, train, with_language

    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", is_held_out("doc_id").alias("held_out"), "text")
    return with_language(texts, train(docs), score_out="score").drop("text")


@register("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from featureflow.llm.html_text import extract

    with Cuts(spark) as cuts:
        found = extract(table(spark, sf_dir, "pages"), cuts)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op8_suffix_dedup", """
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
),
w AS MATERIALIZED (
  SELECT doc_id, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 100)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d) t
),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s AND f.first < w.doc_id),
runs AS (  -- starts no more than 50 apart make one removed run
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
    SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit) t
),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
),
parts AS (
  SELECT e.doc_id, string_agg(substr(d.h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a)
           || substr(any_value(d.h), CAST(2 * max(b) + 1 AS BIGINT)) AS kept,
         sum(b - a) AS gone, count(*) AS n
  FROM edges e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(kept, d.h))) AS kept_sha256
FROM d LEFT JOIN parts ON d.doc_id = parts.doc_id""")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 50 bytes of an earlier one, removed."""
    from featureflow.llm.suffix_dedup import cut_repeats

    with Cuts(spark) as cuts:
        found = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), cuts)
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op12_decontaminate", r"""
WITH w AS (
  SELECT 'd' AS t, doc_id AS id, row_number() OVER () AS r, CAST(NULL AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
bw AS MATERIALIZED (
  SELECT DISTINCT item, len(list_slice(w, s, s + 9)) AS n, list_slice(w, s, s + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0) t
),
dw AS (
  SELECT r, s, n, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM w, (SELECT DISTINCT n FROM bw) k WHERE len(w) >= n) t
),
hit AS MATERIALIZED (SELECT r, s, dw.n, item FROM dw JOIN bw ON dw.win = bw.win),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) t GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos ON w.r = pos.r LEFT JOIN its ON w.r = its.r""")
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    from featureflow.llm.decontaminate import with_contamination

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Cuts(spark) as cuts:
        found = with_contamination(docs, table(spark, sf_dir, "benchmark"), cuts)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def periodic_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth text, drawn by h = crc32 of the id, the
    words from a on repeat the p words that stand there, so that every size of
    table has runs to find."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", F.expr("floor(crc32(cast(cast(doc_id as string) as binary)) / 10)").cast("long").alias("g"),
                    F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("w"))
    d = d.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", F.when(F.col("n") > 0, F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1))
    made = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without their repeats."""
    from featureflow.llm.periodic import with_runs

    found = with_runs(periodic_texts(table(spark, sf_dir, "documents"))).drop("text")
    # the run with the greatest length / period, compared as whole numbers
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
                              .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
                              .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                              .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]),
                                                   F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors on their first four principal components, with variance 1."""
    from featureflow.llm.whitening import whiten

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    with Cuts(spark) as cuts:
        found = whiten(vectors, cuts)
    rows = found.select("vec_id", "fit_n", "deviation", "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.col("fit_n").alias("n"), "deviation",
                       "c.whitened", "c.explained", "identity_error")
