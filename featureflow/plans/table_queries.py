"""More registered queries: file sources and sinks round trips, the remaining
splits and statuses, clustering with a fixed start, vectors with bad rows, and
checks of the Spark ML models that SQL can state.

The round trips write a driver table under the session's shared checkpoint
folder and read it back with the operator under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow import sinks
from featureflow.functions.hashing import BUCKETS
from featureflow.operators import classify, cluster, columns, evaluate, splits
from featureflow.plans import queries as q
from featureflow.plans.queries import DIGITS, register, table
from featureflow.session import checkpoint_dir
from featureflow.sources.labels import read_labels
from featureflow.sources.manifest import MANIFEST_COLUMNS, read_manifest
from featureflow.sources.samples import read_samples


def folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ============================================================ file sources and sinks

@register("manifest_tsv", """
SELECT replace(c_name, '#', ' ') AS name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey END AS image_id,
       CAST(c_nationkey AS VARCHAR) AS face_id, 'http://host/' || c_custkey || '.jpg' AS url,
       '1,2,3,' || c_custkey AS bbox, md5(CAST(c_custkey AS VARCHAR)) AS sha256 FROM customer""")
def q_manifest_tsv(spark, sf_dir):
    """Customers written as a tab-separated manifest (a non-numeric id in every
    seventh row), with one path that doesn't exist, read back by position."""
    key = F.col("c_custkey").cast("string")
    rows = table(spark, sf_dir, "customer").select(
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(key).alias("image_id"),
        F.col("c_nationkey").cast("string").alias("face_id"),
        F.concat(F.lit("http://host/"), key, F.lit(".jpg")).alias("url"),
        F.concat(F.lit("1,2,3,"), key).alias("bbox"), F.md5(key).alias("sha256"))
    path = folder(spark, "manifest")
    rows.select(*MANIFEST_COLUMNS).write.option("sep", "\t").option("header", True).csv(path)
    return read_manifest(spark, [path, f"{path}-missing"])


@register("label_lines", """
SELECT 'x/' || source || '/' || d.doc_id || '.jpg' AS image_path,
       CASE WHEN toxic = 1 THEN NULL ELSE CASE quality WHEN 1 THEN 'happy' ELSE 'sad' END END AS emotion,
       CASE WHEN toxic = 1 THEN 'cannot read' END AS error
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_label_lines(spark, sf_dir):
    """Label records written as JSON lines and read back with the fixed schema."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    j = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    toxic = F.col("toxic") == 1
    recs = j.select(
        F.concat(F.lit("x/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.when(~toxic, F.when(F.col("quality") == 1, "happy").otherwise("sad")).alias("emotion"),
        F.when(toxic, F.lit("cannot read")).alias("error"))
    path = folder(spark, "labels")
    sinks.write_table(recs, path, "json")
    return read_labels(spark, path, multiline=False)


@register("label_arrays", """
SELECT 'x/' || source || '/' || doc_id || '.jpg' AS image_path, lang AS emotion, text AS error
FROM documents""")
def q_label_arrays(spark, sf_dir):
    """Whole documents as records of JSON arrays, an array per task, read back
    by many tasks a file."""
    docs = table(spark, sf_dir, "documents")
    recs = docs.select(F.to_json(F.struct(
        F.concat(F.lit("x/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.col("lang").alias("emotion"), F.col("text").alias("error"))).alias("value"))
    path = folder(spark, "label-arrays")
    # every file is one array: its first line opens it, its last one closes it
    recs.select("value").mapInArrow(_as_array, "value string").write.text(path)
    return read_labels(spark, path, parallel=True)


def _as_array(batches):
    """The records of a task with the marks of one array around them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    first = True
    for b in batches:
        if b.num_rows:
            lead = pa.array(["[" if first and i == 0 else "," for i in range(b.num_rows)])
            first = False
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(lead, b.column(0), "")], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])


@register("table_csv", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_table_csv(spark, sf_dir):
    path = folder(spark, "csv")
    sinks.write_table(table(spark, sf_dir, "customer"), path, "csv", columns=["c_custkey", "c_name", "c_mktsegment"])
    return spark.read.schema("c_custkey bigint, c_name string, c_mktsegment string").option("header", True).csv(path)


@register("table_json", "SELECT p_partkey, p_name, p_size FROM part")
def q_table_json(spark, sf_dir):
    path = folder(spark, "json")
    sinks.write_table(table(spark, sf_dir, "part"), path, "json", columns=["p_partkey", "p_name", "p_size"])
    return spark.read.schema("p_partkey bigint, p_name string, p_size int").json(path)


@register("sample_folders", "WITH " + q._SPLIT_SQL + """
SELECT vec_id AS sample_id, label, embedding AS features, split FROM s""")
def q_sample_folders(spark, sf_dir):
    """Samples written as a folder per split and read back with a fixed schema."""
    path = folder(spark, "samples")
    s = q.split_embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("sample_id"), "label", F.col("embedding").alias("features"), "split")
    sinks.write_samples(s, path, max_records=200)
    return read_samples(spark, path, schema="sample_id bigint, label int, features array<float>, split string")


# ============================================================ splits, statuses, losses

@register("split_70_20_10", f"""
SELECT vec_id, CASE WHEN b < 700 THEN 'train' WHEN b < 900 THEN 'eval' ELSE 'test' END AS split
FROM (SELECT vec_id, ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 7))::BIGINT % {BUCKETS} AS b FROM embeddings) x""")
def q_split_70_20_10(spark, sf_dir):
    return splits.hash_split(table(spark, sf_dir, "embeddings"), "vec_id", splits.SPLIT_70_20_10).select("vec_id", "split")


@register("drop_failed", q._BOXES_SQL + " SELECT l_orderkey, l_linenumber, bbox_coords FROM parsed WHERE status = 'ok'")
def q_drop_failed(spark, sf_dir):
    return columns.drop_failed(q.parsed_boxes(spark, sf_dir)).select("l_orderkey", "l_linenumber", "bbox_coords")


@register("log_loss_zero", "WITH " + q._NC_SQL + """
SELECT s.vec_id, round(CASE WHEN coalesce(probs.p, 0.0) > 0 THEN -ln(probs.p) ELSE 0.0 END, 9) AS log_loss
FROM s LEFT JOIN probs ON s.vec_id = probs.vec_id AND s.label = probs.c_label""")
def q_log_loss_zero(spark, sf_dir):
    s, model = q._nc_model(spark, sf_dir)
    pred = evaluate.with_log_loss(model.transform(s, "embedding"), on_zero="zero", classes=model.labels)
    return pred.select("vec_id", F.round("log_loss", DIGITS).alias("log_loss"))


# ============================================================ vectors with bad rows

def _spoilt(spark, sf_dir) -> DataFrame:
    """Embeddings with every eleventh vector NULL and every thirteenth short."""
    v = F.col("embedding")
    v = F.when(F.col("vec_id") % 11 == 0, None).when(F.col("vec_id") % 13 == 0, F.slice(v, 1, 5)).otherwise(v)
    return table(spark, sf_dir, "embeddings").withColumn("embedding", v)


_BAD = "(vec_id % 11 = 0 OR vec_id % 13 = 0)"


@register("vector_status", f"SELECT vec_id, CASE WHEN {_BAD} THEN 'bad_vector' ELSE 'ok' END AS status FROM embeddings")
def q_vector_status(spark, sf_dir):
    return columns.with_vector_status(_spoilt(spark, sf_dir), "embedding").select("vec_id", "status")


@register("models_on_bad_vectors", f"""
SELECT vec_id, NOT {_BAD} AS clustered, NOT {_BAD} AS projected, NOT {_BAD} AS predicted FROM embeddings""")
def q_models_on_bad_vectors(spark, sf_dir):
    """k-means, projection and forest fitted and applied with bad vectors around:
    outputs for all good rows, NULL for the others."""
    from featureflow.operators.project import project_2d

    rows = _spoilt(spark, sf_dir)
    out, _ = cluster.kmeans(rows, q.K, 42, "embedding")
    out = project_2d(out, "embedding")
    model = classify.train_forest(rows, "embedding", "label", num_trees=5)
    out = classify.predict(model, out, "embedding", "label")
    return out.select("vec_id", F.col("cluster").isNotNull().alias("clustered"),
                      (F.col("x").isNotNull() & F.col("y").isNotNull()).alias("projected"),
                      F.col("prediction").isNotNull().alias("predicted"))


# ============================================================ clustering with a fixed start

LLOYD_ROUNDS = 3


def _lloyd_sql(start: str | None = None) -> str:
    """Start, assignment and centres round by round, as SQL."""
    start = start or f"""
init AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, embedding FROM embeddings
         ORDER BY vec_id LIMIT {q.K})"""
    parts = [f"""
WITH {start},
e AS MATERIALIZED (SELECT vec_id, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
c0 AS (SELECT cluster, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS m FROM init)"""]
    for r in range(LLOYD_ROUNDS + 1):
        parts.append(f"""
d{r} AS (SELECT e.vec_id, c.cluster, round(sum((e.x - c.m) * (e.x - c.m)), 9) AS dist
         FROM e JOIN c{r} c ON e.i = c.i GROUP BY e.vec_id, c.cluster),
a{r} AS MATERIALIZED (SELECT vec_id, cluster, dist FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS rn FROM d{r}) t WHERE rn = 1),
m{r} AS (SELECT a.cluster, e.i, round(avg(e.x), 9) AS m FROM a{r} a JOIN e ON a.vec_id = e.vec_id GROUP BY a.cluster, e.i),
c{r + 1} AS MATERIALIZED (SELECT p.cluster, p.i, coalesce(n.m, p.m) AS m FROM c{r} p
         LEFT JOIN m{r} n ON p.cluster = n.cluster AND p.i = n.i)""")
    return ",".join(parts) + f" SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, dist AS distance FROM a{LLOYD_ROUNDS}"


@register("kmeans_lloyd", _lloyd_sql())
def q_kmeans_lloyd(spark, sf_dir):
    out = cluster.lloyd(table(spark, sf_dir, "embeddings"), q.K, "vec_id", LLOYD_ROUNDS, "embedding")
    return out.select("vec_id", "cluster", "distance")


def _parallel_start_sql(steps: int = 2, seed: int = 42) -> str:
    """The candidates step by step, their weights, and the picks."""
    def u(step):
        return (f"CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':{step}:{seed}'), 1, 12))::BIGINT AS DOUBLE) / 281474976710656::DOUBLE")

    def dist(a, b):
        return f"round(list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9)"

    parts = [f"""
v AS MATERIALIZED (SELECT vec_id, embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
k0 AS MATERIALIZED (SELECT 0::BIGINT AS c, embedding, x FROM v ORDER BY {u(0)}, vec_id LIMIT 1)"""]
    for s in range(1, steps + 1):
        parts.append(f"""
n{s} AS MATERIALIZED (SELECT v.vec_id, any_value(v.embedding) AS embedding, any_value(v.x) AS x, min({dist("v.x", "k.x")}) AS d
       FROM v, k{s - 1} k GROUP BY v.vec_id),
t{s} AS MATERIALIZED (SELECT CAST(sum(CAST(d AS DECIMAL(38, 9))) AS DOUBLE) AS total FROM n{s}),
k{s} AS MATERIALIZED (
  SELECT c, embedding, x FROM k{s - 1}
  UNION ALL SELECT (SELECT count(*) FROM k{s - 1}) + row_number() OVER (ORDER BY u, vec_id) - 1, embedding, x FROM (
    SELECT any_value(embedding) AS embedding, x, min(u) AS u, arg_min(vec_id, u) AS vec_id
    FROM (SELECT *, {u(s)} AS u FROM n{s}) n, t{s} WHERE u * total < {2 * q.K} * d GROUP BY x) g)""")
    parts.append(f"""
w AS MATERIALIZED (SELECT c, count(*) AS w FROM (
  SELECT vec_id, c, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS rn
  FROM (SELECT v.vec_id, k.c, {dist("v.x", "k.x")} AS d FROM v, k{steps} k) a) b WHERE rn = 1 GROUP BY c),
cand AS MATERIALIZED (SELECT k.c, embedding, x, coalesce(w, 0) AS w FROM k{steps} k LEFT JOIN w ON k.c = w.c),
p0 AS MATERIALIZED (SELECT c, embedding, x, 0 AS cluster FROM cand ORDER BY w DESC, c LIMIT 1)""")
    for i in range(1, q.K):
        parts.append(f"""
p{i} AS MATERIALIZED (SELECT * FROM p{i - 1} UNION ALL (
  SELECT any_value(a.c), any_value(a.embedding), any_value(a.x), {i} FROM cand a, p{i - 1} p
  GROUP BY a.c ORDER BY any_value(a.w) * min({dist("a.x", "p.x")}) DESC, a.c LIMIT 1))""")
    parts.append(f"""
init AS MATERIALIZED (SELECT cluster, embedding FROM p{q.K - 1})""")
    return ",".join(parts)


@register("kmeans_parallel_start", _lloyd_sql(_parallel_start_sql()))
def q_kmeans_parallel_start(spark, sf_dir):
    """k-means from a k-means|| start whose draws are hashes, so any engine gets the same clusters."""
    emb = table(spark, sf_dir, "embeddings")
    start = cluster.parallel_start(emb, q.K, "vec_id", "embedding")
    return cluster.lloyd(emb, q.K, "vec_id", LLOYD_ROUNDS, "embedding", start=start).select("vec_id", "cluster", "distance")


# ============================================================ Spark ML models: what SQL can state of them

@register("kmeans_nearest", "SELECT vec_id, true AS nearest FROM embeddings")
def q_kmeans_nearest(spark, sf_dir):
    """Each row's k-means cluster is that of its nearest centre."""
    emb = table(spark, sf_dir, "embeddings")
    out, model = cluster.kmeans(emb, q.K, 42, "embedding")
    import numpy as np

    centres = classify.CentroidModel(labels=list(range(q.K)), centers=np.array(model.clusterCenters()))
    both = cluster.assign_centroids(out, centres, "embedding", "own", None)
    return both.select("vec_id", (F.col("own") == F.col("cluster")).alias("nearest"))


@register("projection_moments", """
SELECT count(*) AS n, true AS centred, true AS uncorrelated, true AS ordered FROM embeddings""")
def q_projection_moments(spark, sf_dir):
    """The two coordinates are uncorrelated, the first varies most, and their means
    are those of the model's mean vector."""
    from featureflow.operators.project import component_signs, fit_projection, project_2d

    emb = table(spark, sf_dir, "embeddings")
    model = fit_projection(emb, "embedding")
    shift = (model.mean @ (model.components * component_signs(model))).tolist()
    p = project_2d(emb, "embedding", model=model)
    m = p.agg(F.count(F.lit(1)).alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
              F.covar_samp("x", "y").alias("c"), F.avg("x").alias("ax"), F.avg("y").alias("ay"))
    near = (F.abs(F.col("ax") - shift[0]) < 1e-9) & (F.abs(F.col("ay") - shift[1]) < 1e-9)
    return m.select("n", near.alias("centred"), (F.abs("c") < 1e-9 * F.col("vx")).alias("uncorrelated"),
                    (F.col("vx") >= F.col("vy")).alias("ordered"))


@register("projection_variance", """
WITH e AS (SELECT vec_id, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT count(DISTINCT vec_id) AS n, round(sum(var) * 1.0, 9) AS total_variance, true AS holds FROM (
  SELECT i, var_samp(v) AS var, max(vec_id) AS vec_id FROM e GROUP BY i) t""".replace(
    "count(DISTINCT vec_id) AS n", "(SELECT count(*) FROM embeddings) AS n"))
def q_projection_variance(spark, sf_dir):
    """All directions fitted: their variances add up to those of the components,
    and the covariance times each direction is its variance times the direction."""
    from featureflow.operators.project import fit_projection

    emb = table(spark, sf_dir, "embeddings")
    model = fit_projection(emb, "embedding", k=len(emb.first()["embedding"]))
    return emb.agg(F.count(F.lit(1)).alias("n"), F.round(F.lit(float(model.values.sum())), DIGITS).alias("total_variance"),
                   F.lit(model.residual < 1e-9).alias("holds"))


def _consistent(pred: DataFrame) -> DataFrame:
    p = F.col("probability")
    return pred.select("vec_id", "split", "label",
                       (F.col("prediction") == F.array_position(p, F.array_max(p)) - 1).alias("is_argmax"),
                       (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"))


_CONSISTENT_SQL = "WITH " + q._SPLIT_SQL + " SELECT vec_id, split, label, true AS is_argmax, true AS sums_to_one FROM s"


@register("forest_consistent", _CONSISTENT_SQL)
def q_forest_consistent(spark, sf_dir):
    return _consistent(q._forest_predictions(spark, sf_dir))


@register("forest_beats_majority", "SELECT 'train' AS split, true AS beats_majority")
def q_forest_beats_majority(spark, sf_dir):
    """On the rows it was fitted on, the forest is right more often than the most frequent label."""
    pred = q._forest_predictions(spark, sf_dir).filter("split = 'train'")
    conf = pred.groupBy("split", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    by = conf.groupBy("split", "label").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("right"))
    return by.groupBy("split").agg((F.sum("right") > F.max("n")).alias("beats_majority"))


@register("exact_split", """
SELECT vec_id, label, CASE WHEN before < floor(0.7 * n + 0.5) THEN 'train' WHEN before < floor(0.9 * n + 0.5) THEN 'eval' ELSE 'test' END AS split
FROM (SELECT *, rank() OVER (PARTITION BY label ORDER BY h) - 1 AS before, count(*) OVER (PARTITION BY label) AS n
      FROM (SELECT *, ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM embeddings) t) u""")
def q_exact_split(spark, sf_dir):
    """70/20/10 in every class, exact to the row."""
    return splits.exact_split(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", splits.SPLIT_70_20_10, by="label")


@register("exact_split_repeated_keys", """
SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN before < floor(0.7 * n + 0.5) THEN 'train' WHEN before < floor(0.9 * n + 0.5) THEN 'eval' ELSE 'test' END AS split
FROM (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY h) - 1 AS before, count(*) OVER (PARTITION BY l_returnflag) AS n
      FROM (SELECT *, ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM lineitem) t) u""")
def q_exact_split_repeated_keys(spark, sf_dir):
    """Line items of an order and return flag stay together; three large classes."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return splits.exact_split(items, "l_orderkey", splits.SPLIT_70_20_10, by="l_returnflag")


@register("forest_steps", "WITH " + q._SPLIT_SQL + """
SELECT step, split, metric, true AS same FROM (SELECT DISTINCT split FROM s) a,
(SELECT unnest([1, 20]) AS step) t, (VALUES ('accuracy'), ('f1'), ('loss')) m(metric)""")
def q_forest_steps(spark, sf_dir):
    """Metric history of a forest by number of trees, from one scoring pass. Its
    first and last step are compared with the first tree and the whole forest as
    Spark scores them."""
    s = q.split_embeddings(spark, sf_dir)
    model = classify.train_forest(s.filter(F.col("split") == "train"), "embedding", "label")
    hist = evaluate.evaluate_splits(classify.forest_steps(model, s, "embedding"), step_col="step")
    one = evaluate.evaluate_splits(classify.predict(model.trees[0], s, "embedding"), step=1)
    whole = evaluate.evaluate_splits(classify.predict(model, s, "embedding"), step=20)
    wanted = one.unionByName(whole).select("step", "split", "metric", F.col("value").alias("want"))
    return hist.join(wanted, ["step", "split", "metric"]).select(
        "step", "split", "metric", (F.abs(F.col("value") - F.col("want")) < 1e-9).alias("same"))


@register("network_learns", "WITH " + q._SPLIT_SQL + """
SELECT 'train' AS split, 12 AS epochs, count(*) AS n, true AS loss_falls, true AS beats_majority, true AS sums_to_one
FROM s WHERE split = 'train'""")
def q_network_learns(spark, sf_dir):
    """The data-parallel network at its full width on the training rows: its loss
    falls over the epochs, and it's right more often than the most frequent label."""
    from featureflow.operators.network import train_network

    tr = q.split_embeddings(spark, sf_dir).filter(F.col("split") == "train")
    model = train_network(tr, "embedding", "label", epochs=12, key=["vec_id"])
    pred = model.transform(tr, "embedding")
    p = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    conf = pred.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("long")).alias("right"),
        F.max(F.abs(p - 1)).alias("off"))
    return conf.groupBy("split").agg(
        F.lit(12).alias("epochs"), F.sum("n").alias("n"), F.lit(bool(model.losses[-1] < model.losses[0])).alias("loss_falls"),
        (F.sum("right") > F.max("n")).alias("beats_majority"), (F.max("off") < 1e-9).alias("sums_to_one"))


@register("mlp_consistent", _CONSISTENT_SQL)
def q_mlp_consistent(spark, sf_dir):
    """A small network: the full-width one is the query ``mlp``."""
    s = q.split_embeddings(spark, sf_dir)
    model = classify.train_mlp(s.filter(F.col("split") == "train"), "embedding", "label", hidden=(32, 16))
    return _consistent(classify.predict(model, s, "embedding", "label"))


@register("history_shape", "WITH " + q._SPLIT_SQL + """
SELECT 'forest' AS run_id, 0 AS step, split, metric, true AS in_range
FROM (SELECT DISTINCT split FROM s) a, (VALUES ('accuracy'), ('f1'), ('loss')) m(metric)""")
def q_history_shape(spark, sf_dir):
    """One row per split and metric of a forest, written to the metric history
    twice (the second write replaces the first) and read back."""
    hist = evaluate.evaluate_splits(q._forest_predictions(spark, sf_dir), run_id="forest", step=0)
    path = folder(spark, "metrics")
    sinks.append_metrics(hist, path)
    sinks.append_metrics(hist, path)
    share = (F.col("metric") == "loss") | (F.col("value") <= 1)
    return sinks.read_metrics(spark, path).select("run_id", "step", "split", "metric", ((F.col("value") >= 0) & share).alias("in_range"))


# ============================================================ stages that go on, batches of repeated keys

@register("resumed_stage", """
SELECT o_orderpriority AS person, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey END AS image_id, o_orderkey AS order_id,
       CASE WHEN o_orderkey % 13 = 0 THEN 'bad_bbox' WHEN o_orderkey % 11 = 0 THEN 'missing_image'
            WHEN o_orderkey % 3 <> 0 OR o_orderkey % 5 <> 0 THEN 'ok' ELSE 'missing_image' END AS status,
       CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN 2 ELSE 1 END AS attempt
FROM orders""")
def q_resumed_stage(spark, sf_dir):
    """Orders as a stage run three times: pictures of two thirds are there at
    first, others have come (and some have gone) before the second run, and the
    third has nothing to do. Some rows have no id, some a bad box."""
    from featureflow.plans import ledger

    key = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("person"), key.alias("image_id"), F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 13 == 0, "bad_bbox").otherwise("ok").alias("status"))
    path, keys = folder(spark, "stage"), ["person", "image_id"]
    for there in (F.col("order_id") % 3 != 0, F.col("order_id") % 5 != 0, F.col("order_id") % 5 != 0):
        listed = rows.filter(there & F.col("image_id").isNotNull()).select(*keys)

        def work(todo: DataFrame, listed: DataFrame = listed) -> DataFrame:
            from featureflow.operators.joins import with_presence

            j = with_presence(todo, listed, keys, "there")
            return columns.with_status(j, ~F.col("there"), "missing_image").select("person", "image_id", "order_id", "status")

        done = ledger.run_stage(spark, path, rows, keys, "person string, image_id bigint, order_id bigint, status string",
                                work, available=listed)
    return done.select("person", "image_id", "order_id", "status", "attempt")


@register("batch_id_repeated_keys", f"""
SELECT batch_id, o_custkey, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
         CAST((row_number() OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END) - 1) // {q.BATCH_SIZE} AS BIGINT) AS batch_id
  FROM orders) t GROUP BY ALL""")
def q_batch_id_repeated_keys(spark, sf_dir):
    """Batches by customer, with one customer in a third of the rows: how many
    rows of each are in each batch (which ones is not determined)."""
    orders = table(spark, sf_dir, "orders")
    hot = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey")))
    out = splits.with_batch_id(hot, "o_custkey", q.BATCH_SIZE)
    return out.groupBy("batch_id", "o_custkey").agg(F.count(F.lit(1)).alias("n"))


# ============================================================ resampling, grey pictures of three channels

def _byte_images(spark, sf_dir, channels: int = 1) -> DataFrame:
    """``vec_id, image``: each embedding as an 8-bit picture, 8 wide and 8 / channels high."""
    from featureflow.operators.images import mode_of
    import numpy as np

    level = F.transform("embedding", lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v.cast("double") * 300 + 128))))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
    image = F.struct(F.lit("").alias("origin"), F.lit(8 // channels).alias("height"), F.lit(8).alias("width"),
                     F.lit(channels).alias("nChannels"), F.lit(mode_of(np.uint8, channels)).alias("mode"), data.alias("data"))
    return table(spark, sf_dir, "embeddings").select("vec_id", image.alias("image"))


_LEVELS_SQL = """
px AS (SELECT vec_id, list_transform(embedding, lambda v: greatest(0, least(255, CAST(floor(CAST(v AS DOUBLE) * 300 + 128) AS BIGINT)))) AS p FROM embeddings)"""


def _resample_sql(kernel: str, reach: float, height: int, width: int) -> str:
    """Weights of both axes from the filter's formula in ``x``, then rows, then columns."""
    return f"""
WITH {_LEVELS_SQL},
axis AS (SELECT 'w' AS ax, {width} AS dst UNION ALL SELECT 'h', {height}),
place AS (SELECT ax, i, greatest(8::DOUBLE / dst, 1.0::DOUBLE) AS wide, (i + 0.5::DOUBLE) * (8::DOUBLE / dst) AS centre
       FROM (SELECT ax, dst, unnest(range(0, dst)) AS i FROM axis) t),
raw AS (
  SELECT ax, i, s, (SELECT {kernel} FROM (SELECT abs((s - centre + 0.5::DOUBLE) * (1.0::DOUBLE / wide)) AS x) f) AS k
  FROM (SELECT *, unnest(range(greatest(CAST(trunc(centre - {reach}::DOUBLE * wide + 0.5::DOUBLE) AS BIGINT), 0),
                               least(CAST(trunc(centre + {reach}::DOUBLE * wide + 0.5::DOUBLE) AS BIGINT), 8))) AS s FROM place) t
),
wt AS MATERIALIZED (
  SELECT ax, i, s, CAST(trunc(k * (1.0::DOUBLE / t) * 4194304 + CASE WHEN k < 0 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END) AS BIGINT) AS k
  FROM raw JOIN (SELECT ax, i, list_reduce(list(k ORDER BY s), lambda a, b: a + b) AS t FROM raw GROUP BY ax, i) r USING (ax, i)
),
e AS (SELECT vec_id, n // 8 AS y, n % 8 AS s, v FROM (SELECT vec_id, unnest(range(0, 64)) AS n, unnest(p) AS v FROM px) u),
rows1 AS (
  SELECT vec_id, y AS s, wt.i AS x, greatest(0, least(255, CAST((sum(v * k) + 2097152) >> 22 AS BIGINT))) AS v
  FROM (SELECT vec_id, y, s, CAST(v AS BIGINT) AS v FROM e) e JOIN wt ON ax = 'w' AND e.s = wt.s GROUP BY vec_id, y, wt.i
),
resized AS (
  SELECT vec_id, wt.i AS y, x, greatest(0, least(255, CAST((sum(v * k) + 2097152) >> 22 AS BIGINT))) AS v
  FROM rows1 r JOIN wt ON ax = 'h' AND r.s = wt.s GROUP BY vec_id, wt.i, x
)
SELECT vec_id, 'ok' AS status, CAST({height} AS INTEGER) AS height, CAST({width} AS INTEGER) AS width,
       CAST(list(v ORDER BY y, x) AS FLOAT[]) AS pixels FROM resized GROUP BY vec_id"""


_CUBIC_SQL = ("CASE WHEN x < 1 THEN (1.5::DOUBLE * x - 2.5::DOUBLE) * x * x + 1 "
              "WHEN x < 2 THEN (((x - 5) * x + 8) * x - 4) * -0.5::DOUBLE ELSE 0.0::DOUBLE END")


@register("resize_bicubic", _resample_sql(_CUBIC_SQL, 2, 3, 12))
def q_resize_bicubic(spark, sf_dir):
    """8 x 8 bytes to 3 rows (the filter widens) of 12 columns."""
    from featureflow.operators.images import resize

    return q._pixels_out(resize(_byte_images(spark, sf_dir), (3, 12), "bicubic"))


@register("resize_triangle", _resample_sql("greatest(1.0::DOUBLE - x, 0.0::DOUBLE)", 1, 11, 5))
def q_resize_triangle(spark, sf_dir):
    """8 x 8 bytes to 11 rows of 5 columns, linear weights over all covered pixels."""
    from featureflow.operators.images import resize

    return q._pixels_out(resize(_byte_images(spark, sf_dir), (11, 5), "triangle"))


@register("gray_luma", "WITH " + _LEVELS_SQL + """
SELECT vec_id, 'ok' AS status, CAST(2 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width,
       CAST(list_transform(range(16), lambda i: floor((p[4 * i + 1] * 114 + p[4 * i + 2] * 587 + p[4 * i + 3] * 299 + 500) / 1000)) AS FLOAT[]) AS pixels
FROM px""")
def q_gray_luma(spark, sf_dir):
    """Four-channel byte pictures (blue, green, red, alpha) to luma."""
    from featureflow.operators.images import to_gray

    return q._pixels_out(to_gray(_byte_images(spark, sf_dir, channels=4)))
