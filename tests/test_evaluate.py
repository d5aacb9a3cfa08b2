import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.operators import evaluate


def _brute_report(y, p):
    labels = sorted(set(y) | set(p))
    out = {}
    for c in labels:
        tp = sum(1 for a, b in zip(y, p) if a == c and b == c)
        sup = sum(1 for a in y if a == c)
        prd = sum(1 for b in p if b == c)
        pr = tp / prd if prd else 0.0
        rc = tp / sup if sup else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        out[str(c)] = (pr, rc, f1, sup)
    n = len(y)
    out["macro avg"] = tuple(np.mean([v[i] for v in out.values()]) for i in range(3)) + (n,)
    per = [v for k, v in out.items() if k != "macro avg"]
    out["weighted avg"] = tuple(sum(v[i] * v[3] for v in per) / n for i in range(3)) + (n,)
    out["accuracy"] = (None, None, sum(1 for a, b in zip(y, p) if a == b) / n, n)
    return out


def test_report_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 5, 300).tolist()
    p = [v if rng.random() < 0.6 else int(rng.integers(0, 7)) for v in y]  # predicts classes 5, 6 never true
    df = spark.createDataFrame(list(zip(y, p)), "label int, prediction int")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in evaluate.classification_report(df).collect()}
    want = _brute_report(y, p)
    assert set(got) == set(want)
    for k, v in want.items():
        for a, b in zip(got[k], v):
            assert (a is None and b is None) or math.isclose(a, b, abs_tol=1e-12)
    assert evaluate.confusion(df).agg(F.sum("n")).first()[0] == 300


def test_f1_and_logloss_equal_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from featureflow.operators import classify, splits

    emb = splits.hash_split(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), "vec_id")
    model = classify.train_forest(emb.filter("split = 'train'"), "embedding", "label", num_trees=5)
    pred = classify.predict(model, emb, "embedding", "label")
    ours = evaluate.accuracy_f1(pred).first()
    ll = evaluate.log_loss(pred).first().log_loss
    from featureflow.operators.columns import with_vector

    raw = model.transform(with_vector(emb, "embedding", "__fv"))
    raw = raw.withColumn("label", F.col("label").cast("double"))
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="__pred")
    assert math.isclose(ours.weighted_f1, ev.setMetricName("f1").evaluate(raw), abs_tol=1e-12)
    assert math.isclose(ours.accuracy, ev.setMetricName("accuracy").evaluate(raw), abs_tol=1e-12)
    assert math.isclose(ll, ev.setMetricName("logLoss").evaluate(raw), abs_tol=1e-9)


def test_log_loss_rules(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (0, None)],
                               "label int, probability array<double>")
    clip = evaluate.with_log_loss(df).collect()
    assert clip[0].log_loss == 0.0
    assert math.isclose(clip[1].log_loss, -math.log(1e-15))
    assert math.isclose(clip[2].log_loss, -math.log(1e-15))  # class outside the vector
    zero = evaluate.with_log_loss(df, on_zero="zero").collect()
    assert [r.log_loss for r in zero] == [0.0, 0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        evaluate.with_log_loss(df, on_zero="bad")


def test_argmax_ties_first(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.5],), ([0.9, 0.1, 0.0],)], "probability array<double>")
    assert [r.prediction for r in evaluate.argmax_class(df).collect()] == [1, 0]
    assert [r.prediction for r in evaluate.argmax_class(df, classes=[4, 5, 6]).collect()] == [5, 4]


def test_evaluate_splits_history(spark):
    df = spark.createDataFrame([("train", 0, 0, [0.9, 0.1]), ("train", 1, 0, [0.6, 0.4]), ("test", 1, 1, [0.2, 0.8])],
                               "split string, label int, prediction int, probability array<double>")
    rows = {(r.split, r.metric): r.value for r in evaluate.evaluate_splits(df, run_id="r1").collect()}
    assert rows[("train", "accuracy")] == 0.5 and rows[("test", "accuracy")] == 1.0
    assert math.isclose(rows[("test", "loss")], -math.log(0.8))


def test_evaluate_splits_matches_separate_metrics(spark):
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(300):
        lab = rnd.choice([0, 1, 2, 3, None])  # 3 lies outside the vector, None has no class
        p = [rnd.random() for _ in range(3)]
        p = [x / sum(p) for x in p]
        rows.append((rnd.choice(["train", "val", "test"]), lab, rnd.randrange(3), p))
    df = spark.createDataFrame(rows, "split string, label int, prediction int, probability array<double>")
    for rule in ("clip", "zero"):
        got = {(r.split, r.metric): r.value for r in evaluate.evaluate_splits(df, on_zero=rule).collect()}
        acc = {r.split: r for r in evaluate.accuracy_f1(df, by="split").collect()}
        ll = {r.split: r.log_loss for r in evaluate.log_loss(df, by="split", on_zero=rule).collect()}
        assert len(got) == 9
        for s in ("train", "val", "test"):
            assert math.isclose(got[(s, "accuracy")], acc[s].accuracy, rel_tol=1e-12)
            assert math.isclose(got[(s, "f1")], acc[s].weighted_f1, rel_tol=1e-12)
            assert math.isclose(got[(s, "loss")], ll[s], rel_tol=1e-12)
    no_prob = evaluate.evaluate_splits(df.drop("probability"), probability_col=None)
    assert {r.metric for r in no_prob.collect()} == {"accuracy", "f1"}


def test_evaluate_splits_reads_predictions_once(spark):
    df = spark.createDataFrame([("train", 0, 0, [0.9, 0.1])], "split string, label int, prediction int, probability array<double>")
    plan = evaluate.evaluate_splits(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1
