"""Metrics as tables: confusion counts, per-class report, accuracy, F1, log loss.

Everything is a grouped aggregate over the prediction table. The first
aggregate (confusion counts) shrinks the data to at most classes^2 rows per
group before anything else happens, so the report never sees the row count;
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions.vectors import argmax, log_loss_term, prob_at


def _by(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def confusion(
    pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """``[by...], label, prediction, n``."""
    return pred.groupBy(*_by(by), label_col, prediction_col).agg(F.count(F.lit(1)).alias("n"))


def class_stats(
    pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Per class: ``[by...], class, tp, support, predicted`` (classes = true
    labels union predicted labels)."""
    g = _by(by)
    return _class_stats(confusion(pred, label_col, prediction_col, g), label_col, prediction_col, g)


def _class_stats(
    conf: DataFrame, label_col: str, prediction_col: str, g: list[str], carry: str | None = None,
) -> DataFrame:
    """Per-class sums from confusion counts ``n``. A ``carry`` column (a sum per
    confusion cell) is added up on the true-label side only."""
    ltype = dict(conf.dtypes)[label_col]
    lab, prd, n = F.col(label_col), F.col(prediction_col).cast(ltype), F.col("n")
    zero = F.lit(0).cast("bigint")
    extra_true = [F.col(carry).alias(carry)] if carry else []
    extra_pred = [F.lit(None).cast(dict(conf.dtypes)[carry]).alias(carry)] if carry else []
    both = F.array(
        F.struct(lab.alias("cls"), n.alias("support"), zero.alias("predicted"),
                 F.when(lab == prd, n).otherwise(zero).alias("tp"), *extra_true),
        F.struct(prd.alias("cls"), zero.alias("support"), n.alias("predicted"), zero.alias("tp"), *extra_pred),
    )
    rows = conf.select(*g, F.explode(both).alias("r")).select(*g, "r.*")
    sums = [F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")]
    if carry:
        sums.append(F.sum(carry).alias(carry))
    return rows.groupBy(*g, "cls").agg(*sums)


def _prf(stats: DataFrame) -> DataFrame:
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    p = F.when(prd > 0, tp / prd).otherwise(F.lit(0.0))
    r = F.when(sup > 0, tp / sup).otherwise(F.lit(0.0))
    s = stats.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return s.withColumn("f1", f1)


def classification_report(
    pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
    by: str | Sequence[str] | None = None, digits: int | None = None,
) -> DataFrame:
    """``[by...], class, precision, recall, f1, support``: one row per class,
    then ``macro avg``, ``weighted avg`` and ``accuracy`` (the last with its
    value in ``f1`` and the row count in ``support``). 0/0 counts as 0."""
    g = _by(by)
    per = _prf(class_stats(pred, label_col, prediction_col, g))
    classes = per.select(
        *g, F.col("cls").cast("string").alias("class"),
        _round(F.col("precision"), digits).alias("precision"),
        _round(F.col("recall"), digits).alias("recall"),
        _round(F.col("f1"), digits).alias("f1"),
        F.col("support"),
    )
    total = F.sum("support")
    summary = per.groupBy(*g).agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("w_f"),
        (F.sum("tp") / total).alias("acc"),
        total.alias("support"),
    )
    null = F.lit(None).cast("double")
    kinds = F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("m_p").alias("precision"),
                 F.col("m_r").alias("recall"), F.col("m_f").alias("f1")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("w_p").alias("precision"),
                 F.col("w_r").alias("recall"), F.col("w_f").alias("f1")),
        F.struct(F.lit("accuracy").alias("class"), null.alias("precision"),
                 null.alias("recall"), F.col("acc").alias("f1")),
    )
    avgs = summary.select(*g, "support", F.explode(kinds).alias("k")).select(
        *g, F.col("k.class").alias("class"),
        _round(F.col("k.precision"), digits).alias("precision"),
        _round(F.col("k.recall"), digits).alias("recall"),
        _round(F.col("k.f1"), digits).alias("f1"),
        F.col("support"),
    )
    return classes.unionByName(avgs)


def accuracy_f1(
    pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
    by: str | Sequence[str] | None = None, digits: int | None = None,
) -> DataFrame:
    """``[by...], accuracy, weighted_f1, macro_f1, n`` (weighted F1 is what
    Spark's evaluator calls "f1")."""
    g = _by(by)
    per = _prf(class_stats(pred, label_col, prediction_col, g))
    total = F.sum("support")
    return per.groupBy(*g).agg(
        _round(F.sum("tp") / total, digits).alias("accuracy"),
        _round(F.sum(F.col("f1") * F.col("support")) / total, digits).alias("weighted_f1"),
        _round(F.avg("f1"), digits).alias("macro_f1"),
        total.alias("n"),
    )


def with_log_loss(
    df: DataFrame, probability_col: str = "probability", label_col: str = "label",
    out: str = "log_loss", on_zero: str = "clip", classes: Sequence | None = None,
) -> DataFrame:
    """Per-row ``-ln p(true class)``. The probability may be an ML vector
    (converted with ``vector_to_array``) or an array. The true class indexes
    the vector directly, or through ``classes`` (the model's class order)."""
    prob = F.col(probability_col)
    if dict(df.dtypes)[probability_col] == "vector":
        from pyspark.ml.functions import vector_to_array

        prob = vector_to_array(prob)
    if classes is None:
        idx = F.col(label_col)
    else:
        idx = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label_col)) - 1
    return df.withColumn(out, log_loss_term(prob_at(prob, idx), on_zero))


def log_loss(
    df: DataFrame, probability_col: str = "probability", label_col: str = "label",
    by: str | Sequence[str] | None = None, on_zero: str = "clip",
    classes: Sequence | None = None, digits: int | None = None,
) -> DataFrame:
    """``[by...], log_loss, n``: mean log loss."""
    g = _by(by)
    t = with_log_loss(df, probability_col, label_col, "__ll", on_zero, classes)
    return t.groupBy(*g).agg(_round(F.avg("__ll"), digits).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def argmax_class(
    df: DataFrame, probability_col: str = "probability", out: str = "prediction",
    classes: Sequence | None = None,
) -> DataFrame:
    """Class of the largest score (first one on ties). Without ``classes`` the
    class is the 0-based position."""
    pos = argmax(F.col(probability_col))
    if classes is not None:
        pos = F.element_at(F.array(*[F.lit(c) for c in classes]), pos + 1)
    return df.withColumn(out, pos)


def evaluate_splits(
    pred: DataFrame, split_col: str = "split", label_col: str = "label",
    prediction_col: str = "prediction", probability_col: str | None = "probability",
    run_id: str = "run", step: int = 0, on_zero: str = "clip", classes: Sequence | None = None,
    digits: int | None = None, step_col: str | None = None,
) -> DataFrame:
    """Metric history rows ``run_id, step, split, metric, value`` for every split
    at once: accuracy, weighted F1 and (with probabilities) log loss;
    ``classes`` is the model's class order for the probability vector.

    ``step_col`` names a column with the step of each prediction, instead of ``step``.

    One pass over the predictions: a single grouped aggregate per (split,
    label, prediction) carries the row count and the log-loss sum, and every
    later step works on that table of at most splits x classes^2 rows."""
    g = [split_col, step_col] if step_col else [split_col]
    sums = [F.count(F.lit(1)).alias("n")]
    if probability_col:
        pred = with_log_loss(pred, probability_col, label_col, "__ll", on_zero, classes)
        sums.append(F.sum("__ll").alias("ll"))
    conf = pred.groupBy(*g, label_col, prediction_col).agg(*sums)
    if not probability_col:
        conf = conf.withColumn("ll", F.lit(None).cast("double"))
    per = _prf(_class_stats(conf, label_col, prediction_col, g, carry="ll"))
    total = F.sum("support")
    by_split = per.groupBy(*g).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
        (F.sum("ll") / total).alias("loss"),
    )
    metrics = ["accuracy", "f1"] + (["loss"] if probability_col else [])
    kinds = F.array(*[F.struct(F.lit(m).alias("metric"), _round(F.col(m).cast("double"), digits).alias("value"))
                      for m in metrics])
    out = by_split.select(*g, F.explode(kinds).alias("k"))
    return out.select(
        F.lit(run_id).alias("run_id"), (F.col(step_col).cast("int") if step_col else F.lit(int(step))).alias("step"),
        F.col(split_col).alias("split"), F.col("k.metric").alias("metric"), F.col("k.value").alias("value"),
    )
