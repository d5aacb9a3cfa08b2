"""Splits of exact sizes, against a sort in Python."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featureflow.operators.splits import exact_split

WEIGHTS = {"a": 0.5, "b": 0.3, "c": 0.2}


def place(key) -> int:
    return int(hashlib.md5(str(key).encode()).hexdigest()[:15], 16)


def wanted(rows):
    out = []
    for key, cls in rows:
        own = [place(k) for k, c in rows if c == cls]
        before = sum(h < place(key) for h in own)
        run, name = 0.0, None
        for n, w in WEIGHTS.items():
            run += w
            if name is None and (n == "c" or before < math.floor(run / sum(WEIGHTS.values()) * len(own) + 0.5)):
                name = n
        out.append((key, cls, name))
    return Counter(out)


@pytest.mark.parametrize("rows", [
    [(i, "x" if i % 3 else None) for i in range(300)],                 # a NULL class
    [(i % 40, "xyz"[i % 3]) for i in range(300)],                      # repeated keys
    [(7 if i < 150 else i, "x") for i in range(400)],                  # one key in a third of the rows
    [(1, "x"), (2, "y"), (3, "y")],                                    # classes smaller than the splits
    [(5, "x")] * 30])                                                  # one key alone
def test_against_a_sort(spark, rows):
    df = spark.createDataFrame(rows, "k long, cls string")
    got = exact_split(df.repartition(5), "k", WEIGHTS, by="cls").collect()
    assert Counter((r.k, r.cls, r.split) for r in got) == wanted(rows)


def test_sizes_seed_and_bad_input(spark):
    df = spark.range(1000).withColumn("split", F.lit("old"))
    got = exact_split(df, "id", WEIGHTS)
    assert got.columns == ["id", "split"]
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"a": 500, "b": 300, "c": 200}
    other = exact_split(df, ["id"], WEIGHTS, seed=3)
    assert other.exceptAll(got).count() > 300 and other.filter("split = 'c'").count() == 200
    assert exact_split(df.limit(0), "id", WEIGHTS).count() == 0
    assert exact_split(df, "id", {"all": 1}).filter("split = 'all'").count() == 1000
    with pytest.raises(Exception, match="split key is NULL"):
        exact_split(df.withColumn("id", F.lit(None).cast("long")), "id", WEIGHTS).count()
    with pytest.raises(ValueError):
        exact_split(df, "id", {"a": -1, "b": 2})
