"""Arrays read by many tasks against Spark's reader of whole files."""

import json
import os
import random
from collections import Counter

import pytest

from featureflow.sources import json_array
from featureflow.sources.labels import LABELS_SCHEMA, read_labels

NESTED = "a string, b struct<c: string, d: array<struct<e: string>>>"


def words(rng):
    return "".join(rng.choice(['"', "\\", "}", "{", "[", "]", "x", " ", "é", "\n", ",", "y"]) for _ in range(rng.randrange(12)))


@pytest.mark.parametrize("size", [64, 700, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_equal_to_the_whole_file_reader(spark, tmp, size, indent):
    rng = random.Random(size)
    os.makedirs(tmp + "/in")
    for name, n in (("a", 150), ("b", 1), ("c", 0)):
        recs = [{"a": words(rng), "b": {"c": words(rng), "d": [{"e": words(rng)} for _ in range(rng.randrange(4))]}}
                if rng.random() < 0.7 else {"a": words(rng)} for _ in range(n)]
        with open(f"{tmp}/in/{name}.json", "w") as f:
            json.dump(recs, f, indent=indent, ensure_ascii=rng.random() < 0.5)
    with open(f"{tmp}/in/one.json", "w") as f:
        f.write(' {"a": "alone }", "b": {"c": "z"}} ')
    open(f"{tmp}/in/empty.json", "w").close()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        df = json_array.read_json_array(spark, tmp + "/in", NESTED)
        got = Counter(map(repr, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    want = Counter(map(repr, spark.read.schema(NESTED).option("multiLine", True).json(tmp + "/in").collect()))
    assert got == want and sum(got.values()) == 152


def test_labels_in_parallel(spark, tmp):
    recs = [{"image_path": f"p/{i}.jpg", "emotion": "happy"} if i % 3 else {"image_path": f"p/{i}.jpg", "error": "no {face}"} for i in range(500)]
    with open(tmp + "/l.json", "w") as f:
        json.dump(recs, f)
    a = read_labels(spark, tmp + "/l.json", parallel=True)
    b = read_labels(spark, tmp + "/l.json")
    assert a.schema.simpleString() == b.schema.simpleString() == "struct<" + LABELS_SCHEMA.replace(" ", ":").replace(",:", ",") + ">"
    assert Counter(a.collect()) == Counter(b.collect()) and a.count() == 500
