"""Files that hold one JSON array, read by many tasks.

Spark's ``multiLine`` reader gives such a file to one task. Here it's read as
text cut after every ``}``, which the text source splits by blocks. Whether a
block begins inside a string, and how deep, follows from what the blocks before
it do: each block is summed up for both ways it can begin, and a running sum
over one row a block gives the way it does. A second pass then cuts the blocks
into elements; one that lies across blocks is put together from its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.session import materialize

#: One row of 24 bytes a block is broadcast; more blocks than this ask for larger ones.
MAX_BLOCKS = 1 << 20
MARKS = re.compile(r'\\.|["{}\[\]]', re.S)
SPACE = " \t\r\n"


def scan(chunk: str, inside: bool) -> tuple[bool, int, int]:
    """``inside`` a string at the end, and the change of depth outside strings
    for this way to begin and for the other one."""
    depth = [0, 0]
    flipped = False
    for m in MARKS.finditer(chunk):
        c = m[0]
        if c == '"':
            flipped = not flipped
        elif len(c) == 1:
            depth[flipped] += 1 if c in "{[" else -1
    return inside != flipped, depth[inside], depth[not inside]


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a block: quotes (odd or even), depth gained if it begins outside a
    string, or inside one, and the first character that isn't space."""
    at, odd, out, ins, first = None, False, 0, 0, ""

    def row():
        return pa.RecordBatch.from_pydict({
            "file": pa.array([at[0]], pa.int64()), "start": pa.array([at[1]], pa.int64()), "odd": pa.array([int(odd)], pa.int64()),
            "out": pa.array([out], pa.int64()), "ins": pa.array([ins], pa.int64()), "first": pa.array([first], pa.string())})

    for b in batches:
        for text, file, start in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if at != (file, start):
                if at is not None:
                    yield row()
                at, odd, out, ins, first = (file, start), False, 0, 0, ""
            chunk = text.as_py() + "}"
            first = first or chunk.lstrip(SPACE + "\ufeff")[:1]
            odd, a, c = scan(chunk, odd)
            # the two ways to begin are each other's complement all along
            out, ins = out + a, ins + c
    if at is not None:
        yield row()


def elements_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements (``part`` null) and the pieces of those that lie across blocks:
    ``part`` 1 begins an element, 0 goes on with it."""
    at, inside, depth, base, parts, begun = None, False, 0, 1, None, False

    def rest():
        return [("".join(parts), *at, int(begun))] if parts else []

    for b in batches:
        rows = []
        for text, *key, odd, deep, of in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if at != tuple(key):
                rows += rest()
                at, inside, depth, base = tuple(key), bool(odd), deep, of
                # within an element from the block before, or not
                parts, begun = ([] if inside or depth > base else None), False
            chunk, done = text + "}", 0
            for m in MARKS.finditer(chunk):
                c = m[0]
                if c == '"':
                    inside = not inside
                elif len(c) == 1 and not inside:
                    if c in "{[":
                        if c == "{" and depth == base and parts is None:
                            parts, begun, done = [], True, m.start()
                        depth += 1
                    else:
                        depth -= 1
                        if depth == base and parts is not None:
                            parts.append(chunk[done:m.end()])
                            rows.append(("".join(parts), *at, None if begun else 0))
                            parts, done = None, m.end()
            if parts is not None:
                parts.append(chunk[done:])
        yield batch(rows)
    if at is not None:
        yield batch(rest())


def batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["text", "file", "start", "part"])


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """A row for each object of the arrays in the files, as ``schema`` (DDL). A
    file holding one object gives a row; elements that aren't objects, empty
    files and empty arrays give none. Objects that don't parse have NULLs. An
    object that spans blocks moves to one task with its pieces alone."""
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.option("lineSep", "}").text(paths).select(
        F.col("value").alias("text"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    blocks = materialize(rows.mapInArrow(blocks_of, "file long, start long, odd long, out long, ins long, first string"))
    if blocks.count() > MAX_BLOCKS:
        raise ValueError(f"over {MAX_BLOCKS} blocks; raise spark.sql.files.maxPartitionBytes")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0))
    told = blocks.withColumn("inside", inside).withColumn("gain", F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("ins")))
    first = F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    told = told.select("file", "start", "inside", F.coalesce(F.sum("gain").over(before), F.lit(0)).alias("depth"),
                       F.when(first == "[", 1).otherwise(0).alias("base"))
    found = rows.join(F.broadcast(told), ["file", "start"]).select("text", "file", "start", "inside", "depth", "base").mapInArrow(
        elements_of, "text string, file long, start long, part int")
    # a block holds one piece of the element before it and one of the element after it at most
    pieces = found.filter("part IS NOT NULL").withColumn("element", F.sum("part").over(
        Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)))
    joined = pieces.groupBy("file", "element").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", F.when(F.col("part") == 1, 0).otherwise(1), "text"))),
                                 lambda p: p["text"]), "").alias("text"))
    whole = found.filter("part IS NULL").select("text").unionByName(joined.select("text"))
    return whole.select(F.from_json("text", schema).alias("r")).select("r.*")
