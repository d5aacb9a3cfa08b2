"""Near-duplicate vectors by Euclidean p-stable hashing (Datar et al., 2004).

On unit vectors cosine c is Euclidean distance sqrt(2 - 2c). Each of ``tables``
hash tables puts a vector into the bucket of ``hashes`` quantised Gaussian
projections; vectors that share a bucket in some table and have equal labels
are compared exactly. A pair at cosine 0.98 (distance 0.2) misses one projection
with probability 0.13 at width 1.2, so all 24 tables of 8 with 1 in 10,000.

Equal vectors under one label are hashed once, with their number. A bucket's
pairs are compared in numpy; a pair counts in the first table it meets in. Only
link counts per vector and a spanning forest of the links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import (
    Cuts,
    connected_components,
    forest,
    group_starts,
    pairs_by_offset,
    spread_blocks,
    whole_groups,
)
from featureflow.llm.vectors import is_finite_vector, matrix

TABLES, HASHES, WIDTH = 24, 8, 1.2
BLOCK = 1024
SMALL_GROUP = 64
TILE = 256
KEYS = ["tab", "bucket", "cell_i", "cell_j"]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest part, against overflow)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def buckets(u: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """Bucket of each unit row in each table (n x tables), as longs."""
    rng = np.random.default_rng([seed, u.shape[1]])
    a = rng.standard_normal((u.shape[1], tables * hashes))
    b = rng.uniform(0, width, tables * hashes)
    q = np.floor((u @ a + b) / width).astype(np.int64).reshape(len(u), tables, hashes).view(np.uint64)
    key = np.zeros(q.shape[:2], np.uint64)
    for i in range(hashes):  # a multiply-and-shift mix; a clash only means one more comparison
        key = (key ^ q[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def hashed_rows(classes: DataFrame, tables: int, hashes: int, width: float, seed: int) -> DataFrame:
    """``tab, bucket, label, rep, n, keys, embedding``: each class in each table.
    ``keys`` (its buckets in all tables) tells where a pair meets first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = whole.column("embedding").value_lengths().to_numpy()
            for d in np.unique(lengths):  # one length nearly always
                b = whole.filter(pa.array(lengths == d))
                for at in range(0, b.num_rows, 2000):
                    part = b.slice(at, 2000)
                    u = unit_rows(matrix(part.column("embedding")))
                    k = buckets(u, tables, hashes, width, seed)
                    label = part.column("label").to_numpy()
                    row = np.repeat(np.arange(len(u)), tables)
                    # labels and lengths never mix: they are part of the bucket
                    mixed = (k.view(np.uint64) ^ (label.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                                                 + np.uint64(d))[:, None]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(u))), pa.array(mixed.ravel()),
                        pa.array(label[row], pa.int64()), part.column("rep").take(pa.array(row)),
                        part.column("n").take(pa.array(row)),
                        pa.array([x.tobytes() for x in k], pa.binary()).take(pa.array(row)),
                        part.column("embedding").take(pa.array(row)),
                    ], names=["tab", "bucket", "label", "rep", "n", "keys", "embedding"])

    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.mapInArrow(run, f"tab int, bucket long, label long, rep long, n long, keys binary, embedding {kind}")


def _by_length(t: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Unit rows and bucket keys, rows of one vector length at a time."""
    lengths = pc.list_value_length(t.column("embedding")).to_numpy()
    for d in np.unique(lengths):
        p = t if (lengths == d).all() else t.filter(pa.array(lengths == d)).combine_chunks()
        k = np.frombuffer(b"".join(p.column("keys").to_pylist()), np.int64).reshape(p.num_rows, -1)
        yield p, unit_rows(matrix(p.column("embedding"))), k


def links_in_buckets(rows: DataFrame, min_cosine: float) -> DataFrame:
    """``a, b, links``: for a row with b = null, ``links`` more linked vectors of
    class a; else an edge of a spanning forest of the classes' links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEYS):
            for t, u, k in _by_length(table):
                tab, label, rep, n, own, ci, cj = (
                    t.column(c).to_numpy() for c in ("tab", "label", "rep", "n", "own", "cell_i", "cell_j"))
                starts = group_starts([t.column(c) for c in KEYS])
                sizes = np.diff(np.append(starts, len(rep)))
                count, a, b = np.zeros(len(rep), np.int64), [], []

                def check(i, j, cosine):
                    """Verified links among candidate rows i, j that meet here first and only here."""
                    ok = (cosine >= min_cosine) & (label[i] == label[j]) & ((ci[i] == cj[i]) | (own[i] != own[j]))
                    i, j = i[ok], j[ok]
                    first = np.argmax(k[i] == k[j], axis=1) == tab[i]
                    i, j = i[first], j[first]
                    np.add.at(count, i, n[j])
                    np.add.at(count, j, n[i])
                    p, q = forest(rep[i], rep[j])
                    a.append(p), b.append(q)

                for s, m in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
                    for at in range(s, s + m, TILE):
                        end = min(at + TILE, s + m)
                        cosine = u[at:end] @ u[at:s + m].T
                        i, j = np.nonzero(np.triu(cosine >= min_cosine, 1))
                        check(i + at, j + at, cosine[i, j])
                small = np.flatnonzero(np.repeat(sizes <= SMALL_GROUP, sizes))
                if len(small):
                    group = np.repeat(np.arange(len(starts)), sizes)[small]
                    for i, j in pairs_by_offset(group_starts([group]), len(small)):
                        i, j = small[i], small[j]
                        check(i, j, np.einsum("ij,ij->i", u[i], u[j]))
                some = np.flatnonzero(count)
                a, b = (np.concatenate([np.empty(0, np.int64), *v]) for v in (a, b))
                a, b = forest(a, b)
                if len(some) or len(a):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([rep[some], a])),
                        pa.array(np.concatenate([rep[some], b]), mask=np.arange(len(some) + len(b)) < len(some)),
                        pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]))], names=["a", "b", "links"])

    return rows.mapInArrow(run, "a long, b long, links long")


def with_label_numbers(rows: DataFrame) -> DataFrame:
    """``rows(id, label, ...)``, ids unique, with labels as longs: whole numbers
    as they are, other types by the smallest id under each label."""
    if isinstance(rows.schema["label"].dataType, T.IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    numbers = rows.groupBy("label").agg(F.min("id").cast("long").alias("number"))
    return rows.join(numbers, "label").drop("label").withColumnRenamed("number", "label").select("id", "label", "embedding")


def near_vectors(vectors: DataFrame, cuts: Cuts, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", min_cosine: float = 0.98, tables: int = TABLES, hashes: int = HASHES,
                 width: float = WIDTH, seed: int = 11) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    ``n_links`` counts the other vectors linked directly, equal ones included;
    ``component_id`` is the smallest id reachable by links. Null labels and null,
    empty, zero or non-finite vectors link with nothing and are components of
    their own; so are rows with a null id. Labels of any type that can be grouped are
    compared as they are. A repeated id counts once, with its
    smallest (label, vector). Only vectors of one length are compared. Other
    columns don't matter. Empty input: empty table.
    """
    ids = cuts.save(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                                   F.col(vector_col).alias("embedding")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = ids.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & is_finite_vector("embedding") & nonzero)
    usable = usable.groupBy("id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("id", "v.*")
    usable = with_label_numbers(usable)
    zero = F.lit(0).cast(ids.schema["embedding"].dataType.elementType)  # x + 0: -0.0 and 0.0 are one value
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + zero))
    classes = usable.groupBy("label", "embedding").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = cuts.save(classes.withColumn("class", F.xxhash64("label", "embedding")))
    rows = cuts.save(hashed_rows(classes.select("label", "rep", "n", "embedding"), tables, hashes, width, seed), keep=False)
    found = cuts.save(links_in_buckets(spread_blocks(cuts, rows, ["tab", "bucket"], "rep", BLOCK), min_cosine))
    roots = cuts.save(connected_components(found.filter("b IS NOT NULL").select("a", "b"), cuts))
    counts = cuts.save(found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links")))
    named = classes.select("rep", "n").join(roots, F.col("rep") == F.col("node"), "left")
    named = cuts.save(named.join(counts, F.col("rep") == F.col("a"), "left").select(
        "rep", F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    # each id's class: by its vector's smallest id, found again through the grouping key
    member = cuts.save(usable.select("id", "label", "embedding", F.xxhash64("label", "embedding").alias("class")))
    keyed = classes.select("class", F.col("label").alias("l"), F.col("embedding").alias("e"), "rep")
    member = cuts.save(member.join(keyed, "class").filter("label = l AND embedding = e").select("id", "rep"))
    member = cuts.save(member.join(named, "rep").select(F.col("id").alias("m"), "links", "root"))
    return ids.join(member, F.col("id") == F.col("m"), "left").select(
        "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("root", "id"), F.lit(True)).alias("kept"))
