"""SimHash near-duplicates by a range join on segment popcounts.

A 64-bit fingerprint is cut into segments of two bits and mapped to the number
of set bits in each: a point of the grid {0, 1, 2}^32. The Manhattan distance of
two points is at most the Hamming distance of their fingerprints, so a range
join on the grid finds every pair within ``max_bits``, and the exact distance
decides.

The join: of two halves of 16 segments, one has a Manhattan distance of at most
half the bound. On the grid, two points within 2 r of each other have a common
grid point within r of both, so each half point goes into the cells of its ball
of radius r = max_bits / 4 and pairs meet by equal cells.

Fingerprints are joined once each, whatever their copies. A cell's pairs are
verified in numpy, and only a spanning forest of the links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
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

BLOCK = 2048
SMALL_GROUP = 96


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Bit i is set if it is set in over half of the XXH64 hashes of the
    shingles of ``shingle`` words (A-Z lower-cased, joined by one space; all
    words if there are fewer). No words: 0."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(line[a:b - 1], seed) for a, b in zip([0, *ends], ends[k - 1:], strict=False)),
                         np.uint64, len(words) - k + 1)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` without the text, with ``fp`` (the fingerprint as a signed long)."""
    out = T.StructType([*[f for f in docs.schema.fields if f.name != text_col], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            fp = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in b.column(at)), np.uint64, b.num_rows)
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in rest], pa.array(fp.view(np.int64))],
                                             names=[*[b.schema.names[i] for i in rest], "fp"])

    return docs.mapInArrow(run, out)


def popcounts(fp: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, kept in its two bits."""
    low = np.uint64(0x5555555555555555)
    return (fp & low) + ((fp >> np.uint64(1)) & low)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits (of signed longs: numpy counts the bits of their absolute value otherwise)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def half_cells(half: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, cell) for the grid cells within ``radius`` of each half point."""
    rows, cells, last = np.arange(len(half)), half, np.full(len(half), -1)
    yield rows, cells
    # one step per segment and sign, segments in rising order (a segment may step on in the same direction)
    steps = [(rows, cells, last, np.zeros(len(half), np.int8))]
    for _ in range(radius):
        grown = []
        for r, c, seg, sign in steps:
            for j in range(16):
                value = (c >> np.uint64(2 * j)) & np.uint64(3)
                for up, allowed in ((1, value < 2), (-1, value > 0)):
                    ok = allowed & ((seg < j) | ((seg == j) & (sign == up)))
                    if ok.any():
                        one = np.uint64(1 << (2 * j))
                        moved = c[ok] + one if up == 1 else c[ok] - one
                        grown.append((r[ok], moved, np.full(ok.sum(), j), np.full(ok.sum(), up, np.int8)))
        for r, c, *_ in grown:
            yield r, c
        steps = grown


def grid_rows(fps: DataFrame, max_bits: int) -> DataFrame:
    """``cell, fp``: each fingerprint in every grid cell it can meet others in."""
    radius = -(-(max_bits // 2) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            p = popcounts(fp.view(np.uint64))
            for side in (0, 1):
                half = (p >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
                tag = np.int64(side) << np.int64(40)
                found = list(half_cells(half, radius))
                rows, cells = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.astype(np.int64) | tag), pa.array(fp[rows])], names=["cell", "fp"])

    return fps.select("fp").mapInArrow(run, "cell long, fp long")


def links_in_cells(rows: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: a spanning forest of the links found among each task's cells."""
    keys = ["cell", "cell_i", "cell_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            fp = t.column("fp").to_numpy()
            starts = group_starts([t.column(k) for k in keys])
            sizes = np.diff(np.append(starts, len(fp)))
            a, b = [], []
            for s, n in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
                x = np.unique(fp[s:s + n])
                for at in range(0, len(x), 512):
                    near = distance(x[at:at + 512, None], x[None, :]) <= max_bits
                    i, j = np.nonzero(near)
                    p, q = forest(x[i + at], x[j])
                    a.append(p), b.append(q)
            small = np.repeat(sizes <= SMALL_GROUP, sizes)
            group = np.repeat(np.arange(len(starts)), sizes)[small]
            x = fp[small]
            for i, j in pairs_by_offset(group_starts([group]), len(x)) if len(x) else ():
                near = distance(x[i], x[j]) <= max_bits
                a.append(x[i[near]]), b.append(x[j[near]])
            a, b = (np.concatenate([np.empty(0, np.int64), *v]) for v in (a, b))
            a, b = forest(a, b)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, seed: int = 42, text_key: bool = False) -> DataFrame:
    """One row per input row: ``id, fp, component_id``, and with ``text_key``
    also the xxhash64 of the text by that name.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id reachable by links (ids that are null
    are passed over; null if all are). Null, empty and blank texts have
    fingerprint 0 and link like any other. Equal rows are in one component.
    Other columns of ``docs`` don't matter. Empty input: empty table.
    """
    key = [F.xxhash64(text_col).alias("text_key")] if text_key else []
    ids = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text_"), *key)
    prints = cuts.save(with_fingerprint(ids, "text_", shingle, seed))
    classes = cuts.save(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    rows = cuts.save(grid_rows(classes, max_bits), keep=False)
    links = links_in_cells(spread_blocks(cuts, rows, ["cell"], "fp", BLOCK), max_bits)
    roots = cuts.save(connected_components(links, cuts))
    joined = cuts.save(classes.join(roots, classes.fp == roots.node, "left")
                       .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    lowest = cuts.save(joined.groupBy("root").agg(F.min("rep").alias("component_id")))
    named = cuts.save(joined.join(lowest, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("id", "fp", "component_id", *(["text_key"] if text_key else []))
