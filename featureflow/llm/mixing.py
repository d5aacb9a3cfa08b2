"""Mixing sources to target weights by systematic sampling.

Every document has an expected number of copies, its source's target over the
source's size. Within a source the documents stand in a fixed order; the
expected copies are summed along it, one random offset is added, and a copy is
emitted at each whole number that the sum crosses. So the number of copies of a
source is its expected number rounded, whatever the draw, and a document gets
its expected copies rounded up or down.

The order is by size class and then by a hash, so copies are also spread evenly
over the sizes and the words taken stay near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import Cuts, global_rank

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0
CELL_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(digits: int, *parts) -> Column:
    """The first hex digits, as a long, of the md5 of the parts joined with ':' (null: '-')."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) if isinstance(p, Column) else F.lit(str(p))
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Sixteen classes an octave: the length of size + 1 in bits, then its next four bits."""
    bits = F.length(F.bin(size + 1))
    next_bits = F.call_function("shiftright", size + 1, F.greatest(bits - 5, F.lit(0))).bitwiseAND(15)
    return (bits * 16 + next_bits).cast("int")


def source_targets(sizes: DataFrame, cuts: Cuts, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target)`` from one row per source.

    Sources in code-point order (null last) weigh ``weights``, repeating, and
    share the sum of all sizes. A target above ``max_repeat`` x its source's
    size stops there and the excess is shared again by weight among the others,
    until none is above. Only sums come to the driver, one job a round.
    """
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], "place", cuts)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = cuts.save(ranked.select("source", "source_size", w.alias("weight")))
    level, at_limit = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("source_size") * max_repeat < F.col("weight") * F.lit(level)
        total, fixed, open_weight, n = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("source_size") * max_repeat)),
            F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if not total or not open_weight or n == at_limit:
            break
        level, at_limit = (total - (fixed or 0.0)) / open_weight, n
    level = level or 0.0
    return ranked.select("source", "source_size", F.least(
        F.col("source_size") * F.lit(float(max_repeat)), F.col("weight") * F.lit(float(level))).alias("target"))


def mix(docs: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """One row per input row: ``doc_id, text_key, source, size, source_size, target,
    copies`` (``text_key``: a hash that tells texts under one id apart).

    ``copies`` is how often the mix takes the document. Null or blank text has
    size 0; such rows are taken like others and add no words. A null source is
    a source of its own. Rows that are alike in every way count as several
    documents and share out the copies of their places in any order. Empty
    input gives an empty table. Same rows, same result: the order and the
    offset come from hashes, not from the partitioning.
    """
    rows = cuts.save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                 word_count(F.col(text_col)).alias("size"),
                                 F.xxhash64(F.col(text_col)).alias("text_key"),
                                 draw(15, seed, F.col(id_col), F.md5(F.col(text_col))).alias("draw")))
    # the slices by draw only bound how many rows one window holds
    rows = rows.withColumn("size_class", size_class(F.col("size")))
    cells = rows.groupBy("source", "size_class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    cells = cuts.save(cells)
    largest = cells.agg(F.max("n")).first()[0] or 0
    slices = max(1, -(-largest // CELL_ROWS)) * 16
    targets = cuts.save(source_targets(
        cells.groupBy("source").agg(F.sum("s").alias("source_size")), cuts, weights, max_repeat))
    cell = ["source", "size_class", "slice"]
    rows = rows.withColumn("slice", F.pmod("draw", F.lit(slices)))
    per_cell = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    # a source has a bounded number of cells: size classes x slices
    before = Window.partitionBy("source").orderBy("size_class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    starts = starts.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        *[F.col(f"c.{k}") for k in cell], "rows_before", "source_size", "target")
    starts = cuts.save(starts)
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("draw", "doc_id", "size"))
    rows = rows.withColumn("place", place)
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in cell]
    r = rows.alias("r").join(starts.alias("c"), on).select(
        "r.doc_id", "r.text_key", "r.source", "r.size", "source_size", "target",
        (F.col("place") + F.col("rows_before")).alias("place"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = draw(12, seed, F.col("source")).cast("double") / float(16 ** 12)
    upto = F.floor(F.col("place") * rate + offset)
    return r.select("doc_id", "text_key", "source", "size", "source_size", "target",
                    (upto - F.floor((F.col("place") - 1) * rate + offset)).cast("long").alias("copies"))
