"""Periodic runs of words, found by recompression.

A run is a stretch of words with smallest period q (words q apart are equal)
that is at least ``exponent`` periods and ``least`` words long and can't be
extended. The texts of a batch become one sequence of word numbers. By
recompression (Jez, 2015) it is turned into a run-length grammar: block
compression replaces each stretch of one symbol by a new symbol, pair
compression splits the symbols into left and right ones and replaces each left
one followed by a right one; both alternate until the texts are a few symbols
long. Equal stretches are compressed alike but for their rims, so how far two
places agree (their longest common extension) takes one walk up the levels and
one down, a few steps a level (I, 2017). Walks are taken for many pairs of
places at once, forwards and backwards; there is no suffix array.

Which pairs: a run of period q and three periods or more covers a block of the
grid 0, q, 2q, ... that equals the next block. For all q together that are
n + n/2 + n/3 + ... pairs of neighbouring grid places. Pairs whose first words
differ can't be in a run and ask no extension; texts without a pair left need
no grammar.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAST, EXPONENT = 24, 3
GROUP_WORDS = 200_000
TOP_SYMBOLS = 6  # symbols a text at which compression ends
MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ the grammar

class Level(NamedTuple):
    """A sequence and how it was compressed into the next one. ``parent``: the
    next level's symbol; ``done``, ``left``: symbols of this one's parent before
    it, and from it on; ``first``: where each symbol of the next level begins."""

    symbol: np.ndarray
    block: bool
    parent: np.ndarray
    done: np.ndarray
    left: np.ndarray
    first: np.ndarray


def compressed(symbol: np.ndarray, starts: np.ndarray, names: np.ndarray, block: bool) -> tuple[Level, np.ndarray]:
    sizes = np.diff(np.append(starts, len(symbol))).astype(np.int32)
    first = starts.astype(np.int32)
    parent = np.repeat(np.arange(len(first), dtype=np.int32), sizes)
    done = np.arange(len(symbol), dtype=np.int32) - first[parent]
    return Level(symbol, block, parent, done, sizes[parent] - done, first), names


def block_round(symbol: np.ndarray, fresh: int) -> tuple[Level, np.ndarray, int] | None:
    """Stretches of one symbol become one symbol each; None if there are none."""
    new = np.empty(len(symbol), bool)
    new[0] = True
    np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
    if new.all():
        return None
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(symbol)))
    names, long = symbol[starts], sizes > 1
    codes, inverse = np.unique(names[long].astype(np.int64) * (int(sizes.max()) + 1) + sizes[long], return_inverse=True)
    names[long] = fresh + inverse
    return *compressed(symbol, starts, names, True), fresh + len(codes)


def pair_round(symbol: np.ndarray, fresh: int, marks: tuple[int, int], turn: int) -> tuple[Level, np.ndarray, int] | None:
    """Each left symbol and the right one after it become one symbol. Sides are
    drawn by a hash of the symbol's name and the round, and swapped if that
    makes more pairs. ``marks``: names that belong to no pair."""
    plain = (symbol < marks[0]) | (symbol >= marks[1])
    mixed = (symbol.astype(np.uint64) + np.uint64(turn << 40)) * MIX
    side = ((mixed ^ (mixed >> np.uint64(31))) * MIX) >> np.uint64(63) == 1
    inner = plain[:-1] & plain[1:]
    one, other = inner & ~side[:-1] & side[1:], inner & side[:-1] & ~side[1:]
    hit = np.flatnonzero(one if np.count_nonzero(one) >= np.count_nonzero(other) else other)
    if not len(hit):
        return None
    new = np.ones(len(symbol), bool)
    new[hit + 1] = False
    starts = np.flatnonzero(new)
    names = symbol[starts]
    codes, inverse = np.unique(symbol[hit].astype(np.int64) * fresh + symbol[hit + 1], return_inverse=True)
    names[np.searchsorted(starts, hit)] = fresh + inverse
    return *compressed(symbol, starts, names, False), fresh + len(codes)


def grammar(symbol: np.ndarray, marks: tuple[int, int]) -> tuple[list[Level], np.ndarray]:
    """The levels of a sequence of names and what is left at the top. ``marks``:
    the range of names that stand between texts, each once."""
    levels, fresh, turn = [], int(symbol.max()) + 1, 0
    texts = marks[1] - marks[0]
    symbol = symbol.astype(np.int32)
    while len(symbol) > (TOP_SYMBOLS + 1) * texts and turn < 200:
        for made in (block_round(symbol, fresh), None):
            made = made or pair_round(symbol, fresh, marks, turn)
            if made:
                level, symbol, fresh = made
                levels.append(level)
        turn += 1
    return levels, symbol


def extensions(levels: list[Level], top: np.ndarray, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from places ``x`` and ``y`` (x < y, one text) on,
    forwards (``step`` 1, x and y included) or backwards (-1)."""
    begin = x
    who, x, y = np.arange(len(x)), x.astype(np.int32), y.astype(np.int32)
    ended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lv in levels:
        before, after = (lv.done, lv.left) if step > 0 else (lv.left - 1, lv.done + 1)
        inside = np.flatnonzero((before[x] > 0) | (before[y] > 0))
        if len(inside):  # on to the parent's rim, unless the two differ before that
            a, b = x[inside], y[inside]
            n, m = after[a], after[b]
            equal = lv.symbol[a] == lv.symbol[b]
            go = np.where(equal, np.minimum(n, m), 0) * step
            x[inside], y[inside] = a + go, b + go
            stop = inside[~equal | (n != m)]
            ended.append((who[stop], x[stop], y[stop]))
            alive = np.ones(len(x), bool)
            alive[stop] = False
            who, x, y = who[alive], x[alive], y[alive]
        else:
            ended.append((who[:0], x[:0], y[:0]))
        x, y = lv.parent[x], lv.parent[y]
    alive = np.flatnonzero(top[x] == top[y])
    while len(alive):  # a few symbols a text
        x[alive] += step
        y[alive] += step
        alive = alive[top[x[alive]] == top[y[alive]]]
    for lv, (w, a, b) in zip(reversed(levels), reversed(ended), strict=True):
        if step > 0:
            x, y = lv.first[x], lv.first[y]
        else:
            ends = np.append(lv.first[1:], len(lv.symbol)) - 1
            x, y = ends[x].astype(np.int32), ends[y].astype(np.int32)
        after = lv.left if step > 0 else lv.done + 1
        go = np.where(lv.symbol[x] == lv.symbol[y], np.minimum(after[x], after[y]) if lv.block else 1, 0) * step
        who, x, y = np.concatenate([who, w]), np.concatenate([x + go, a]), np.concatenate([y + go, b])
    found = np.empty(len(begin), np.int64)
    found[who] = (x - begin[who]) * step
    return found


# ------------------------------------------------------------------ candidates and runs

def grid_pairs(symbol: np.ndarray, begin: np.ndarray, size: np.ndarray, low: int, least: int,
               exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, q) of the neighbouring grid places (place, place + q) that may lie
    in a run, for ``low`` <= q < 2 ``low``: their first words agree, and those q further on."""
    texts = np.flatnonzero(size >= max(least, exponent * low))
    most = size[texts] // exponent
    own = np.minimum(most, 2 * low - 1) - low + 1
    text = np.repeat(texts, own)
    q = low + np.arange(len(text)) - np.repeat(np.cumsum(own) - own, own)
    n = (size[text] - 1) // q - (exponent - 2)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    q, base = np.repeat(q, n), np.repeat(begin[text], n)
    place *= q
    place += base
    for far in (0, 1, None, 2):  # they agree for q + 1 words at least
        there = place + (q if far is None else np.minimum(far, q))
        ok = np.flatnonzero(symbol[there] == symbol[there + q])
        place, q = place[ok], q[ok]
    return place, q


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def find(symbol: np.ndarray, begin: np.ndarray, size: np.ndarray, marks: tuple[int, int], least: int = LEAST,
         exponent: int = EXPONENT) -> Runs:
    """All runs of a sequence of texts, each between two marks, by start and
    period. A multiple of a period finds the same stretch again: the smallest
    stays. Pairs inside a known run of a period that divides theirs are left out."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    levels = top = None
    cover_end, cover_q = None, None
    low = 1
    while (size >= max(least, exponent * low)).any():
        place, q = grid_pairs(symbol, begin, size, low, least, exponent)
        if cover_end is not None and len(place):
            known = cover_q[place]
            open_ = (known == 0) | (cover_end[place] < place + 2 * q) | (q % np.maximum(known, 1) != 0)
            place, q = place[open_], q[open_]
        if len(place):
            if levels is None:
                levels, top = grammar(symbol, marks)
            ahead = extensions(levels, top, place, place + q, 1)
            ok = ahead >= (exponent - 2) * q + 1
            place, q, ahead = place[ok], q[ok], ahead[ok]
            back = extensions(levels, top, place - 1, place + q - 1, -1)
            length = q + back + ahead
            ok = length >= np.maximum(least, exponent * q)
            start, length, q = (place - back)[ok], length[ok], q[ok]
            turn = np.lexsort((q, length, start))
            start, length, q = start[turn], length[turn], q[turn]
            new = np.ones(len(start), bool)
            new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
            start, length, q = start[new], length[new], q[new]
            if len(start):
                found.append((start, length, q))
                if cover_end is None:
                    cover_end, cover_q = np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64)
                for s, n, p in zip(start.tolist(), length.tolist(), q.tolist(), strict=True):
                    if cover_q[s] == 0 or cover_end[s] < s + n:
                        cover_end[s:s + n], cover_q[s:s + n] = s + n, p
        low *= 2
    if not found:
        return Runs(*(np.empty(0, np.int64) for _ in range(3)))
    start, length, q = (np.concatenate(c) for c in zip(*found, strict=True))
    turn = np.lexsort((q, length, start))
    start, length, q = start[turn], length[turn], q[turn]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    turn = np.lexsort((q, start))
    return Runs(start[turn], length[turn], q[turn])


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, int]]:
    """Words as numbers, a mark of its own before each text and after the last:
    (sequence, where each text begins, its words, range of the marks)."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size
    symbol = np.empty(int(size.sum()) + len(texts) + 1, np.int64)
    for b, n, words in zip(begin.tolist(), size.tolist(), texts, strict=True):
        symbol[b:b + n] = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    low = len(numbers)
    symbol[np.append(begin - 1, len(symbol) - 1)] = np.arange(low, low + len(texts) + 1)
    return symbol, begin, size, (low, low + len(texts) + 1)


def text_runs(texts: list[list[bytes]], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    symbol, begin, size, _ = numbered(texts)
    asked = np.zeros(len(texts), bool)  # texts with a pair that a run may hold
    low = 1
    while (size >= max(least, exponent * low)).any():
        place, _ = grid_pairs(symbol, begin, size, low, least, exponent)
        asked[np.searchsorted(begin, place, side="right") - 1] = True
        low *= 2
    few = np.flatnonzero(asked).tolist()
    if few:
        symbol, begin, size, marks = numbered([texts[i] for i in few])
        runs = find(symbol, begin, size, marks, least, exponent)
        text = np.searchsorted(begin, runs.start, side="right") - 1
        for t, s, n, q in zip(text.tolist(), (runs.start - begin[text]).tolist(), runs.length.tolist(),
                              runs.period.tolist(), strict=True):
            out[few[t]].append((s, n, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run has after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            edge[s + q] += 1
            edge[s + n] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


RUN_TYPE = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed",
              least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with the periodic runs of each text (array of start, length and
    period in words, by start and period) and the text without the words that
    repeat a run's first period, joined by single spaces.

    Words are what ASCII white space separates. Null and empty texts have no
    runs and collapse to ''. Each row stands alone, so repeated rows and ids get
    equal results. Other columns pass through; columns already called
    ``runs_col`` or ``collapsed_col`` are replaced. ``least`` is at least 2 and
    ``exponent`` at least 3. No shuffle; memory is some groups of
    ``GROUP_WORDS`` words, or one text."""
    if exponent < 3 or least < 2:
        raise ValueError("runs need at least three periods and two words")
    docs = docs.drop(runs_col, collapsed_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(runs_col, RUN_TYPE), T.StructField(collapsed_col, T.StringType())])
    at = docs.columns.index(text_col)
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at).cast(pa.binary())
            first, words, held = 0, [], 0
            for i, value in enumerate(text):
                words.append((value.as_py() or b"").split())
                held += len(words[-1])
                if held >= GROUP_WORDS or i == batch.num_rows - 1:
                    runs = text_runs(words, least, exponent)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(first, len(words)).columns,
                         pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], run_type),
                         pa.array([collapse(w, r).decode() for w, r in zip(words, runs, strict=True)], pa.string())],
                        names=schema.names)
                    first, words, held = i + 1, [], 0

    return docs.mapInArrow(run, schema)
