"""Removing repeated passages by merging Burrows-Wheeler transforms.

Each byte is removed that lies in a ``length``-byte string which also starts in
a document with a smaller id. Which strings are equal comes from suffix orders:
shards of text are sorted each on its own, and their Burrows-Wheeler transforms
are merged by iterative interleave refinement (Holt and McMillan, 2014). After h
rounds the merged order is right to h bytes and its blocks are the suffixes with
h bytes in common; after ``length`` rounds a block is an interval of equal
strings, without any suffix sorted again. The smallest document in the interval
is the one that keeps the string.

One merge over a whole corpus would be one task, so the strings are dealt first.
The smallest hash of the 16-byte grams of a 50-byte string depends on that
string alone: equal strings have equal keys. Neighbouring strings with one key
form a piece of text, and pieces of one key are merged together:

1. ``shared_keys``: which strings more than one document may have, in a Bloom
   filter. Its keys are the smallest hashes of 32-byte grams, made like the
   others: in a large corpus nearly every 16-byte gram stands somewhere else too,
   and a filter of those would let all text through, several times its size as
   pieces. It only spares later work; a full filter lets everything through.
2. ``pieces``: texts with such a string, equal pieces once, with the smallest
   and largest document.
3. ``first_holders``: pieces by key; the merge gives each string's smallest
   document. Keys with over ``KEY_PIECES`` pieces don't go into one task: their
   strings are grouped by a 128-bit hash instead.
4. ``repeats``: the results go back to all documents that hold the pieces; only
   pieces whose key has a result travel again.

Pieces overlap, so all of a corpus's pieces take about ``PIECES_BYTES`` times its
text. Equal strings have equal keys, so ranges of keys are independent: each goes
through the steps on its own (``part`` of ``parts``, by a hash of the key), and
only its runs of starts stay. A filter tells the strings of ``FILTER_TEXT`` bytes
apart; a larger corpus has a filter for each of several ranges. From the share of
strings that a filter lets through follows in how many parts its range is cut, so
that the pieces there at once take at most ``PIECES_AT_ONCE`` times the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import Cuts, group_starts, spare_name, whole_groups

LENGTH, GRAM, LONG_GRAM = 50, 16, 32
PIECE_STARTS = 64
KEY_PIECES = 2048
SHARDS, SHARD_BYTES = 4, 32 << 10  # what fits a core's cache
GROUP_BYTES = 64 << 10
BLOCK_BITS, BLOOM_HASHES = 512, 4
LEAST_BLOCKS, MOST_BLOCKS = 18, 20  # bits of a block's number: filters of 16 to 64 MB, by the input
BLOCKS_BYTES = 1 << 30  # text for which the smallest filter is meant
BUCKET_BYTES = 8 << 20
FILTER_TEXT = 8 << 30  # bytes of text for one filter
PIECES_BYTES = 4  # bytes of pieces, as shuffled, for a byte of text of which all is shared
PIECES_AT_ONCE = 0.6  # bytes of pieces at once for a byte of text
LEAST_PART = 32 << 20  # bytes of text from which on cutting into parts pays
MIX = np.uint64(0xD6E8FEB86659FD93)
BYTE_HASH = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)


# ------------------------------------------------------------------ keys of strings

def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def gram_minima(data: bytes, length: int, *grams: int) -> list[np.ndarray]:
    """For each size of ``grams`` (rising powers of 2) the smallest hash of the
    grams of the string at each start. Grams and minima are built by doubling, so
    the cost is a few passes."""
    h, w, factor, found = BYTE_HASH[np.frombuffer(data, np.uint8)], 1, int(MIX), []
    for gram in grams:
        while w < gram:
            h, w = h[:-w] * np.uint64(factor) + h[w:], 2 * w
            factor = factor * int(MIX) % 2 ** 64
        low = h ^ (h >> np.uint64(32))
        low *= MIX
        low ^= low >> np.uint64(29)
        v, most = 1, length - gram + 1
        while 2 * v <= most:
            low, v = np.minimum(low[:-v], low[v:]), 2 * v
        found.append(np.minimum(low[:v - most], low[most - v:]) if v < most else low)
    return found


class Runs(NamedTuple):
    """Runs of neighbouring starts with one key, in several joined texts."""

    text: np.ndarray  # number of the text
    begin: np.ndarray  # where that begins in the joined texts
    at: np.ndarray  # the first start, in the joined texts
    count: np.ndarray  # starts
    key: np.ndarray

    def of(self, some: np.ndarray) -> Runs:
        return Runs(*(c[some] for c in self))

    def meet(self, other: Runs) -> np.ndarray:
        """Which have a start in common with one of ``other``."""
        return np.searchsorted(other.at, self.at + self.count) > np.searchsorted(other.at + other.count, self.at, side="right")


def key_runs(texts: list[bytes], length: int, *grams: int) -> list[Runs]:
    """For each size of gram the runs of several texts in one pass. No string
    spans two texts. Long runs, of periodic text, are cut; where doesn't matter."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not (sizes >= length).any():
        return [Runs(*[np.empty(0, np.int64)] * 4, np.empty(0, np.uint64)) for _ in grams]
    return [runs_of(low, sizes, length) for low in gram_minima(b"".join(texts), length, *grams)]


def in_part(keys: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Whether a key is in a range; ``part`` of n is the parts k * ``part`` to
    k * ``part`` + k - 1 of k * n."""
    return (mix(keys) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32) == part


def runs_of(low: np.ndarray, sizes: np.ndarray, length: int) -> Runs:
    ends = np.cumsum(sizes)
    begins, starts = ends - sizes, np.maximum(sizes - length + 1, 0)
    new = np.empty(len(low), bool)
    new[0] = True
    np.not_equal(low[1:], low[:-1], out=new[1:])
    new[begins[starts > 0]] = True
    stops = begins + starts
    new[stops[stops < len(low)]] = True
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(low)))
    text = np.searchsorted(ends, at, side="right")
    inside = at - begins[text] < starts[text]
    at, count, text = at[inside], count[inside], text[inside]
    if count.max() > PIECE_STARTS:
        parts = -(-count // PIECE_STARTS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at, text = np.repeat(at, parts) + nth * PIECE_STARTS, np.repeat(text, parts)
        count = np.minimum(np.repeat(count, parts) - nth * PIECE_STARTS, PIECE_STARTS)
    return Runs(text, begins[text], at, count, mix(low[at]))  # minima are small numbers: spread them out again


def long_gram(length: int) -> int:
    """Size of the filter's grams."""
    return LONG_GRAM if length >= LONG_GRAM else GRAM


def in_groups(column, size: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a binary column, some at a time: (number of the first, texts)."""
    first, texts, held = 0, [], 0
    for i, value in enumerate(column):
        texts.append(value.as_py())
        held += len(texts[-1])
        if held >= size:
            yield first, texts
            first, texts, held = i + 1, [], 0
    if texts:
        yield first, texts


# ------------------------------------------------------------------ step 1: keys of more than one document

class Bloom(NamedTuple):
    """A blocked Bloom filter of keys: 2^``blocks`` blocks of ``BLOCK_BITS`` bits."""

    blocks: int
    data: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the filter; most keys fail the first bit and are done."""
        left = np.arange(len(keys))
        for j in range(BLOOM_HASHES):
            bit = bloom_bit(keys[left], j, self.blocks)
            left = left[(self.data[bit >> np.uint64(3)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1]
        found = np.zeros(len(keys), bool)
        found[left] = True
        return found


def bloom_bit(keys: np.ndarray, j: int, blocks: int) -> np.ndarray:
    """Number of each key's j-th bit: a block by its first bits, a bit in it by its last."""
    return (keys >> np.uint64(64 - blocks)) * np.uint64(BLOCK_BITS) + ((keys >> np.uint64(9 * j)) & np.uint64(BLOCK_BITS - 1))


def buckets_of(total: int) -> tuple[int, int]:
    """For that many bytes of text: bits of a bucket's number and of a filter's blocks."""
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, LEAST_BLOCKS + (total // BLOCKS_BYTES).bit_length()))
    return min(LEAST_BLOCKS, max(6, (total // BUCKET_BYTES).bit_length())), blocks


class Filled(NamedTuple):
    bloom: Bloom
    entries: int  # what went in
    alone: int  # keys that were there once


def filled(packed: DataFrame, bits: int, blocks: int, twice: bool) -> Filled:
    """The filter of the keys in ``packed(bucket, keys, more)``; ``twice``: of those
    that are there more than once. ``more``: entries left out, of keys that are.
    Each bucket, a range of keys, fills its own part."""
    size = BLOCK_BITS << blocks >> bits

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["bucket"]):
            bucket, column, more = t.column("bucket").to_numpy(), t.column("keys"), t.column("more").to_numpy()
            for s, e in zip(starts := group_starts([bucket]), [*starts[1:], len(bucket)], strict=True):
                keys = np.frombuffer(b"".join(column.slice(s, e - s).to_pylist()), np.uint64)
                entries, alone = len(keys) + int(more[s:e].sum()), 0
                if twice:
                    keys = np.sort(keys)
                    first = np.append(True, keys[1:] != keys[:-1])
                    alone = np.count_nonzero(first & np.append(first[1:], True))
                    keys = keys[~first]
                flags = np.zeros(size, bool)
                for j in range(BLOOM_HASHES):
                    flags[bloom_bit(keys, j, blocks) - np.uint64(int(bucket[s]) * size)] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[s]], pa.int32()), pa.array([np.packbits(flags).tobytes() if len(keys) else b""], pa.binary()),
                     pa.array([entries]), pa.array([alone], pa.int64())], names=["bucket", "part", "entries", "alone"])

    parts = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        fill, "bucket int, part binary, entries long, alone long")
    data, entries, alone = np.zeros((BLOCK_BITS << blocks) // 8, np.uint8), 0, 0
    for r in parts.collect():  # the filter's 16 to 64 MB
        entries, alone = entries + r.entries, alone + r.alone
        if r.part:
            data[r.bucket * size // 8:(r.bucket + 1) * size // 8] = np.frombuffer(bytes(r.part), np.uint8)
    return Filled(Bloom(blocks, data), entries, alone)


PACKED = "bucket int, keys binary, more long"


def pack_keys(keys: np.ndarray, bits: int, more: int = 0) -> pa.RecordBatch:
    """A row of packed keys for each bucket, for sorted keys; ``more`` in the first."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
    starts = group_starts([bucket]) if len(keys) else np.empty(0, np.int64)
    ends = [*starts[1:], len(keys)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts], pa.int32()),
         pa.array([keys[s:e].tobytes() for s, e in zip(starts, ends, strict=False)], pa.binary()),
         pa.array(np.where(np.arange(len(starts)) == 0, more, 0), pa.int64())], names=["bucket", "keys", "more"])


def shared_keys(docs: DataFrame, length: int, total: int, part: int = 0, parts: int = 1) -> Filled:
    """The filter of long keys that two or more of ``docs(id, text_key, data)``, ``total``
    bytes, have where their key is in the range. Keys travel packed, by range, and from
    a batch each key twice at most, so one that very many documents have is a few entries."""
    bits, blocks = buckets_of(total // parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.empty(0, np.uint64)]
            for _, texts in in_groups(b.column("data")):
                if parts > 1:
                    runs, long = key_runs(texts, length, GRAM, long_gram(length))
                    long = long.of(long.meet(runs.of(in_part(runs.key, part, parts))))
                else:
                    long, = key_runs(texts, length, long_gram(length))
                text, keys = long.text, long.key
                turn = np.lexsort((keys, text))  # each key of a text once
                text, keys = text[turn], keys[turn]
                own.append(keys[group_starts([text, keys])] if len(keys) else keys)
            keys = np.sort(np.concatenate(own))
            keep = np.ones(len(keys), bool)
            keep[2:] = keys[2:] != keys[:-2]
            yield pack_keys(keys[keep], bits, len(keys) - np.count_nonzero(keep))

    return filled(docs.select("data").mapInArrow(pack, PACKED), bits, blocks, True)


def holder_keys(holders: DataFrame, total: int) -> Bloom:
    """The filter of the keys that have a result."""
    bits, blocks = buckets_of(total)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pack_keys(np.unique(b.column("key").to_numpy().view(np.uint64)), bits)

    return filled(holders.select("key").mapInArrow(pack, PACKED), bits, blocks, False).bloom


def parts_of(shared: Filled, total: int, ranges: int) -> int:
    """In how many parts a range goes: a piece is there if one of its long keys, about
    three, is shared or taken for such a one."""
    ones = sum(int(np.bitwise_count(x).sum(dtype=np.int64)) for x in np.array_split(shared.bloom.data, 64))
    wrong = (ones / (BLOCK_BITS << shared.bloom.blocks)) ** BLOOM_HASHES
    there = 1 - shared.alone / max(1, shared.entries) * (1 - wrong) ** 3
    return max(1, min(math.ceil(PIECES_BYTES * there / PIECES_AT_ONCE / ranges), total // LEAST_PART))


# ------------------------------------------------------------------ step 2: pieces of texts

def piece_rows(docs: DataFrame, bloom, length: int, with_text: bool, part: int = 0, parts: int = 1) -> DataFrame:
    """The pieces, of keys in the range, with a shared string: ``key, id, piece``, or for the way back those
    with a result's key: ``key, id, text_key, start, hash`` (``hash``: Spark's xxhash64 of the piece)."""
    names = ["key", "id", "piece"] if with_text else ["key", "id", "text_key", "start", "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = bloom.value
        for b in batches:
            cols: list[list] = [[] for _ in names]
            held = 0
            ids, text_keys = b.column("id").to_numpy(), b.column("text_key").to_numpy()
            for first, texts in in_groups(b.column("data")):
                if with_text:
                    runs, long = key_runs(texts, length, GRAM, long_gram(length))
                    runs = runs.of(in_part(runs.key, part, parts) & runs.meet(long.of(shared.has(long.key))))
                else:
                    runs, = key_runs(texts, length, GRAM)
                    runs = runs.of(in_part(runs.key, part, parts))
                    runs = runs.of(shared.has(runs.key))
                text, start, keys = runs.text, runs.at - runs.begin, runs.key
                end = start + runs.count + (length - 1)
                cut = [texts[t][s:e] for t, s, e in zip(text.tolist(), start.tolist(), end.tolist(), strict=True)]
                cols[0].append(keys.view(np.int64))
                cols[1].append(ids[first + text])
                if with_text:
                    cols[2] += cut
                else:
                    cols[2].append(text_keys[first + text])
                    cols[3].append(start)
                    cols[4].append(hashes(cut))
                held += len(cut)
                if held > 100_000:
                    yield batch(cols)
                    cols, held = [[] for _ in names], 0
            if held:
                yield batch(cols)

    def batch(cols):
        numbers = 2 if with_text else 5
        arrays = [pa.array(np.concatenate(c)) for c in cols[:numbers]]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(c, pa.binary()) for c in cols[numbers:]], names=names)

    schema = "key long, id long, piece binary" if with_text else "key long, id long, text_key long, start long, hash long"
    return docs.select("id", "text_key", "data").mapInArrow(run, schema)


def hashes(pieces: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of each piece."""
    return np.fromiter((xxhash.xxh64_intdigest(p, 42) for p in pieces), np.uint64, len(pieces)).view(np.int64)


# ------------------------------------------------------------------ step 3: merging transforms

def by_key(key: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``at`` (numbers of ``bits`` bits) by ``key`` and then by themselves, and their
    keys. Both in one number, unless a shard is too long, sort several times faster."""
    if 3 * bits > 63:
        turn = np.lexsort((at, key))
        return at[turn], key[turn]
    both = (key << bits) | at
    both.sort()
    return both & ((1 << bits) - 1), both >> bits


def shard_transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of a shard's strings (each ends with a mark smaller than all
    bytes; equal suffixes by string number): the positions in the joined text,
    the byte before each suffix (0: a string begins), and the place of the
    suffix one byte longer (a whole string: of its mark)."""
    sizes = np.array([len(s) + 1 for s in strings])
    marks = np.cumsum(sizes) - 1
    text = np.zeros(marks[-1] + 1, np.uint16)
    inside = np.ones(len(text), bool)
    inside[marks] = False
    text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    n = len(text)
    # as many characters as fit beside a position to begin with, then twice as many a round
    # for the suffixes still equal to another; a rank is the first place of equal ones
    present = np.bincount(text, minlength=257) > 0
    letters = (np.cumsum(present) - 1)[text]
    bits, width = n.bit_length(), max(1, int(present.sum() - 1).bit_length())
    w = (63 - bits) // width
    key, alive, padded = np.zeros(n, np.int64), np.ones(n, bool), np.append(letters, np.zeros(w, np.int64))
    for j in range(w):
        c = padded[j:j + n] * alive
        key = (key << width) | c
        alive &= c > 0
    order, key = by_key(key, np.arange(n), bits)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | ~alive[order[1:]]  # a suffix that has reached its mark is like no other
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(starts, append=n))
    while len(at := np.flatnonzero(~(new & np.append(new[1:], True)))):
        some = order[at]
        some, key = by_key(rank[some] * n + rank[some + w], some, bits)
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(first)
        order[at], new[at], w = some, first, 2 * w
        rank[some] = np.repeat(at[starts], np.diff(starts, append=len(at)))
    first = np.zeros(n, bool)
    first[marks - sizes + 1] = True
    before = np.where(first, 0, np.roll(text, 1))
    longer = np.roll(rank, 1)
    longer[first] = rank[marks]  # string by string, as both are in order
    return order, before[order], longer[order]


def merge_transforms(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], places: np.ndarray, depth: int):
    """The suffixes ``depth`` bytes longer than those at ``places`` of the joined
    shards, in an order right to ``depth`` bytes, and the number of each one's
    block (suffixes with ``depth`` bytes in common). Only suffixes that become
    one of these are carried along, and those alone in their block are left out
    as soon as they are: a round splits blocks and never joins any. A round goes
    two bytes back at once: it sorts by a pair of bytes."""
    at = np.cumsum([0, *[len(s[0]) for s in shards]])
    before = (np.concatenate([s[1] for s in shards]) - 1).astype(np.uint8)  # no suffix carried goes past its string
    longer = np.concatenate([s[2] + a for s, a in zip(shards, at, strict=False)]).astype(np.int32)
    order, block = places.astype(np.int32), np.zeros(len(places), np.int32)

    def refine(key, longer):
        nonlocal order, block
        key = key[order]
        turn = np.argsort(key, kind="stable")  # by radix
        key, block, order = key[turn], block[turn], longer[order[turn]]
        new = np.ones(len(order) + 1, bool)
        new[1:-1] = (block[1:] != block[:-1]) | (key[1:] != key[:-1])
        block = np.cumsum(new[:-1], dtype=np.int32)
        alone = new[:-1] & new[1:]
        if 8 * np.count_nonzero(alone) > len(alone):
            order, block = order[~alone], block[~alone]

    if depth % 2:
        refine(before, longer)
    if depth > 1:
        # the byte before the byte before, and the byte before
        pair, twice = before[longer].astype(np.uint16) << 8 | before, longer[longer]
        for _ in range(depth // 2):
            refine(pair, twice)
    return order, block


def smallest_holders(strings: list[bytes], holder: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each string, for each of its starts: the smallest ``holder`` of a
    string in which the same ``length`` bytes stand."""
    low, begin = holders_by_byte(strings, holder, length)
    return [low[b:b + len(s) - length + 1] for b, s in zip(begin.tolist(), strings, strict=True)]


def holders_by_byte(strings: list[bytes], holder: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The same as one array over the joined strings (each with its mark; of use at
    starts only), and where each string begins in it."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    begin = np.cumsum(sizes) - sizes
    target = max(1, min(SHARD_BYTES, int(sizes.sum()) // SHARDS))
    cuts = np.flatnonzero(np.diff(begin // target)) + 1
    edges = [0, *cuts.tolist(), len(strings)]
    parts = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]
    shards = [shard_transform(strings[a:b]) for a, b in parts]
    at = np.cumsum([0, *[len(s[0]) for s in shards]])
    place = np.concatenate([s[0] + a for s, a in zip(shards, at, strict=False)])  # place in the order -> text position
    inside = np.arange(len(place)) - np.repeat(begin, sizes)
    order, block = merge_transforms(shards, np.flatnonzero((inside >= length)[place]), length)
    low = np.repeat(holder, sizes)  # shards hold the strings in turn; a string that stands nowhere else is its own
    if len(order):
        position, starts = place[order], group_starts([block])
        low[position] = np.repeat(np.minimum.reduceat(low[position], starts), np.diff(np.append(starts, len(block))))
    return low, begin


RESULT = ["key", "hash", "offset", "count", "holder"]
RESULT_SCHEMA = "key long, hash long, offset long, count long, holder long"


def merged_holders(pieces: DataFrame, length: int) -> DataFrame:
    """``key, hash, offset, count, holder``: runs of starts of a piece and the
    smallest document with their strings, where a larger one holds the piece.
    ``pieces``: sorted by key within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key"]):
            key, low, high = (t.column(c).to_numpy() for c in ("key", "low", "high"))
            text = t.column("piece").to_pylist()
            hash_ = hashes(text)
            starts = group_starts([key])
            sizes = np.diff(np.append(starts, len(key)))
            alone = np.flatnonzero(np.repeat(sizes == 1, sizes) & (low < high))
            out = [(key[alone], hash_[alone], np.zeros(len(alone), np.int64),
                    np.array([len(text[i]) - length + 1 for i in alone], np.int64), low[alone])]
            rows: list[int] = []
            size = 0

            def merge(rows):
                rows = np.array(rows)
                found, begin = holders_by_byte([text[i] for i in rows], low[rows], length)
                count = np.diff(np.append(begin, len(found))) - length  # starts of each string
                owner = np.repeat(np.arange(len(rows)), count)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                found = found[begin[owner] + offset]
                s = group_starts([owner, found])  # runs of starts of one string with one holder
                n = np.diff(np.append(s, len(owner)))
                ok = found[s] < high[rows[owner[s]]]
                s, n = s[ok], n[ok]
                row = rows[owner[s]]
                out.append((key[row], hash_[row], offset[s], n, found[s]))

            for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                rows += range(s, s + n)
                size += sum(len(text[i]) for i in range(s, s + n))
                if size >= SHARDS * SHARD_BYTES:
                    merge(rows)
                    rows, size = [], 0
            if rows:
                merge(rows)
            cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=RESULT)

    return pieces.mapInArrow(run, RESULT_SCHEMA)


def grouped_holders(pieces: DataFrame, length: int, cuts: Cuts) -> DataFrame:
    """The same for keys with too many pieces for a task: each string is a row,
    grouped by a 128-bit hash (partial aggregation, joins AQE can split)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                text = b.column("piece").to_pylist()
                n = np.array([len(t) - length + 1 for t in text])
                both = [xxhash.xxh128_digest(t[i:i + length]) for t, m in zip(text, n, strict=True) for i in range(m)]
                two = np.frombuffer(b"".join(both), np.int64).reshape(-1, 2)
                rest = [np.repeat(b.column(c).to_numpy(), n) for c in ("low", "key", "hash", "high")]
                offset = np.concatenate([np.arange(m) for m in n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (two[:, 0].copy(), two[:, 1].copy(), *rest, offset)],
                    names=["s1", "s2", "low", "key", "hash", "high", "offset"])

    pieces = pieces.withColumn("hash", F.xxhash64("piece"))
    rows = cuts.save(pieces.mapInArrow(run, "s1 long, s2 long, low long, key long, hash long, high long, offset long"), keep=False)
    least = cuts.save(rows.groupBy("s1", "s2").agg(F.min("low").alias("holder")), keep=False)
    return rows.join(least, ["s1", "s2"]).filter("holder < high").select(
        "key", "hash", "offset", F.lit(1).cast("long").alias("count"), "holder")


def first_holders(pieces: DataFrame, length: int, cuts: Cuts) -> DataFrame:
    hot = cuts.save(pieces.groupBy("key").count().filter(F.col("count") > KEY_PIECES).select("key"), keep=False)
    usual = pieces.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    found = merged_holders(usual, length)
    if not hot.isEmpty():
        found = found.unionByName(grouped_holders(pieces.join(hot, "key", "left_semi"), length, cuts))
    return found


# ------------------------------------------------------------------ step 4: back to the documents

def repeats(docs: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, text_key, starts, counts``: for each document with a repeated
    string, the runs of starts of such strings. Rows with a null id neither
    lose bytes nor make others lose any; a null text is empty. Rows under one id
    don't count as repeats of each other."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"), data.alias("data"))
    d = d.filter(F.col("id").isNotNull() & (F.octet_length("data") >= length))
    total = d.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    ranges = -(-total // FILTER_TEXT) or 1
    with Cuts(docs.sparkSession) as done:
        found = [runs for k in range(ranges) for runs in repeats_of_range(d, done, length, total, k, ranges)]
        if len(found) == 1:
            return cuts.save(found[0])
        runs = reduce(DataFrame.unionByName, found).groupBy("id", "text_key").agg(F.collect_list(F.struct("starts", "counts")).alias("runs"))
        return cuts.save(runs.select("id", "text_key", F.flatten("runs.starts").alias("starts"), F.flatten("runs.counts").alias("counts")))


def repeats_of_range(d: DataFrame, done: Cuts, length: int, total: int, k: int, ranges: int) -> Iterator[DataFrame]:
    """The result for the keys of a range, in parts; of each part nothing else stays."""
    spark = d.sparkSession
    shared = shared_keys(d, length, total, k, ranges)
    n = parts_of(shared, total, ranges)
    bloom = spark.sparkContext.broadcast(shared.bloom)
    del shared
    for part in range(k * n, k * n + n):
        done.free()
        with Cuts(spark) as cuts:
            with Cuts(spark) as before:
                pieces = piece_rows(d, bloom, length, True, part, ranges * n).groupBy("key", "piece").agg(
                    F.min("id").alias("low"), F.max("id").alias("high"))
                pieces = before.save(pieces, keep=False)
                before.free()
                holders = cuts.save(first_holders(pieces, length, before), keep=False)
            cuts.free()
            if part == k * n + n - 1:
                bloom.destroy()
            way_back = spark.sparkContext.broadcast(holder_keys(holders, total // (ranges * n)))
            held = piece_rows(d, way_back, length, False, part, ranges * n).join(holders, ["key", "hash"]).filter("holder < id")
            runs = held.groupBy("id", "text_key").agg(
                F.collect_set(F.struct((F.col("start") + F.col("offset")).alias("start"), "count")).alias("runs"))
            runs = done.save(runs.select("id", "text_key", F.col("runs.start").alias("starts"), F.col("runs.count").alias("counts")), keep=False)
            way_back.destroy()
        yield runs
    done.free()


def removed_spans(n: int, starts: list[int], counts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal spans [a, b) of the bytes that strings at these starts cover."""
    spans: list[tuple[int, int]] = []
    for a, c in sorted(zip(starts, counts, strict=True)):
        b = min(n, a + c + length - 1)
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def cut_repeats(docs: DataFrame, cuts: Cuts, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                kept_col: str = "kept", spans_col: str = "spans", as_text: bool = False) -> DataFrame:
    """``docs`` with the bytes kept of each text and the spans removed (array of
    start, end). Null texts keep b''. ``as_text``: the kept bytes as a string;
    what a cut leaves of a character goes too. Other columns pass through;
    columns already called ``kept_col`` or ``spans_col`` are replaced. One row
    per input row; an empty table gives an empty table."""
    docs = docs.drop(kept_col, spans_col)
    found = repeats(docs, cuts, id_col, text_col, length)
    a, b = spare_name(docs, "starts_"), spare_name(docs, "counts_")
    found = found.select(F.col("id").alias("found_id_"), F.col("text_key").alias("found_key_"),
                         F.col("starts").alias(a), F.col("counts").alias(b))
    joined = docs.join(found, (docs[id_col].cast("long") == found.found_id_) & (
        F.xxhash64(docs[text_col]) == found.found_key_), "left").select(*[docs[c] for c in docs.columns], a, b)
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(kept_col, T.StringType() if as_text else T.BinaryType()),
                           T.StructField(spans_col, spans)])
    at, width = docs.columns.index(text_col), len(docs.columns)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone = [], []
            text = batch.column(at).cast(pa.binary())
            for t, s, c in zip(text, batch.column(width), batch.column(width + 1), strict=True):
                data = t.as_py() or b""
                cut = removed_spans(len(data), s.as_py(), c.as_py(), length) if s.is_valid else []
                edges = [0, *[e for span in cut for e in span], len(data)]
                rest = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                gone.append([{"start": x, "end": y} for x, y in cut])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(gone, span_type)], names=schema.names)

    return joined.mapInArrow(run, schema)
