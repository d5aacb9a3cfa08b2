"""Packing examples into sequences by vector bin packing.

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
It is filled by the dot-product rule (Panigrahy et al., 2011): of the waiting
examples that fit on all three counts, the one whose demand has the largest dot
product with what is left of the limits goes in, until none fits. Where cutting
is allowed, the largest waiting example then closes the gap and its rest waits
on; a sequence that can't be filled is split into sequences of a power of two,
so nothing is padded.

Packing needs no shuffle: each task packs the rows of its own input split, with
at most ``WAITING`` examples of under a sequence's length in memory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from featureflow.llm import bpe

WAITING = 1024
ID_BYTES = 4


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096


def fill(demand: np.ndarray, limits: np.ndarray) -> tuple[list[int], np.ndarray]:
    """One sequence: the chosen rows of ``demand`` (n x 3), in order, and what is
    left of ``limits``. Ties go to the earlier row."""
    left, scale = limits.astype(float), 1.0 / np.maximum(limits, 1).astype(float) ** 2
    waiting, chosen = np.ones(len(demand), bool), []
    while True:
        fits = waiting & (demand <= left).all(axis=1)
        if not fits.any():
            return chosen, left
        best = int(np.argmax(np.where(fits, demand @ (left * scale), -1.0)))
        chosen.append(best)
        waiting[best] = False
        left -= demand[best]


class Packer:
    """Packs a stream of examples. A piece is ``(key, start, ids, loss)`` with
    ``ids`` as bytes of ``ID_BYTES`` an id; ``loss`` is its loss-bearing tokens
    (the first ones)."""

    def __init__(self, limits: Limits, cut: bool, first_sequence: int = 0):
        self.limits, self.cut = limits, cut
        self.caps = np.array([limits.tokens, limits.segments, limits.loss])
        self.whole = min(limits.tokens, limits.loss)
        self.sequence = first_sequence
        self.waiting: list[tuple] = []

    def add(self, key, ids: bytes, loss: int) -> Iterator[tuple]:
        """Take an example; yields placed pieces ``(key, start, ids, sequence, offset)``."""
        start, size = 0, self.limits.tokens * ID_BYTES
        n = len(ids) // ID_BYTES
        if self.cut:
            while n - start >= self.limits.tokens and self.limits.loss >= self.limits.tokens:
                yield from self._emit([(key, start, ids[start * ID_BYTES:start * ID_BYTES + size])])
                start += self.limits.tokens
            loss = max(0, loss - start)
            while n - start > self.limits.tokens or loss > self.limits.loss:  # a lower limit on loss
                part = min(self.whole, n - start)
                self.waiting.append((key, start, ids[start * ID_BYTES:(start + part) * ID_BYTES], min(loss, part)))
                start, loss = start + part, max(0, loss - part)
        elif n > self.limits.tokens or loss > self.limits.loss:
            raise ValueError(f"example {key!r} has {n} tokens, {loss} with loss: more than a sequence holds")
        if start < n:
            self.waiting.append((key, start, ids[start * ID_BYTES:], loss))
        if len(self.waiting) >= WAITING:
            yield from self.pack(WAITING // 4)

    def pack(self, keep: int = 0) -> Iterator[tuple]:
        """Build sequences until at most ``keep`` examples wait."""
        while len(self.waiting) > keep:
            demand = np.array([(len(w[2]) // ID_BYTES, 1, w[3]) for w in self.waiting], float)
            while len(self.waiting) > keep:
                chosen, left = fill(demand, self.caps)
                out = [self.waiting[i] for i in chosen]
                gone = set(chosen)
                rest = [i for i in range(len(self.waiting)) if i not in gone]
                gap = int(left[0])
                if self.cut and gap and left[1] >= 1 and left[2] >= gap and rest:
                    i = max(rest, key=lambda r: demand[r, 0])
                    key, start, ids, loss = self.waiting[i]  # longer than the gap, or it would have fitted
                    out.append((key, start, ids[:gap * ID_BYTES], min(loss, gap)))
                    self.waiting[i] = (key, start + gap, ids[gap * ID_BYTES:], max(0, loss - gap))
                    demand[i] = (len(self.waiting[i][2]) // ID_BYTES, 1, self.waiting[i][3])
                self.waiting, demand = [self.waiting[i] for i in rest], demand[rest]
                yield from self._emit([p[:3] for p in out])

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        total = sum(len(p[2]) for p in pieces) // ID_BYTES
        sizes = [total]
        if self.cut and total < self.limits.tokens:
            sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        at, room = 0, sizes.pop(0)
        for key, start, ids in pieces:
            while ids:
                part = ids[:(room - at) * ID_BYTES]
                yield key, start, part, self.sequence, at
                n = len(part) // ID_BYTES
                ids, start, at = ids[len(part):], start + n, at + n
                if at == room:
                    self.sequence += 1
                    at, room = 0, sizes.pop(0) if sizes else 0


class TextIds:
    """Ids of texts from the tokenizers library, as little-endian unsigned
    32-bit bytes. Words never span blanks and repeat often, so the ids of words
    and of pieces between blanks seen lately are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), bpe.load(path)
        self.model, self.symbols = self.tokenizer.model, self.plain.symbols
        self.words_seen = bpe.Recent(self.word, bpe.CACHE_WORDS)
        self.pieces_seen = bpe.Recent(self.piece, bpe.CACHE_PIECES)

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """A normalised word goes to the library's merge model in byte symbols."""
        symbols = word if word.isascii() and word.isprintable() else "".join([self.symbols[b] for b in word.encode("utf-8")])
        ids = [t.id for t in self.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes:
        if self.plain.letters_are_words and piece.isascii() and piece.isalpha():
            return self.words_seen[piece.lower()]
        words = self.plain.split_words(piece)
        return self.encode(piece) if words is None else b"".join(map(self.words_seen.__getitem__, words))

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if bpe.SEPARATORS.search(text):
            return self.encode(text)
        return b"".join(map(self.pieces_seen.__getitem__, text.split()))


_IDS: dict[str, TextIds] = {}


def load(path: str) -> TextIds:
    if path not in _IDS:
        _IDS[path] = TextIds(path)
    return _IDS[path]


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
OUT_ROWS = 20_000


def pack_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = "word_bpe_49k.json",
               end_id: int = 2, limits: Limits = Limits()) -> DataFrame:
    """Tokenize whole texts, add ``end_id`` to each and pack them, cutting freely.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. Every id lies in one piece; the last id bears no
    loss. A null or empty text is the end id alone. Repeated rows are packed
    once each. ``sequence_id`` holds the input partition above its 33 low bits,
    so a retried task gives the same ids. An empty table gives no rows.
    """
    field = docs.schema[id_col]
    schema = T.StructType([T.StructField("doc_id", field.dataType), *T._parse_datatype_string(PIECES).fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = load(bpe.vocabulary(vocab))
        end = np.asarray([end_id], "<u4").tobytes()
        packer = Packer(limits, cut=True, first_sequence=TaskContext.get().partitionId() << 33)
        out: list[tuple] = []
        kind = pa.int64()

        def row(p):
            (doc, n), start, part, sequence, offset = p
            return doc, start, len(part) // ID_BYTES, zlib.crc32(part), n, sequence, offset

        def batch(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=names)

        for b in batches:
            kind = b.column(0).type
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                seq = ids.text(text.as_py()) + end
                n = len(seq) // ID_BYTES
                out.extend(map(row, packer.add((doc.as_py(), n), seq, n - 1)))
                if len(out) >= OUT_ROWS:
                    yield batch(out)
                    out = []
        out.extend(map(row, packer.pack()))
        if out:
            yield batch(out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pack_examples(examples: DataFrame, id_col: str, tokens_col: str, loss_col: str,
                  limits: Limits = Limits()) -> DataFrame:
    """Pack whole examples (say, conversations) by their token counts, uncut:
    ``id, tokens, sequence_id, offset``. Null counts are 0; an example that no
    sequence holds raises."""
    field = examples.schema[id_col]
    schema = T.StructType([T.StructField("id", field.dataType), *T._parse_datatype_string(
        "tokens long, sequence_id long, offset long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut=False, first_sequence=TaskContext.get().partitionId() << 33)
        for b in batches:
            placed = []
            for key, n, loss in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if n:
                    placed.extend(packer.add((key,), bytes(ID_BYTES * n), loss or 0))
                else:
                    placed.append(((key,), 0, b"", packer.sequence, 0))
            if placed:
                yield _placed(placed, b.column(0).type)
        if placed := list(packer.pack()):
            yield _placed(placed, examples_type)

    from pyspark.sql.pandas.types import to_arrow_type

    examples_type = to_arrow_type(field.dataType)
    return examples.select(id_col, tokens_col, loss_col).mapInArrow(run, schema)


def _placed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    keys, _, ids, sequence, offset = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], kind), pa.array([len(i) // ID_BYTES for i in ids], pa.int64()),
         pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=["id", "tokens", "sequence_id", "offset"])
