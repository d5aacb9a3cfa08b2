"""Token counts by byte-pair merging with a heap and a linked list.

The number of tokens of a word is its number of initial symbols minus the
merges that apply, so no identifiers are made. The merges of a word: put every
adjacent pair that has a rank into a heap, pop the lowest rank (leftmost first),
join the two symbols in a linked list, push the two new pairs, and skip entries
whose symbols have changed. That is O(n log n) for a word of n symbols, also
for a text of a megabyte without a blank.

Words never span white space, so a text's count is the sum over its pieces
between blanks; the counts of pieces seen lately are kept in a bounded table.
"""

from __future__ import annotations

import heapq
import json
import re
import string
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Pieces, and words, whose results a worker keeps (about 200 bytes each).
CACHE_PIECES, CACHE_WORDS = 1_000_000, 500_000
#: Longer ones are worked out anew each time.
CACHE_CHARS = 64
#: Control characters that str.split() takes for blanks and the tokenizer doesn't.
SEPARATORS = regex.compile("[\x1c-\x1f]")
BLANKS = regex.compile(r"\s+")
#: Sigma without the final-sigma rule, and letters newer than Python's tables.
LOWER = {ord("Σ"): "σ", 0xA7CB: "\u0264", 0xA7DC: "\u019b"}
LOWER |= {c: chr(c + 1) for c in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
LOWER |= {c: chr(c + 0x20) for c in range(0x10D50, 0x10D66)} | {c: chr(c + 0x1B) for c in range(0x16EA0, 0x16EB9)}
#: Letters and numbers that ``regex`` knows of later Unicode versions than the tokenizer's tables, to
#: which they are symbols.
LATER = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3
16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6
1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4
1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f""".split()
LATER = "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in LATER)
LATER, ODD, SYMBOL = regex.compile(f"[{LATER}]"), regex.compile(f"[{''.join(map(chr, LOWER))}{LATER}]"), "\uffff"
#: Told at once of most pieces: whether they can hold one of them.
PERHAPS_ODD = re.compile("[Σ\u0558-\U0010ffff]")


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many pairs of ``symbols`` merge, lowest rank first, leftmost of equals."""
    n = len(symbols)
    if n < 2:
        return 0
    sym: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merged = 0
    while heap:
        rank, i = heapq.heappop(heap)
        left = sym[i]
        j = after[i]
        if left is None or j >= n or ranks.get((left, sym[j])) != rank:
            continue  # one of its symbols has merged meanwhile
        sym[i], sym[j] = left + sym[j], None
        merged += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i))
        p = before[i]
        if p >= 0 and (r := ranks.get((sym[p], sym[i]))) is not None:
            heapq.heappush(heap, (r, p))
    return merged


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the other bytes for the
    characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in set(own) else next(rest)) for b in range(256)]


class Recent(dict):
    """Results of ``make(text)`` for the texts seen lately: a young table, and
    the one before it, from which texts seen again move up. Frequent texts stay;
    at most ``size`` are held."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.half, self.old = make, size // 2, {}

    def __missing__(self, text: str):
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
            if len(text) > CACHE_CHARS:
                return found
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[text] = found
        return found


class WordBpe:
    """Token counts for a tokenizer file with word ends (lower case, NFC)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"] or ""
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.symbols = byte_symbols()
        letters = string.ascii_lowercase
        #: Whether a run of ASCII letters is one word and no special string.
        self.letters_are_words = self.words.findall(letters) == [letters] and not any(
            t.isascii() and t.isalpha() for t in specials)
        self.words_seen = Recent(self.word, CACHE_WORDS)
        self.pieces_seen = Recent(self.piece, CACHE_PIECES)

    def word(self, word: str) -> int:
        symbols = [self.symbols[b] for b in word.encode("utf-8")]
        symbols[-1] += self.end
        return len(symbols) - merges_of(symbols, self.ranks)

    def split_words(self, piece: str) -> list[str] | None:
        """The words of a text, normalised; None if it holds a special string."""
        if self.specials is not None and self.specials.search(piece):
            return None
        if piece.isascii():
            return self.words.findall(piece.lower())
        # NFC, then lower case letter by letter
        piece = unicodedata.normalize("NFC", piece)
        if PERHAPS_ODD.search(piece) and ODD.search(piece):
            piece = piece.translate(LOWER).lower()
            return [piece[m.start():m.end()] for m in self.words.finditer(LATER.sub(SYMBOL, piece))]
        return self.words.findall(piece.lower())

    def piece(self, piece: str) -> int:
        """Tokens of a text without blanks: special strings count one each."""
        if self.letters_are_words and piece.isascii() and piece.isalpha():
            return self.words_seen[piece.lower()]
        words = self.split_words(piece)
        if words is None:
            return len(self.specials.findall(piece)) + sum(map(self.piece, self.specials.split(piece)))
        return sum(map(self.words_seen.__getitem__, words))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        split = BLANKS.split(text) if SEPARATORS.search(text) else text.split()
        return sum(map(self.pieces_seen.__getitem__, split))


_BPE: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer, read once per Python worker."""
    if path not in _BPE:
        _BPE[path] = WordBpe(path)
    return _BPE[path]


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, text_col: str = "text", vocab: str = "word_bpe_49k.json",
                 out: str = "n_tokens") -> DataFrame:
    """``docs`` with ``out`` (long): tokens of the whole text; null and empty
    texts have 0. A column already called ``out`` is replaced, others pass
    through unchanged; every input row gives one output row."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary(vocab))
        for b in batches:
            n = [bpe.count(t.as_py()) for t in b.column(b.schema.get_field_index(text_col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, schema)
