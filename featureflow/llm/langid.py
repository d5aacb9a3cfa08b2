"""Language identification with a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length that overlap by the
widest filter. Each byte is embedded, filters of several widths slide over the
window, a ReLU and the maximum over the places give one feature a filter, and a
softmax over the learned languages gives the window's probabilities. A text's
are the mean over all of its windows, weighted by their letters.

Trained with Adam in numpy on the driver, on a bounded sample of labelled rows:
about ``per_label`` documents a language and ``windows_per_text`` windows of each.
Every label is learnt; with very many of them a label has fewer documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 6
OVERLAP = max(WIDTHS) - 1
UNKNOWN = "und"
BATCH = 2048
#: Labels get this many rows in the mean at least, so that none is left without (one in e^20).
LEAST_ROWS = 20
LETTER = regex.compile(r"\p{L}")


def windows(data: bytes, length: int = LENGTH, overlap: int = OVERLAP) -> np.ndarray:
    """All windows of a byte string (windows x length), zero bytes at the end."""
    step = length - overlap
    n = max(1, -(-(len(data) - overlap) // step))
    padded = np.zeros(n * step + overlap, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, length)[::step]


class ByteCnn:
    """Embedding, filters of ``WIDTHS``, max pooling, softmax."""

    def __init__(self, labels: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.labels = labels
        wide = max(WIDTHS) * EMBED
        f = FILTERS * len(WIDTHS)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filter": rng.normal(0, 1 / np.sqrt(wide), (wide, f)).astype(np.float32),
            "bias": np.zeros(f, np.float32),
            "out": rng.normal(0, 1 / np.sqrt(f), (f, len(labels))).astype(np.float32),
            "out_bias": np.zeros(len(labels), np.float32),
        }
        # a filter of width w has weights in its first w places only
        self.mask = np.zeros((wide, f), np.float32)
        for i, w in enumerate(WIDTHS):
            self.mask[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
        self.p["filter"] *= self.mask

    def slices(self, x: np.ndarray) -> np.ndarray:
        """Embedded slices of the widest filter: (windows, places, width x embed)."""
        e = self.p["embed"][x]
        places = x.shape[1] - OVERLAP
        return np.concatenate([e[:, i:i + places] for i in range(max(WIDTHS))], axis=2)

    def pooled(self, x: np.ndarray):
        s = self.slices(x)
        return s, (s.reshape(-1, s.shape[2]) @ self.p["filter"]).reshape(len(x), s.shape[1], -1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.labels)), np.float32)
        for at in range(0, len(x), 256):  # a block's products stay in the cache
            _, conv = self.pooled(x[at:at + 256])
            h = np.maximum(conv.max(axis=1) + self.p["bias"], 0)
            out[at:at + 256] = softmax(h @ self.p["out"] + self.p["out_bias"])
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        s, conv = self.pooled(x)
        best = conv.argmax(axis=1)  # windows x filters
        h = np.take_along_axis(conv, best[:, None], axis=1)[:, 0] + self.p["bias"]
        on = h > 0
        h = h * on
        d = softmax(h @ self.p["out"] + self.p["out_bias"])
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        dh = (d @ self.p["out"].T) * on
        g = {"out": h.T @ d, "out_bias": d.sum(axis=0), "bias": dh.sum(axis=0)}
        picked = np.take_along_axis(s, best[:, :, None], axis=1)  # windows x filters x slice
        g["filter"] = np.einsum("nf,nfs->sf", dh, picked) * self.mask
        ds = dh[:, :, None] * self.p["filter"].T[None]  # gradient at each filter's best place
        g["embed"] = np.zeros_like(self.p["embed"])
        rows = np.arange(len(x))[:, None]
        for i in range(max(WIDTHS)):
            np.add.at(g["embed"], x[rows, best + i], ds[:, :, i * EMBED:(i + 1) * EMBED])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, steps: int = 800, batch: int = 128, rate: float = 4e-3,
            seed: int = 6):
        """Adam over ``epochs`` passes, or more of them on a small sample: at least ``steps`` batches."""
        rng = np.random.default_rng(seed)
        epochs = max(epochs, -(-steps * batch // max(len(x), batch)))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        t = 0
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows, t = order[at:at + batch], t + 1
                for k, g in self.gradients(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and probability of each whole text; ``und`` and 0 without a letter."""
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        queue, owners, rows = [], [], 0
        total = np.zeros((len(texts), len(self.labels)))

        def flush():
            x = np.concatenate(queue)
            owner = np.concatenate(owners)
            weight = LETTER_BYTE[x].sum(axis=1) + 1e-3
            p = self.probabilities(x) * weight[:, None]
            for c in range(p.shape[1]):
                total[:, c] += np.bincount(owner, p[:, c], len(texts))
            queue.clear(), owners.clear()

        known = [bool(t) and bool(self.labels) and LETTER.search(t) is not None for t in texts]
        for i, text in enumerate(texts):
            if not known[i]:
                continue
            w = windows(text.encode("utf-8"))
            for at in range(0, len(w), BATCH):
                part = w[at:at + BATCH]
                queue.append(part), owners.append(np.full(len(part), i))
                rows += len(part)
                if rows >= BATCH:
                    flush()
                    rows = 0
        if queue:
            flush()
        for i in np.flatnonzero(known):
            best = int(np.argmax(total[i]))
            labels[i], scores[i] = self.labels[best], min(1.0, total[i, best] / total[i].sum())
        return labels, scores


#: Bytes that are ASCII letters or belong to a longer character.
LETTER_BYTE = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def is_held_out(id_col: str) -> Column:
    """The rows never learnt from: crc32 of the id as text, mod 3, is 1 (null id: held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          per_label: int = 400, windows_per_text: int = 8, max_rows: int = 80_000, epochs: int = 8,
          steps: int = 800, seed: int = 5) -> ByteCnn:
    """Fit on about ``per_label`` rows of each label that aren't held out.

    The sample is drawn by a hash of id and text at a rate from the label's
    count of different ones, each of which counts once however often it is there,
    and its windows are cut out evenly over the whole text in the tasks, so the
    driver gets at most ``max_rows x windows_per_text`` windows of ``LENGTH``
    bytes (in the mean). Every label is learnt: where ``per_label`` rows of each
    would be over ``max_rows``, each label gets fewer, but ``LEAST_ROWS`` if it
    has them. With no labelled row the model knows none and answers ``und``.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("lang"))
    usable = usable.filter(~is_held_out("id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.withColumn("key", F.xxhash64(F.lit(seed), "id", "text"))
    counts = {r.lang: r.n for r in usable.select("lang", "key").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return ByteCnn([])
    rows = min(per_label, max(LEAST_ROWS, max_rows // len(labels)))
    rates = docs.sparkSession.createDataFrame([(c, min(1.0, rows / counts[c])) for c in labels], "lang string, rate double")
    usable = usable.join(F.broadcast(rates), "lang")  # a row a label, as the model itself has
    drawn = usable.filter(F.pmod("key", F.lit(1 << 30)) < F.col("rate") * (1 << 30)).groupBy("lang", "key").agg(
        F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys = [], []
            for text, lang in zip(b.column(0), b.column(1), strict=True):
                w = windows(text.as_py().encode("utf-8"))
                w = w[np.unique(np.linspace(0, len(w) - 1, windows_per_text).astype(int))]
                w = w[LETTER_BYTE[w].any(axis=1)]
                xs += [r.tobytes() for r in w]
                ys += [lang.as_py()] * len(w)
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.string()), pa.array(xs, pa.binary())], names=["lang", "x"])

    sample = sorted((r.lang, bytes(r.x)) for r in drawn.select("text", "lang").mapInArrow(cut, "lang string, x binary").collect())
    if not sample:
        return ByteCnn([])
    x = np.frombuffer(b"".join(s[1] for s in sample), np.uint8).reshape(len(sample), LENGTH)
    at = {c: i for i, c in enumerate(labels)}
    return ByteCnn(labels, seed).fit(x, np.array([at[s[0]] for s in sample]), epochs, steps)


def with_language(docs: DataFrame, model: ByteCnn, text_col: str = "text", label_out: str = "lang_pred",
                  score_out: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its probability for each whole
    text; nothing but the text is looked at. Null, empty and letterless texts
    get ``und`` and 0. Columns already called so are replaced."""
    docs = docs.drop(label_out, score_out)
    schema = T.StructType([*docs.schema.fields, T.StructField(label_out, T.StringType()),
                           T.StructField(score_out, T.DoubleType())])
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, scores = model.predict(b.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(labels, pa.string()), pa.array(scores)],
                                             names=schema.names)

    return docs.mapInArrow(run, schema)
