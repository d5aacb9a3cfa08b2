"""A dense network trained by data-parallel mini-batches.

ReLU layers, softmax output, cross-entropy, Adam. Every epoch deals the rows to
shards anew, by a hash of the row and the epoch, and each shard runs mini-batch
steps from the epoch's weights on its own rows, one Arrow batch in memory at a
time. The shards' weights and moments are averaged by rows (iterative parameter
mixing; McDonald, Hall and Mann, 2010), in blocks, so no task holds all shards'
weights. An epoch is one Spark job whose result is a table in the checkpoint
folder: a lost executor costs its running tasks, and a stopped training goes on
after its last epoch. Rows are dealt by value, so any partitioning of the input
gives the same network.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.aggregates import require_rows
from featureflow.operators.arrow import rows_matrix
from featureflow.operators.columns import usable_vector, vector_dim
from featureflow.session import checkpoint_dir
from featureflow.sources.manifest import path_exists

HIDDEN = (1024, 128, 64)
BLOCK = 4096
SHARDS, SHARE = 4, 16
MODEL_MAX_BYTES = 512 << 20
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-7
STATE_SCHEMA = "epoch int, kind string, block int, total long, values array<double>"


def sizes_of(dims: Sequence[int]) -> int:
    """Weights of a network with these layer widths, biases included."""
    return sum((a + 1) * b for a, b in zip(dims, dims[1:]))


def layers_of(flat: np.ndarray, dims: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the flat weights: a matrix and a bias for each layer."""
    out, at = [], 0
    for a, b in zip(dims, dims[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + (a + 1) * b]))
        at += (a + 1) * b
    return out


def first_weights(dims: Sequence[int], seed: int) -> np.ndarray:
    """Uniform within sqrt(6 / (in + out)), biases zero."""
    rng, flat = np.random.default_rng(seed), np.zeros(sizes_of(dims))
    for w, _ in layers_of(flat, dims):
        bound = np.sqrt(6 / sum(w.shape))
        w[:] = rng.uniform(-bound, bound, w.shape)
    return flat


def forward(flat: np.ndarray, dims: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """Outputs of every layer, the input first and class probabilities last."""
    outs, layers = [x], layers_of(flat, dims)
    for i, (w, b) in enumerate(layers):
        z = outs[-1] @ w + b
        if i < len(layers) - 1:
            outs.append(np.maximum(z, 0))
        else:
            e = np.exp(z - z.max(axis=1, keepdims=True))
            outs.append(e / e.sum(axis=1, keepdims=True))
    return outs


def loss_and_gradient(flat: np.ndarray, dims: Sequence[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows, and the gradient of its mean."""
    outs, grad = forward(flat, dims, x), np.empty_like(flat)
    rows = np.arange(len(y))
    loss = -np.log(np.maximum(outs[-1][rows, y], 1e-300)).sum()
    delta = outs[-1].copy()
    delta[rows, y] -= 1
    delta /= len(y)
    layers, grads = layers_of(flat, dims), layers_of(grad, dims)
    for i in range(len(layers) - 1, -1, -1):
        grads[i][0][:], grads[i][1][:] = outs[i].T @ delta, delta.sum(axis=0)
        if i:
            delta = (delta @ layers[i][0].T) * (outs[i] > 0)
    return float(loss), grad


class Adam:
    """Weights with their moments; ``step`` changes them in place."""

    def __init__(self, flat: np.ndarray, m: np.ndarray, v: np.ndarray, steps: int, rate: float):
        self.flat, self.m, self.v, self.steps, self.rate = flat.copy(), m.copy(), v.copy(), steps, rate

    def step(self, grad: np.ndarray) -> None:
        self.steps += 1
        self.m += (1 - BETA1) * (grad - self.m)
        self.v += (1 - BETA2) * (grad * grad - self.v)
        rate = self.rate * np.sqrt(1 - BETA2 ** self.steps) / (1 - BETA1 ** self.steps)
        self.flat -= rate * self.m / (np.sqrt(self.v) + EPSILON)


@dataclass
class Network:
    """Trained weights. ``losses``: mean training loss of each epoch, as met on
    the way. ``at(epoch)`` is the network after that epoch (0: the first weights)."""

    dims: list[int]
    flat: np.ndarray
    folder: str | None = None
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features_col: str = "features", prediction_col: str = "prediction",
                  probability_col: str = "probability") -> DataFrame:
        """Adds the class and ``array<double>`` of probabilities; NULL for rows
        without a vector of the right length with finite numbers."""
        from pyspark.sql.types import ArrayType, DoubleType

        bc, dims = df.sparkSession.sparkContext.broadcast(self.flat), self.dims

        @F.arrow_udf(ArrayType(DoubleType()))
        def score(feats: pa.Array) -> pa.Array:
            valid, x = rows_matrix(feats, dims[0])
            finite = np.isfinite(x).all(axis=1)
            valid = valid.copy()
            valid[np.flatnonzero(valid)[~finite]] = False
            p = forward(bc.value, dims, x[finite].astype(np.float64))[-1]
            offsets = np.concatenate([[0], np.cumsum(np.where(valid, dims[-1], 0))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()), mask=pa.array(~valid))

        scored = df.withColumn(probability_col, score(F.col(features_col)))
        p = F.col(probability_col)
        return scored.withColumn(prediction_col, (F.array_position(p, F.array_max(p)) - 1).cast("int"))

    def at(self, spark: SparkSession, epoch: int) -> Network:
        if self.folder is None:
            raise ValueError("this network keeps no epochs")
        state = read_epoch(spark, self.folder, epoch, sizes_of(self.dims))
        return Network(self.dims, state[0], self.folder, self.losses[:epoch])


def read_epoch(spark: SparkSession, folder: str, epoch: int, n: int):
    """``weights, m, v, steps, loss`` after an epoch. The network itself: its size is checked before training."""
    rows = spark.read.schema(STATE_SCHEMA).parquet(f"{folder}/epoch={epoch}").collect()
    parts = {k: np.zeros(n) for k in ("w", "m", "v")}
    steps, loss = 0, 0.0
    for r in rows:
        if r["kind"] == "epoch":
            steps, loss = r["total"], r["values"][0]
        else:
            parts[r["kind"]][r["block"] * BLOCK:r["block"] * BLOCK + len(r["values"])] = r["values"]
    return parts["w"], parts["m"], parts["v"], steps, loss


def run_epoch(rows: DataFrame, state, dims: Sequence[int], epoch: int, shards: int, batch_size: int, rate: float,
              seed: int) -> DataFrame:
    """One epoch over ``rows(features, label, copy)`` as the table of its state."""
    bc = rows.sparkSession.sparkContext.broadcast(state)
    order = F.xxhash64(F.lit(seed), F.lit(epoch), "label", "features", "copy")
    dealt = rows.withColumn("order", order).withColumn("shard", F.pmod(F.shiftright("order", 8), F.lit(shards)).cast("int"))
    dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "order", "label", "features", "copy")
    d, n = dims[0], sizes_of(dims)

    def result(shard: int, net: Adam, count: int, loss: float) -> Iterator[pa.RecordBatch]:
        yield record([("epoch", 0, shard, count, [loss, float(net.steps)])])
        for kind, flat in (("w", net.flat), ("m", net.m), ("v", net.v)):
            for at in range(0, n, BLOCK * 64):  # a few blocks at a time
                yield record([(kind, b // BLOCK, shard, count, flat[b:b + BLOCK]) for b in range(at, min(n, at + BLOCK * 64), BLOCK)])

    def record(parts) -> pa.RecordBatch:
        kind, block, shard, count, values = zip(*parts, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(block, pa.int32()), pa.array(shard, pa.int32()), pa.array(count, pa.int64()),
             pa.array(values, pa.list_(pa.float64()))], names=["kind", "block", "shard", "rows", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, shard, count, loss = None, None, 0, 0.0
        xs, ys = np.empty((0, d)), np.empty(0, np.int64)

        def learn(x, y):
            nonlocal loss, count
            got, grad = loss_and_gradient(net.flat, dims, x, y)
            net.step(grad)
            loss, count = loss + got, count + len(y)

        for b in batches:
            _, x = rows_matrix(b.column(0), d)
            y, of = b.column(1).to_numpy(), b.column(3).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if shard != of[lo]:
                    if net is not None:
                        if len(ys):
                            learn(xs, ys)
                        yield from result(shard, net, count, loss)
                    net, shard, count, loss = Adam(*bc.value, rate), int(of[lo]), 0, 0.0
                    xs, ys = np.empty((0, d)), np.empty(0, np.int64)
                xs, ys = np.concatenate([xs, x[lo:hi].astype(np.float64)]), np.concatenate([ys, y[lo:hi]])
                whole = len(ys) // batch_size * batch_size
                for at in range(0, whole, batch_size):
                    learn(xs[at:at + batch_size], ys[at:at + batch_size])
                xs, ys = xs[whole:], ys[whole:]
        if net is not None:
            if len(ys):
                learn(xs, ys)
            yield from result(shard, net, count, loss)

    def mix(table: pa.Table) -> pa.Table:
        """Average of one block over the shards, in their order."""
        table = table.sort_by("shard")
        kind, count = table["kind"][0].as_py(), table["rows"].to_numpy().astype(np.float64)
        values = np.stack([v.values.to_numpy() for v in table["values"]])
        if kind == "epoch":
            out, total = [values[:, 0].sum() / count.sum()], int(values[:, 1].max())
        else:
            out, total = (values * (count / count.sum())[:, None]).sum(axis=0), int(count.sum())
        return pa.table({"epoch": pa.array([epoch], pa.int32()), "kind": [kind],
                         "block": pa.array([table["block"][0].as_py()], pa.int32()), "total": pa.array([total], pa.int64()),
                         "values": pa.array([out], pa.list_(pa.float64()))})

    parts = dealt.select("features", "label", "order", "shard").mapInArrow(
        run, "kind string, block int, shard int, rows long, values array<double>")
    return parts.groupBy("kind", "block").applyInArrow(mix, STATE_SCHEMA)


def train_network(
    df: DataFrame, features_col: str = "features", label_col: str = "label", hidden: Sequence[int] = HIDDEN,
    epochs: int = 10, batch_size: int = 32, rate: float = 0.001, shards: int | None = None, seed: int = 42,
    folder: str | None = None, key: Sequence[str] = (),
) -> Network:
    """Fit on the rows with a usable vector and a label (0, 1, ...); raises if
    there are none. ``folder`` keeps the epochs: a training that was stopped goes
    on there. Rows equal in vector, label and ``key`` fall into one shard; name a row
    id as ``key`` where many rows are copies."""
    import uuid

    spark = df.sparkSession
    require_rows(df)
    dim = vector_dim(df, features_col)
    rows = df.filter(usable_vector(features_col, dim) & F.col(label_col).isNotNull()).select(
        F.col(features_col).alias("features"), F.col(label_col).cast("int").alias("label"),
        (F.xxhash64(*key) if key else F.lit(0).cast("long")).alias("copy"))
    low, high, count = rows.agg(F.min("label"), F.max("label"), F.count(F.lit(1))).first()
    if high is None:
        raise ValueError("training input is empty")
    if low < 0:
        raise ValueError("labels must be >= 0")
    dims = [dim, *hidden, high + 1]
    n = sizes_of(dims)
    if n * 24 > MODEL_MAX_BYTES:
        raise ValueError(f"network of {n} weights exceeds {MODEL_MAX_BYTES} bytes with its moments")
    shards = shards or max(SHARDS, count * dim // (SHARE * n))
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/network-{uuid.uuid4().hex}"
    state, losses = (first_weights(dims, seed), np.zeros(n), np.zeros(n), 0), []
    for epoch in range(1, epochs + 1):
        done = f"{folder}/epoch={epoch}"
        if not path_exists(spark, f"{done}/_SUCCESS"):
            run_epoch(rows, state, dims, epoch, shards, batch_size, rate, seed).write.mode("overwrite").parquet(done)
        *state, loss = read_epoch(spark, folder, epoch, n)
        losses.append(loss)
    return Network(dims, state[0], folder, losses)
