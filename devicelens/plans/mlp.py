"""A feed-forward binary classifier (n -> 64 -> 32 -> 1) trained on all partitions at once.

In every epoch each partition starts from the shared weights, runs Adam over its rows in
fixed batches, and returns its weights and optimiser moments. Their row-weighted mean,
an aggregation over a few thousand numbers, is the start of the next epoch. Only that
mean ever reaches the driver. Results depend on the partitioning, as with any data-parallel
training; rows never leave their partition.

Synchronous training is the other way: all partitions run side by side as one barrier stage, and exchange the sums of their
gradients at each batch. It gives the same weights however the rows lie, but waits for an exchange at each batch (most of a second
here, measured): it is for few, large batches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.operators.groups import BATCH, rebatch
from devicelens.session import small_batches
from devicelens.sources.tables import rows

# Layer widths, epochs, learning rate, patience.
HIDDEN = (64, 32)
EPOCHS, LEARNING_RATE, PATIENCE = 20, 1e-3, 3
#: Rows of a batch that are worked on at once, and packed batches that go to Python at once.
SLICE, PACKS = 512, 16


def _shapes(n: int, hidden: Sequence[int]) -> list[tuple[int, ...]]:
    sizes = [n, *hidden, 1]
    return [shape for a, b in zip(sizes, sizes[1:]) for shape in ((a, b), (b,))]


def _split(flat: np.ndarray, shapes) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def _start(n: int, hidden: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in ±1/sqrt(inputs), weights and biases."""
    rng = np.random.default_rng(seed)
    parts, inputs = [], n
    for shape in _shapes(n, hidden):
        inputs = shape[0] if len(shape) == 2 else inputs
        parts.append(rng.uniform(-1, 1, int(np.prod(shape))) / np.sqrt(inputs))
    return np.concatenate(parts)


def _forward(layers: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """Activations of all layers, the last one before the sigmoid."""
    out = [x]
    for i in range(0, len(layers), 2):
        x = x @ layers[i]
        x += layers[i + 1]
        if i + 2 < len(layers):
            np.maximum(x, 0.0, out=x)
        out.append(x)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _loss_gradient(flat: np.ndarray, shapes, x: np.ndarray, y: np.ndarray, heavy: tuple[float, float] = (1.0, 1.0)) -> tuple[float, np.ndarray]:
    """Mean binary cross-entropy of a batch and its gradient; ``heavy`` are the weights of rows of class 0 and 1.

    The sums go over slices of the batch whose activations stay in the processor's cache.
    """
    layers = _split(flat, shapes)
    lost, gradient = 0.0, np.zeros(len(flat))
    for start in range(0, len(y), SLICE):
        true = y[start : start + SLICE]
        acts = _forward(layers, x[start : start + SLICE])
        p = _sigmoid(acts[-1][:, 0])
        weight = np.where(true > 0.5, heavy[1], heavy[0])
        lost -= float(np.sum(weight * (true * np.log(np.maximum(p, 1e-12)) + (1 - true) * np.log(np.maximum(1 - p, 1e-12)))))
        back = (weight * (p - true) / len(y))[:, None]
        grads: list[np.ndarray] = []
        for i in range(len(layers) - 2, -1, -2):
            below = acts[i // 2]
            grads = [(below.T @ back).ravel(), back.sum(axis=0), *grads]
            if i:
                back = back @ layers[i].T
                back *= below > 0
        gradient += np.concatenate(grads)
    return lost / len(y), gradient


@dataclass
class Mlp:
    """Trained weights; a few thousand numbers."""

    columns: list[str]
    hidden: tuple[int, ...]
    centre: np.ndarray
    width: np.ndarray
    flat: np.ndarray
    history: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "probability", prediction: str | None = None) -> DataFrame:
        """Add the probability of class 1, by batches of rows."""
        shapes, centre, width, flat = _shapes(len(self.columns), self.hidden), self.centre, self.width, self.flat

        @F.pandas_udf("double")
        def forward(*values: pd.Series) -> pd.Series:
            x = (np.column_stack([v.to_numpy(dtype=float) for v in values]) - centre) / width
            return pd.Series(_sigmoid(_forward(_split(flat, shapes), x)[-1][:, 0]))

        scored = df.withColumn(out, forward(*[F.col(c).cast("double") for c in self.columns]))
        return scored.withColumn(prediction, (F.col(out) > 0.5).cast("int")) if prediction else scored


def train_mlp(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    hidden: Sequence[int] = HIDDEN,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    learning_rate: float = LEARNING_RATE,
    patience: int = PATIENCE,
    workers: int | None = None,
    seed: int = 0,
    standardise: bool = True,
    synchronous: bool = False,
    balanced: bool = False,
) -> Mlp:
    """Train until the epochs are used up or the training loss has not improved for ``patience`` of them.

    ``workers`` is the number of partitions that train side by side (default: as the data lie). Weights are averaged after
    each epoch; with ``synchronous`` gradients are summed after each batch instead, so the result does not depend on the partitions.
    With ``balanced`` rows of both classes weigh the same in all.
    """
    columns, hidden = list(columns), tuple(hidden)
    n = len(columns)
    centre, width = np.zeros(n), np.ones(n)
    if standardise:
        spread = rows(df.agg(*[f(c).alias(f"{s}{i}") for i, c in enumerate(columns) for s, f in (("m", F.avg), ("s", F.stddev_samp))]))[0]
        centre = np.array([spread[f"m{i}"] or 0.0 for i in range(n)])
        width = np.array([spread[f"s{i}"] or 0.0 for i in range(n)])
        width[width == 0] = 1.0
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("_y"))
    if synchronous:
        # All workers must run at once: no more of them than cores.
        cores = data.sparkSession.sparkContext.defaultParallelism
        workers = min(workers or max(1, data.count() // (4 * batch)), cores)
    if workers:
        data = data.repartition(workers)  # in turn, not by hash: equal rows must not meet in one partition
    shapes = _shapes(n, hidden)
    model = Mlp(columns, hidden, centre, width, _start(n, hidden, seed))
    if balanced:
        share = df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
        heavy = (0.5 / (1 - share) if share < 1 else 1.0, 0.5 / share if share > 0 else 1.0)
    else:
        heavy = (1.0, 1.0)
    if synchronous:
        data = data.persist()
        try:
            return _train_together(data, model, shapes, columns, epochs, batch, learning_rate, patience, heavy)
        finally:
            data.unpersist()
    # Packed once: an epoch then reads whole batches and not row by row.
    packed = data.mapInPandas(_packer(columns, centre, width, batch), "rows binary").persist()
    packed.count()
    size = len(model.flat)
    moments = np.zeros(2 * size)
    steps, waited, best = 0.0, 0, np.inf
    try:
        for _ in range(epochs):
            shared = data.sparkSession.sparkContext.broadcast((model.flat, moments, steps))

            def train(packs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                flat, (m, v), t = shared.value[0].copy(), np.split(shared.value[1].copy(), 2), shared.value[2]
                count, total = 0, 0.0
                for pack in packs:
                    for blob in pack.column(0):
                        table = np.frombuffer(blob.as_buffer()).reshape(-1, n + 1)
                        loss, gradient = _loss_gradient(flat, shapes, table[:, :n], table[:, n], heavy)
                        t += 1
                        m = 0.9 * m + 0.1 * gradient
                        v = 0.999 * v + 0.001 * gradient * gradient
                        flat -= learning_rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                        count += len(table)
                        total += loss * len(table)
                if count:
                    values = np.concatenate([flat, m, v, [t, total / count]])
                    columns_of = [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values * count), pa.array(np.full(len(values), float(count)))]
                    yield pa.RecordBatch.from_arrays(columns_of, ["at", "value", "n"])

            returned = packed.mapInArrow(train, "at int, value double, n double")
            mean = returned.groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value"))
            with small_batches(data.sparkSession, PACKS):
                values = mean.toPandas().sort_values("at")["value"].to_numpy()
            shared.unpersist()
            if not len(values):
                raise ValueError("no rows to train on")
            model.flat, moments, steps = values[:size], values[size : 3 * size], float(values[3 * size])
            model.history.append(float(values[-1]))
            waited = 0 if model.history[-1] < best else waited + 1
            best = min(best, model.history[-1])
            if waited >= patience:
                break
    finally:
        packed.unpersist()
    return model


def _packer(columns: list[str], centre: np.ndarray, width: np.ndarray, batch: int):
    """From rows to batches of so many within each partition: standardised columns and the label, row after row, as doubles."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rebatch(frames, batch):
            x = (pdf[columns].to_numpy(dtype=float) - centre) / width
            yield pd.DataFrame({"rows": [np.column_stack([x, pdf["_y"].to_numpy(dtype=float)]).tobytes()]})

    return pack


def _train_together(data: DataFrame, model: Mlp, shapes, columns: list[str], epochs: int, batch: int, learning_rate: float, patience: int, heavy) -> Mlp:
    """All partitions take each step together: the gradient of a batch is the sum over the partitions' rows of it.

    A row's batch comes from its hash, so batches do not depend on the layout. All tasks run at once and exchange sums by
    ``allGather``; each holds its partition's rows and ends with the same weights, which the first one hands back.
    """
    total = data.count()
    if not total:
        raise ValueError("no rows to train on")
    steps = max(1, -(-total // batch))
    start, centre, width = model.flat, model.centre, model.width
    marked = data.withColumn("_h", F.xxhash64(*columns, "_y"))

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = BarrierTaskContext.get()
        alone = len(context.getTaskInfos()) == 1
        held = [pdf for pdf in frames if len(pdf)]
        pdf = pd.concat(held, ignore_index=True) if held else pd.DataFrame(columns=[*columns, "_y", "_h"], dtype=float)
        x, y = (pdf[columns].to_numpy(dtype=float) - centre) / width, pdf["_y"].to_numpy(dtype=float)
        order = np.argsort(pdf["_h"].to_numpy(dtype=np.int64), kind="stable")
        x, y, h = x[order], y[order], pdf["_h"].to_numpy(dtype=np.int64)[order]
        flat, m, v, t = start.copy(), np.zeros(len(start)), np.zeros(len(start)), 0
        history, waited, best = [], 0, np.inf
        for epoch in range(epochs):
            with np.errstate(over="ignore"):
                mixed = (h.astype(np.uint64) ^ np.uint64(epoch * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            of = ((mixed >> np.uint64(33)) % np.uint64(steps)).astype(np.int64)
            lost = 0.0
            for step in range(steps):
                mine = of == step
                n = int(mine.sum())
                loss, gradient = _loss_gradient(flat, shapes, x[mine], y[mine], heavy) if n else (0.0, np.zeros(len(flat)))
                sums = np.concatenate([gradient * n, [loss * n, n]])
                if alone:
                    gathered = [sums]
                else:
                    gathered = [np.frombuffer(base64.b64decode(g), np.float64) for g in context.allGather(base64.b64encode(sums.tobytes()).decode())]
                sums = np.sum(gathered, axis=0)
                if not sums[-1]:
                    continue
                gradient, t = sums[:-2] / sums[-1], t + 1
                lost += sums[-2]
                m = 0.9 * m + 0.1 * gradient
                v = 0.999 * v + 0.001 * gradient * gradient
                flat = flat - learning_rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            history.append(lost / total)
            waited = 0 if history[-1] < best else waited + 1
            best = min(best, history[-1])
            if waited >= patience:
                break
        if context.partitionId() == 0:
            values = np.concatenate([flat, history])
            yield pd.DataFrame({"at": np.arange(len(values)), "value": values})

    values = marked.mapInPandas(train, "at int, value double", barrier=True).toPandas().sort_values("at")["value"].to_numpy()
    model.flat, model.history = values[: len(start)], values[len(start) :].tolist()
    return model
