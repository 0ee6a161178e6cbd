"""Document quality from a linear-chain conditional random field over lines.

Each line is labelled good or bad. What speaks for a label are features of the line and of its neighbours, cut
into bins: lengths, capitals, digits, symbols, bars, words that end in symbols, words repeated at once. Labels of
adjacent lines are tied by transition weights. Forward and backward sums give each line's probability of being good; a
document's quality is their mean, weighted by line length.

The field is fitted by its conditional likelihood on a bounded sample of labelled documents, whose lines
take the document's label; everything else reads all lines of all documents, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.llm.support import fold

#: Bin edges of each line feature; fixed parameters of the model's form, not fitted.
EDGES = {
    "characters": [1, 20, 60, 150, 400, 1500],
    "words": [1, 3, 8, 20, 60, 200],
    "word_length": [2.5, 4, 5.5, 7, 9, 14],
    "capitals": [0.02, 0.06, 0.12, 0.3, 0.6, 0.9],
    "digits": [0.001, 0.02, 0.05, 0.15, 0.4, 0.7],
    "symbols": [0.001, 0.01, 0.03, 0.08, 0.15, 0.4],
    "bars": [0.001, 0.05, 0.15, 0.3, 0.45, 0.8],
    "symbol_ends": [0.001, 0.02, 0.08, 0.2, 0.5, 0.9],
    "repeats": [0.001, 0.02, 0.05, 0.15, 0.4, 0.8],
}
BINS = 8  # seven of the edges' bins and one for a missing neighbour
#: Labelled documents that the field is fitted on, at most; steps of the fit; weight of the penalty.
FIT_DOCUMENTS, STEPS, PENALTY = 3_000, 150, 1e-4


def _classes() -> np.ndarray:
    """0 other letter, 1 capital, 2 digit, 3 space, 4 common punctuation, 5 symbol, 6 bar, for code points below 0x250; beyond, letters."""
    out = np.zeros(0x251, np.uint8)
    for c in range(0x250):
        s = chr(c)
        out[c] = 3 if s.isspace() else 1 if s.isupper() else 2 if s.isdigit() else 6 if s == "|" else 0 if s.isalpha() else 4 if s in ".,;:'\"()-?¡¿" else 5
    return out


def line_bins(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of every line (lines, features), its length with its line end, and the number of lines of each text."""
    classes = _classes()
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.minimum(codes, 0x250)
    kind = classes[codes]
    newline = codes == 10
    ends = np.flatnonzero(newline)
    starts = np.concatenate([[0], ends[:-1] + 1])
    line = np.cumsum(newline) - newline
    n = len(ends)
    count = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float)
    characters = (ends - starts).astype(float)

    blank = kind == 3
    first = ~blank
    first[1:] &= blank[:-1]
    begins = np.flatnonzero(first)
    word_line = line[begins]
    words = np.bincount(word_line, minlength=n).astype(float)
    if len(begins):
        final = ~blank
        final[:-1] &= blank[1:]
        finish = np.flatnonzero(final)
        word = np.cumsum(first) - 1
        place = np.arange(len(codes)) - begins[np.maximum(word, 0)]
        factor = np.random.default_rng(1).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
        value = np.where(blank, np.uint64(0), (codes.astype(np.uint64) + np.uint64(1)) * factor[place & 63])
        mark = np.add.reduceat(value, begins)
        again = np.zeros(len(begins), bool)
        again[1:] = (mark[1:] == mark[:-1]) & (word_line[1:] == word_line[:-1])
        repeats = np.bincount(word_line, again, n)
        tail = kind[finish]
        single = begins == finish
        symbol_ends = np.bincount(word_line, (tail == 5) & ~single, n)
        bars = np.bincount(word_line, single & (tail == 6), n)
    else:
        repeats = symbol_ends = bars = np.zeros(n)
    some, visible = np.maximum(words, 1), np.maximum(count[:, [0, 1, 2, 4, 5, 6]].sum(1), 1)
    letters = np.maximum(count[:, 0] + count[:, 1], 1)
    values = (characters, words, visible / some * (words > 0), count[:, 1] / letters, count[:, 2] / visible, count[:, 5] / visible, bars / some, symbol_ends / some, repeats / some)
    bins = np.stack([np.searchsorted(np.array(e, float), v, side="right") for e, v in zip(EDGES.values(), values)], axis=1).astype(np.uint8)
    lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
    return bins, characters + 1, lines


@dataclass
class Field:
    """Weights: ``emit`` (before, own, after; feature; bin) and ``bias`` for "good", ``move`` (from, to) between labels."""

    emit: np.ndarray
    bias: float
    move: np.ndarray

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros((3, len(EDGES), BINS)), 0.0, np.zeros((2, 2)))


def beside(bins: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Bins of the line before, of the line, of the line after: (3, lines, features); the last bin where there is none."""
    ends = np.cumsum(lines)
    before, after = np.roll(bins, 1, 0), np.roll(bins, -1, 0)
    before[(ends - lines)[lines > 0]] = BINS - 1
    after[(ends - 1)[lines > 0]] = BINS - 1
    return np.stack([before, bins, after])


def marginals(field: Field, near: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "good" of each line, and the expected count of each move between labels."""
    score = np.full(near.shape[1], field.bias)
    for side in range(3):
        for feature in range(near.shape[2]):
            score += field.emit[side, feature][near[side, :, feature]]
    emit = np.stack([np.zeros_like(score), score], 1)
    emit = np.exp(emit - emit.max(1, keepdims=True))
    order = np.argsort(-lines, kind="stable")
    length, start = lines[order], (np.cumsum(lines) - lines)[order]
    move = np.exp(field.move)
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    most = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(most)]  # texts with more than t lines
    state = None
    for t in range(most):
        at = start[: active[t]] + t
        state = emit[at] if t == 0 else (state[: active[t]] @ move) * emit[at]
        state = state / state.sum(1, keepdims=True)
        forward[at] = state
    state = np.ones((0, 2))
    for t in range(most - 1, 0, -1):
        at = start[: active[t]] + t
        grown = np.ones((active[t], 2))
        grown[: len(state)] = state
        state = (grown * emit[at]) @ move.T
        state = state / state.sum(1, keepdims=True)
        backward[at - 1] = state
    both = forward * backward
    good = both[:, 1] / both.sum(1)
    moves = np.zeros((2, 2))
    inner = np.ones(len(good), bool)
    inner[(np.cumsum(lines) - lines)[lines > 0]] = False
    at = np.flatnonzero(inner)
    if len(at):
        pair = forward[at - 1][:, :, None] * move[None] * (emit[at] * backward[at])[:, None, :]
        moves = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
    return good, moves


def fit(bins: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Field:
    """The field of highest penalised conditional likelihood, by steps of Adam. Labels are of texts; lines take them."""
    field = Field.empty()
    if not len(bins):
        return field
    near, y = beside(bins, lines), np.repeat(labels.astype(float), lines)
    weight = 1.0 / len(y)
    inner = np.ones(len(y), bool)
    inner[(np.cumsum(lines) - lines)[lines > 0]] = False
    pairs = np.bincount((2 * np.roll(y, 1) + y)[inner].astype(int), minlength=4).reshape(2, 2)
    size = field.emit.size
    theta, m, v = np.zeros(size + 5), np.zeros(size + 5), np.zeros(size + 5)
    for step in range(1, steps + 1):
        field = Field(theta[:size].reshape(field.emit.shape), theta[size], theta[size + 1 :].reshape(2, 2))
        good, moves = marginals(field, near, lines)
        slope = (y - good) * weight
        grad = np.concatenate(
            [np.bincount(near[s, :, f], slope, BINS) for s in range(3) for f in range(near.shape[2])] + [[slope.sum()], ((pairs - moves) * weight).ravel()]
        ) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(theta[:size].reshape(field.emit.shape), float(theta[size]), theta[size + 1 :].reshape(2, 2))


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good, for each text."""
    if not texts:
        return np.zeros(0)
    bins, length, lines = line_bins(texts)
    good, _ = marginals(field, beside(bins, lines), lines)
    text = np.repeat(np.arange(len(texts)), lines)
    return np.clip(np.bincount(text, good * length, len(texts)) / np.bincount(text, length, len(texts)), 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``text``, ``y`` of at most ``most`` labelled documents, chosen by the hash of their id.

    Rows of one id with equal texts are one document, and the bound holds for documents too, not only for labels.
    """
    chosen = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("y"))
    chosen = chosen.distinct().orderBy(F.xxhash64("_id"), "y").limit(most)
    found = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "_id")
    found = found.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).dropDuplicates(["_id", "_sha", "y"])
    return found.orderBy(F.xxhash64("_id"), "_sha", "y").limit(most).select("text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS, label: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> Field:
    """Fit on at most ``most`` of the labelled documents. Tasks turn their texts into bins; the driver gets a few bytes per line of the sample."""

    def bins_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_bins([t.as_py() or ""])[0] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in found], pa.binary()), batch.column(1)], ["bins", "y"])

    rows = labelled_sample(docs, labels, label, most, id_column, text_column).mapInArrow(bins_of, "bins binary, y int").orderBy("y", F.xxhash64("bins")).collect()
    if len({r.y for r in rows}) < 2:
        field = Field.empty()  # one class or none: its share, smoothed, for all
        good = sum(r.y for r in rows)
        field.bias = float(np.log((good + 1) / (len(rows) - good + 1)))
        return field
    width = len(EDGES)
    parts = [np.frombuffer(r.bins, np.uint8).reshape(-1, width) for r in rows]
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), np.array([r.y for r in rows]))


def score_quality(docs: DataFrame, field: Field, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``score`` and ``predicted`` (1 from the threshold on) of every row.

    A null text is the empty text, which is one empty line; lines end at ``\\n``. Rows are scored one by one, so
    repeated rows get equal scores; an empty table gives no rows; only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t.as_py() or "" for t in batch.column(1)]
            scores, at = np.zeros(len(texts)), 0
            while at < len(texts):  # about a million characters at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 1_000_000):
                    size += len(texts[end])
                    end += 1
                scores[at:end] = score_texts(field, texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [id_column, "score", "predicted"])

    narrow = docs.select(id_column, text_column)
    return narrow.mapInArrow(run, f"`{id_column}` {narrow.schema[id_column].dataType.simpleString()}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> DataFrame:
    """Fit on rows out of the held-out fold (``crc32(doc_id) % 4 = 2``), score all rows."""
    field = fit_quality(docs, labels.where(fold(F.col("doc_id"), 4) != 2), most)
    return score_quality(docs, field).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
