"""Hard negatives: the threshold join and whole results against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelens.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def brute(rows, every=100, positives=5, count=10, scale=256, low=30, high=90):
    """All scores of every anchor, in plain integers."""
    kept = {}
    for ident, vector, label, *_ in rows:
        if ident is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(scale * float(np.float32(x))) for x in vector)
        if sum(x * x for x in whole) < 2**62:
            kept[ident] = min(kept.get(ident, (str(label), whole)), (str(label), whole))
    out = set()
    for a, (label, vector) in kept.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, other == label) for i, (other, v) in kept.items() if i != a and len(v) == len(vector)]
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and low * -ps <= 100 * -s[0] <= high * -ps]
            out |= {(a, p, r, i, -ps, -s) for r, (s, i, _) in enumerate(inside[:count], 1)}
    return out


def found(frame):
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("size", [50, 300, 1 << 20, 1 << 27])
def test_threshold_join_equals_all_products(size):
    rng = np.random.default_rng(size)
    for trial in range(40):
        d, n, a = int(rng.integers(1, 70)), int(rng.integers(1, 80)), int(rng.integers(1, 20))
        rows, anchors = rng.integers(-size, size + 1, (n, d)), rng.integers(-size, size + 1, (a, d))
        if trial % 3 == 0:
            rows = (rows * np.geomspace(1, 0.01, d)).astype(np.int64)
        products = anchors @ rows.T
        least = np.quantile(products, rng.random(a)).astype(np.int64) if trial % 2 else np.full(a, int(products.max()) - 1)
        if trial % 7 == 0:
            least[:] = -negatives.FAR
        i, j, s = negatives.scores_from(anchors, least, rows)
        want = {(x, y): products[x, y] for x, y in zip(*np.nonzero(products >= least[:, None]))}
        assert dict(zip(zip(i.tolist(), j.tolist()), s.tolist())) == want and len(i) == len(want)


def test_index_leaves_out_and_prunes():
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(2_000, 64)) * np.geomspace(1, 0.01, 64) * 256).astype(np.int64)
    anchors = rows[:50]
    least = (np.square(anchors).sum(1) * 0.8).astype(np.int64)
    some: list = []
    negatives.scores_from(anchors, least, rows, worked=some)
    assert sum(some) < 0.5 * 50 * 2_000 * 64


def clustered(seed, n, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    out = []
    for i in range(n):
        v = centres[rng.integers(6)] * rng.choice([0.0, 0.3, 1.0]) + rng.normal(size=d) * rng.choice([0.05, 1.0])
        out.append((i, [float(np.float32(x / 3)) for x in v], int(rng.integers(4))))
    return out


@pytest.mark.parametrize(("first", "more"), [(4, 16), (0.01, 3)])
def test_windows_fill_in_rounds(spark, monkeypatch, first, more):
    """Also with thresholds that start far too high, so that most windows need several rounds."""
    monkeypatch.setattr(negatives, "FIRST", first)
    monkeypatch.setattr(negatives, "MORE", more)
    rows = clustered(1, 500)
    frame = spark.createDataFrame([(*r, 0.0, "x") for r in rows], SCHEMA).repartition(5)
    got = found(negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0, block=64, tile=8))
    want = brute(rows, 20)
    assert got == want and len(want) > 500


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.choice([0, 1, 2])) for i in range(150)]
    rows += [(200, None, 1), (300, [0.1, None, 0.2, 0.3], 1), (400, [float("nan"), 0.0, 0.0, 0.1], 1), (500, [float("inf"), 0.0, 0.0, 0.1], 1), (600, [0.5, 0.5, 0.0, 0.1], None)]
    rows += [(None, [0.5, 0.5, 0.5, 0.5], 1), (700, [], 1), (800, [], 1), (801, [], 2), (900, [0.0] * 4, 1), (1000, [0.5, 0.5], 0), (1001, [0.5, 0.25], 0), (1002, [0.25, 0.25], 1)]
    rows += [(1100, [-0.5] * 4, 7), (1101, [0.5] * 4, 7), (1200, [3e30, 0.0, 0.0, 0.0], 1), (1300, [3e5, 1e5, 0.0, 0.0], 1), (1301, [4e6, 1e5, 1.0, 0.0], 1), (1302, [2e5, 0.0, 0.0, 0.0], 2)]
    rows += [(100, rows[100][1], rows[100][2])] * 3 + [(50, [0.5] * 4, 9), (1400, [0.1] * 4, 11)]
    frame = spark.createDataFrame([(*r, 1.0, "clash") for r in rows], SCHEMA).repartition(4)
    assert found(negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, block=32, tile=4)) == brute(rows, 50)


def test_hot_vector_and_empty_table(spark):
    rows = clustered(3, 300) + [(i, [0.25] * 12, 2) for i in range(300, 900)]
    frame = spark.createDataFrame([(*r, 0.0, "x") for r in rows], SCHEMA).repartition(6)
    assert found(negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, block=100, tile=16)) == brute(rows, 50)
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(none, F.col("vec_id") % 100 == 0).collect() == []


def test_query_at_each_anchor(spark, sf_dir):
    rows = queries.op12_hard_negatives(spark, sf_dir).collect()
    for r in rows:
        assert r.anchor_id % 100 == 0 and 30 * r.positive_score <= 100 * r.negative_score <= 90 * r.positive_score
    assert {r["rank"] for r in rows} == set(range(1, 11))
