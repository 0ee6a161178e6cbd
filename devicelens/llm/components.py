"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.session import cut

#: Links of a round that one task may have: rounds on few links take few tasks, and their checkpoints few files.
TASK_LINKS = 100_000


def lowest_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The smallest member of each node's component, for nodes 0 to n - 1 and links a-b; goes on from given labels."""
    label = np.arange(n) if labels is None else labels.copy()
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of each batch by links to the smallest node of their component in it."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = lowest_labels(len(nodes), place[: len(a)], place[len(a) :])
        away = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[away], pa.int64()), pa.array(nodes[label[away]], pa.int64())], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for each node of the links in the first two columns (long).

    Alternating stars: each node links its larger neighbours, then its smaller ones, to the smallest node it
    knows, until nothing changes; the number of rounds grows with the logarithm of the graph. Minima are
    combined before the shuffle, so a hub is no bottleneck, and each round is cut by a checkpoint, in as many parts as
    its links need. Null ends and links of a node to itself are left out; nodes without a link to another do not appear.
    """
    x, y = edges.columns[:2]
    links = edges.select(F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y")).where("x <> y")
    links = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    # Equal links go by a shuffle first, so that a task never has two Python workers: this one and that of what found the links.
    links = cut(links.distinct().mapInArrow(_stars, "u long, v long").distinct())
    before, count = None, links.count()
    while True:
        parts = max(1, -(-2 * count // TASK_LINKS))  # a round looks at each link from both ends
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large.coalesce(parts))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        links = cut(small.coalesce(parts))
        now = tuple(links.agg(F.count("*"), F.sum(F.col("u") % 1_000_003), F.sum(F.col("v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before or now[0] == 0:
            break
        before, count = now, now[0]
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
