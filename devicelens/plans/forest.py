"""A random forest per key, for any number of keys, grown level by level for all keys at once.

Rows become bins of quantiles and lie packed in blocks: a key with many rows has several, many small keys share one. A level
is one pass: every block sends histograms of its rows by (key, tree, node, feature, bin), one aggregation adds them up,
and each key picks the best cut of each of its nodes. So the number of passes depends on the depth alone, a busy key is spread
like any other, and nothing but the cut points of the bins comes to the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelens.operators.lookup import lookup
from devicelens.session import cut

#: Rows of a block, bins per feature.
BLOCK_ROWS, BINS = 50_000, 32
#: Cumulated chances of a Poisson number of mean 1: how often a row is drawn for a tree.
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(8)])


@dataclass(frozen=True)
class KeyedForest:
    """Forests by key: ``models`` has the key (as text), ``n_used``, ``n_positive`` and ``trees``.

    A tree is three arrays by node (children of n are 2n+1 and 2n+2): ``feature`` (-1 for a leaf), ``cut``, ``p``.
    """

    key: str
    columns: tuple[str, ...]
    depth: int
    models: DataFrame

    def probability(self, df: DataFrame, out: str) -> DataFrame:
        """Mean of the trees of the row's own key; null where there is none. Nulls go to the left."""
        routed = lookup(df.withColumn("_key", F.col(self.key).cast("string")), self.models.select(F.col("key").alias("_key"), "trees"), ["_key"])
        values = F.array(*[F.col(c).cast("double") for c in self.columns])

        def leaf(tree):
            def step(node, _):
                feature = F.get(tree["feature"], node)
                right = F.coalesce(F.get(values, feature) > F.get(tree["cut"], node), F.lit(False)).cast("int")
                return F.when(feature < 0, node).otherwise(2 * node + 1 + right)

            return F.get(tree["p"], F.aggregate(F.sequence(F.lit(1), F.lit(max(1, self.depth))), F.lit(0), step))

        total = F.aggregate("trees", F.lit(0.0), lambda s, t: s + leaf(t))
        return routed.withColumn(out, total / F.size("trees")).drop("_key", "trees")

    def score(self, df: DataFrame, out: str = "predictions", threshold: float = 0.5) -> DataFrame:
        """All columns and the predicted class (double); null for keys without a forest."""
        scored = self.probability(df, "_p")
        return scored.withColumn(out, (F.col("_p") >= threshold).cast("double")).drop("_p")

    def save(self, path: str) -> str:
        spark = self.models.sparkSession
        parts = {"key": self.key, "columns": list(self.columns), "depth": self.depth}
        spark.createDataFrame([(json.dumps(parts),)], "config string").coalesce(1).write.parquet(f"{path}/forest")
        self.models.write.parquet(f"{path}/trees")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KeyedForest:
        parts = json.loads(spark.read.parquet(f"{path}/forest").first()["config"])
        return cls(parts["key"], tuple(parts["columns"]), parts["depth"], spark.read.parquet(f"{path}/trees"))


def _edges(df: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each column, over all keys."""
    shares = [i / bins for i in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(q or [], dtype=float)) for q in found]


def _blocks(df: DataFrame, key: str, label: str, columns: Sequence[str], edges: list[np.ndarray], block_rows: int) -> DataFrame:
    """Rows packed by unit: bins, labels, a hash and the place of its key of each row, and the unit's keys."""
    named = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in columns])
    sizes = cut(named.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    shared = max(1, -(-2 * total // block_rows))
    parts = sizes.select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    placed = lookup(named.withColumn("h", F.xxhash64(*named.columns)), parts, ["key"], "inner", materialise=False)
    # A busy key has units of its own, the others share some.
    own = F.concat_ws("/", F.lit("k"), "key", F.pmod("h", "parts"))
    placed = placed.withColumn("unit", F.when(F.col("parts") > 1, own).otherwise(F.concat(F.lit("s/"), F.pmod(F.xxhash64("key"), F.lit(shared)))))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, place = np.unique(pdf["key"].to_numpy(dtype=str), return_inverse=True)
        binned = np.zeros((len(pdf), len(columns)), np.uint8)
        for i, c in enumerate(columns):
            x = pdf[c].to_numpy(dtype=float)
            binned[:, i] = np.where(np.isnan(x), 0, np.searchsorted(edges[i], x))
        return pd.DataFrame({
            "unit": [pdf["unit"].iloc[0]], "keys": [list(keys)], "place": [place.astype(np.int32).tobytes()], "bins": [binned.tobytes()],
            "y": [pdf["y"].to_numpy(dtype=np.float32).tobytes()], "h": [pdf["h"].to_numpy(np.int64).tobytes()],
        })

    schema = "unit string, keys array<string>, place binary, bins binary, y binary, h binary"
    return cut(placed.drop("parts").groupBy("unit").applyInPandas(pack, schema))


def _drawn(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree, from its hash."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return np.searchsorted(_DRAWS, (x >> np.uint64(11)) / 2.0**53).astype(np.float64)


def _chosen(seed: int, tree: int, level: int, features: int, most: int) -> np.ndarray:
    """The features that each node of a level may be cut by."""
    rng = np.random.default_rng((seed, tree, level))
    return np.argsort(rng.random((1 << level, features)), axis=1)[:, :most]


def train_forest_per_key(
    df: DataFrame, key: str, label: str, columns: Sequence[str], trees: int = 100, depth: int = 5, seed: int = 42, bins: int = BINS,
    least: float = 1.0, block_rows: int = BLOCK_ROWS, features: int | None = None,
) -> KeyedForest:
    """A forest of ``trees`` per value of ``key`` for a label of 0 and 1; rows with a null key are left out.

    Each tree draws its rows by a Poisson number per row, each node may be cut by ``features`` columns (the root of their number, rounded
    up, by default), and a cut leaves at least ``least`` drawn rows on each side. The same rows give the same
    forests, however they lie.
    """
    columns = list(columns)
    width = len(columns)
    most = min(width, features or math.ceil(math.sqrt(width)))
    edges = _edges(df, columns, bins)
    blocks = _blocks(df, key, label, columns, edges, block_rows)
    units = cut(blocks.select("unit", F.explode("keys").alias("key")))
    grown: DataFrame | None = None

    def level_of(level: int):
        last = level == depth

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    keys, place = row["keys"], np.frombuffer(row["place"], np.int32)
                    binned = np.frombuffer(row["bins"], np.uint8).reshape(-1, width)
                    y, h = np.frombuffer(row["y"], np.float32), np.frombuffer(row["h"], np.int64)
                    # Cuts by (key, tree, node).
                    number = {k: i for i, k in enumerate(keys)}
                    by = np.full((len(keys), trees, (1 << level) - 1), -1, np.int16)
                    at = np.zeros((len(keys), trees, (1 << level) - 1), np.int16)
                    for s in row["cuts"] or ():
                        by[number[s["key"]], s["tree"], s["node"]], at[number[s["key"]], s["tree"], s["node"]] = s["feature"], s["bin"]
                    for tree in range(trees):
                        weight = _drawn(h, tree, seed)
                        here, node = np.flatnonzero(weight), np.zeros(len(h), np.int64)
                        for _ in range(level):
                            feature = by[place[here], tree, node[here]]
                            here, feature = here[feature >= 0], feature[feature >= 0]
                            node[here] = 2 * node[here] + 1 + (binned[here, feature] > at[place[here], tree, node[here]])
                        if not len(here):
                            continue
                        local = node[here] - ((1 << level) - 1)
                        picked = np.zeros((1 << level, 1), np.int64) if last else _chosen(seed, tree, level, width, most)
                        columns_of = picked[local]
                        value = np.zeros_like(columns_of) if last else binned[here[:, None], columns_of]
                        code = (((place[here].astype(np.int64) << level) + local)[:, None] * width + columns_of) * 256 + value
                        codes, back = np.unique(code.ravel(), return_inverse=True)
                        w = np.repeat(weight[here], code.shape[1])
                        n = np.bincount(back, w, len(codes))
                        positive = np.bincount(back, w * np.repeat(y[here], code.shape[1]), len(codes))
                        rest, value = np.divmod(codes, 256)
                        rest, feature = np.divmod(rest, width)
                        owner, local = np.divmod(rest, 1 << level)
                        names = pa.DictionaryArray.from_arrays(pa.array(owner.astype(np.int32)), pa.array(keys, pa.string())).cast(pa.string())
                        size = len(codes)
                        yield pa.RecordBatch.from_arrays(
                            [names, pa.array(np.full(size, tree, np.int32)), pa.array((local + (1 << level) - 1).astype(np.int32)), pa.array(feature.astype(np.int32)),
                             pa.array(value.astype(np.int32)), pa.array(n), pa.array(positive)],
                            ["key", "tree", "node", "feature", "bin", "n", "positive"],
                        )

        return histograms

    def best(last: bool):
        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            """The best cut of each node of a key: the largest fall of the Gini impurity, ties to the smaller feature and bin."""
            pdf = pdf.sort_values(["tree", "node", "feature", "bin"], ignore_index=True)
            nodes = pdf.groupby(["tree", "node", "feature"], sort=False)
            n, p = pdf["n"], pdf["positive"]
            left_n, left_p = nodes["n"].cumsum(), nodes["positive"].cumsum()
            all_n, all_p = nodes["n"].transform("sum"), nodes["positive"].transform("sum")
            right_n, right_p = all_n - left_n, all_p - left_p
            with np.errstate(divide="ignore", invalid="ignore"):
                # Twice the sum of n p (1 - p) over both sides, less that of the node.
                impurity = lambda a, b: np.where(a > 0, b * (a - b) / np.where(a > 0, a, 1), 0.0)
                gain = impurity(all_n, all_p) - impurity(left_n, left_p) - impurity(right_n, right_p)
            gain = np.where((left_n >= least) & (right_n >= least), gain, -1.0)
            pdf = pdf.assign(gain=np.round(gain, 9), all_n=all_n, all_p=all_p)
            top = pdf.loc[pdf.groupby(["tree", "node"], sort=False)["gain"].idxmax()]
            split = (top["gain"] > 1e-9) & (not last)
            return pd.DataFrame({
                "key": top["key"], "tree": top["tree"].astype("int32"), "node": top["node"].astype("int32"), "feature": np.where(split, top["feature"], -1).astype("int32"),
                "bin": np.where(split, top["bin"], 0).astype("int32"), "n": top["all_n"], "p": top["all_p"] / top["all_n"],
            })

        return choose

    for level in range(depth + 1):
        if grown is None:
            met = blocks.withColumn("cuts", F.lit(None).cast("array<struct<key:string,tree:int,node:int,feature:int,bin:int>>"))
        else:
            cuts = units.join(grown.where("feature >= 0"), "key").groupBy("unit").agg(F.collect_list(F.struct("key", "tree", "node", "feature", "bin")).alias("cuts"))
            met = blocks.join(cuts, "unit")
        seen = met.select("keys", "place", "bins", "y", "h", "cuts").mapInArrow(level_of(level), "key string, tree int, node int, feature int, bin int, n double, positive double")
        summed = seen.groupBy("key", "tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
        new = summed.groupBy("key").applyInPandas(best(level == depth), "key string, tree int, node int, feature int, bin int, n double, p double")
        grown = cut(new if grown is None else grown.unionByName(new))
    used = cut(blocks.select(F.explode("keys").alias("key")).distinct())
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n_used"), F.sum(F.col(label).cast("double")).cast("long").alias("n_positive"))

    def assemble(pdf: pd.DataFrame) -> pd.DataFrame:
        made = []
        for _, tree in pdf.groupby("tree"):
            size = int(tree["node"].max()) + 1
            feature, at, p = np.full(size, -1), np.zeros(size), np.zeros(size)
            node, by = tree["node"].to_numpy(), tree["feature"].to_numpy()
            feature[node], p[node] = by, tree["p"].to_numpy()
            at[node] = [edges[f][b] if f >= 0 and b < len(edges[f]) else 0.0 for f, b in zip(by, tree["bin"])]
            made.append({"feature": feature.tolist(), "cut": at.tolist(), "p": p.tolist()})
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "trees": [made]})

    forests = grown.groupBy("key").applyInPandas(assemble, "key string, trees array<struct<feature:array<int>,cut:array<double>,p:array<double>>>")
    models = cut(counts.join(used, "key").join(forests, "key").select("key", "n_used", "n_positive", "trees"))
    return KeyedForest(key, tuple(columns), depth, models)
