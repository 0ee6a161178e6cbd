"""Nearest neighbours within one table, without comparing all pairs.

Equal vectors collapse to one point that keeps its k+1 lowest ids: no more can be among anyone's
neighbours, so a large group of copies costs nothing. Distances are Euclidean; equal ones are ordered by id.

:func:`knn_self` is exact, and meant for few or correlated columns:

1. The points are cut into tiles of about ``rows_per_tile`` by sorting on one coordinate after the other
   (sort-tile-recursive packing), with the block splitting of :mod:`devicelens.operators.ordered`.
2. Each tile answers its own points. The distance to the last neighbour found bounds the search.
3. Tiles find the tiles within the reach of their points by going down the slabs, level by level, as joins of
   boxes. Points visit those nearer than their own reach, packed in arrays; a busy tile is served in several parts.

In many columns nearly all tiles are in reach. There :func:`knn_forest` looks at a fixed number of leaves per point: one
in each of some random-projection trees. A tree cuts its cells at medians along random directions. Cells beyond one task's size
are cut in rounds, each cell by quantiles of a sample of its own, so that no step needs all points, or one table of all cells.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import BLOCK, ordered
from devicelens.session import cut

ROWS_PER_TILE = 2000
VISITS_PER_PART = 20_000
CHUNK = 256
#: Trees of a forest, points of a leaf, points that one task cuts into leaves, cells of a round, and sampled points per cell.
TREES, LEAF, CELL, FAN, PER_CELL = 12, 4_096, 16_384, 256, 64


def tile(points: DataFrame, columns: Sequence[str], tie: str, rows_per_tile: int, n: int) -> tuple[DataFrame, list[str]]:
    """Add columns that together name a box of about ``rows_per_tile`` points: slabs, slabs of these, and so on."""
    levels = 3
    tiles = max(1, math.ceil(n / rows_per_tile))
    if tiles == 1:
        return points.withColumn("_slab0", F.lit(0)), ["_slab0"]
    slabs = tiles ** (1 / levels)
    keys: list[str] = []
    rows = n
    for level in range(levels):
        column = columns[level % len(columns)]
        rows = max(1, math.ceil(rows / slabs))
        frame = ordered(points, keys, [column, tie], rows)
        name = f"_slab{level}"
        df = frame.df if frame.split else frame.df.withColumn(BLOCK, F.lit(0))
        points = df.withColumnRenamed(BLOCK, name).drop("_hot", "_all")
        keys.append(name)
    return points, keys


def _best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k nearest of the candidates (ids ascending) as positions and squared distances."""
    centre = vectors.mean(axis=0)
    q, v = queries - centre, vectors - centre
    size_q, size_v = (q * q).sum(axis=1), (v * v).sum(axis=1)
    rough = size_q[:, None] + size_v[None, :] - 2 * (q @ v.T)
    k = min(k, len(vectors))
    # All candidates up to the k-th distance, ties included, with room for the rounding of the product form; then
    # only those few are computed column by column and sorted.
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + 1e-12 * (size_q + size_v.max()) * q.shape[1]
    row, column = np.nonzero(rough <= limit[:, None])
    d = np.zeros(len(row))
    for j in range(queries.shape[1]):
        gap = queries[row, j] - vectors[column, j]
        d += gap * gap
    order = np.lexsort((column, d, row))
    start = np.searchsorted(row, np.arange(len(queries)))
    picked = order[start[:, None] + np.arange(k)[None, :]]
    return column[picked], d[picked]


def _box_distance(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box; never above that of a point inside."""
    distance = np.zeros((len(queries), len(low)))
    for j in range(queries.shape[1]):
        q = queries[:, j, None]
        gap = np.maximum(np.maximum(low[None, :, j] - q, q - high[None, :, j]), 0.0)
        distance += gap * gap
    return distance


def distinct_points(df: DataFrame, columns: Sequence[str], ident: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows as ``_id`` and doubles, and one point per vector (``_point``, the columns, ``_ids``)."""
    rows = df.select(F.col(ident).cast("long").alias("_id"), *[F.col(c).cast("double").alias(c) for c in columns])
    # The k+1 lowest ids per vector; the rank filter acts before the shuffle too.
    by_vector = Window.partitionBy(*columns).orderBy("_id")
    lowest = rows.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1)
    points = lowest.groupBy(*columns).agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
    return rows, cut(points.withColumn("_point", F.element_at("_ids", 1)))


def candidates(pdf: pd.DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some points in ascending order, and the vector of each."""
    counts = pdf["_ids"].map(len).to_numpy()
    ids = np.concatenate([np.asarray(v, dtype=np.int64) for v in pdf["_ids"]])
    vectors = np.repeat(pdf[list(columns)].to_numpy(dtype=float), counts, axis=0)
    order = np.argsort(ids, kind="stable")
    return ids[order], vectors[order]


def nearest_of(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list]:
    """Per query the ids and squared distances of its k nearest candidates, as one array each."""
    near, far = [], []
    for start in range(0, len(queries), CHUNK):
        i, d = _best(queries[start : start + CHUNK], vectors, ids, k)
        near += list(ids[i])
        far += list(d)
    return near, far


def _ranked(rows: DataFrame, points: DataFrame, answers: DataFrame, columns: Sequence[str], ident: str, k: int) -> DataFrame:
    """From answers per point (``_point, _near, _far``) to the k nearest others of every row."""
    each = answers.select("_point", F.inline(F.arrays_zip(F.col("_near").alias("i"), F.col("_far").alias("d"))))
    # A neighbour may come more than once; the rank filter acts before the shuffle too.
    best = Window.partitionBy("_point").orderBy("d", "i")
    kept = each.withColumn("_n", F.dense_rank().over(best)).where(F.col("_n") <= k + 1)
    lists = kept.groupBy("_point").agg(F.array_sort(F.collect_set(F.struct("d", "i"))).alias("_list"))
    with_lists = cut(lookup(points.select(*columns, "_point"), lists, ["_point"], "inner").drop("_point"))
    answered = lookup(rows, with_lists, columns, "inner", materialise=False)
    others = F.slice(F.filter("_list", lambda x: x["i"] != F.col("_id")), 1, k)
    return answered.select(F.col("_id").alias(ident), F.posexplode(others).alias("_r", "_x")).select(
        ident, F.col("_x.i").alias("neighbour_id"), (F.col("_r") + 1).alias("rank"), F.sqrt("_x.d").alias("distance")
    )


def knn_self(df: DataFrame, columns: Sequence[str], ident: str, k: int = 5, rows_per_tile: int = ROWS_PER_TILE) -> DataFrame:
    """``(id, neighbour_id, rank, distance)`` with the k nearest other rows of each row.

    ``ident`` must be unique, the columns must be without nulls.
    """
    columns = list(columns)
    rows, points = distinct_points(df, columns, ident, k)
    n = points.count()
    # Tiles along the columns that vary most.
    spread = points.agg(*[F.coalesce(F.var_pop(c), F.lit(0.0)).alias(str(i)) for i, c in enumerate(columns)]).first()
    widest = sorted(columns, key=lambda c: -spread[columns.index(c)])
    points, keys = tile(points, widest, "_point", rows_per_tile, n)
    several = n > rows_per_tile
    if several:
        points = cut(points)

    def own_tile(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = candidates(pdf, columns)
        near, far = nearest_of(pdf[columns].to_numpy(dtype=float), vectors, ids, k + 1)
        reach = [float(d[-1]) if len(d) == k + 1 else np.inf for d in far]
        return pdf[[*keys, "_point", *columns]].assign(_reach=reach, _near=near, _far=far)

    vector = ", ".join(f"`{c}` double" for c in columns)
    slabs = ", ".join(f"{key} int" for key in keys)
    found = points.groupBy(*keys).applyInPandas(own_tile, f"{slabs}, _point long, {vector}, _reach double, _near array<long>, _far array<double>")
    answers = found
    if several:
        found = cut(found)
        visited = _visit(points, _visits(found, columns, keys), columns, keys, k)
        answers = found.select("_point", "_near", "_far").unionByName(visited)
    return _ranked(rows, points, answers, columns, ident, k)


def _visits(found: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Visitors of each tile (``keys``): points that may find better neighbours there, packed in arrays."""
    edges = [f(c).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("lo", F.min), ("hi", F.max))]
    boxes = cut(found.groupBy(*keys).agg(*edges, F.max("_reach").alias("_reach")))
    sides = [f"{p}{i}" for i in range(len(columns)) for p in ("lo", "hi")]
    # A tile of the first side looks for tiles of the second, slab by slab.
    asking = boxes.withColumnsRenamed({s: "q_" + s for s in sides} | {k: "q_" + k for k in keys}).withColumnRenamed("_reach", "q_reach")
    for level in range(1, len(keys) + 1):
        merged = [(F.min if s.startswith("lo") else F.max)(s).alias(s) for s in sides]
        nodes = boxes if level == len(keys) else boxes.groupBy(*keys[:level]).agg(*merged)
        apart = F.lit(0.0)
        for i in range(len(columns)):
            gap = F.greatest(F.col(f"lo{i}") - F.col(f"q_hi{i}"), F.col(f"q_lo{i}") - F.col(f"hi{i}"), F.lit(0.0))
            apart = apart + gap * gap
        near = apart <= F.col("q_reach") * (1 + 1e-9)
        if level == 1:
            # As many slabs as the cube root of the tiles.
            asking = asking.join(F.broadcast(nodes.select(keys[0], *sides)), near)
        else:
            asking = asking.drop(*sides).join(nodes.select(*keys[:level], *sides), keys[: level - 1]).where(near)
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col("q_" + key))
    pairs = asking.where(~same).select(*keys, *["q_" + k for k in keys], *sides)

    def choose(key, points: pd.DataFrame, tiles: pd.DataFrame) -> pd.DataFrame:
        out = []
        asked, marks, reach = points[columns].to_numpy(dtype=float), points["_point"].to_numpy(), points["_reach"].to_numpy()
        low, high = (tiles[[f"{p}{i}" for i in range(len(columns))]].to_numpy(dtype=float) for p in ("lo", "hi"))
        names = list(tiles[keys].itertuples(index=False, name=None))
        for t in range(len(tiles) if len(points) else 0):
            visits = np.flatnonzero(_box_distance(asked, low[t : t + 1], high[t : t + 1])[:, 0] <= reach)
            if len(visits):
                out.append((*names[t], marks[visits], asked[visits].ravel()))
        return pd.DataFrame(out, columns=[*keys, "_points", "_vectors"])

    points = found.select(*keys, "_point", *columns, "_reach")
    schema = ", ".join(f"{key} int" for key in keys) + ", _points array<long>, _vectors array<double>"
    return cut(points.groupBy(*keys).cogroup(pairs.groupBy(*["q_" + k for k in keys])).applyInPandas(choose, schema))


def _visit(points: DataFrame, visits: DataFrame, columns: list[str], keys: list[str], k: int) -> DataFrame:
    """Answers of the visited tiles. A tile with many visitors is copied, one copy per part of them."""
    parts = visits.groupBy(*keys).agg(F.ceil(F.sum(F.size("_points")) / VISITS_PER_PART).cast("int").alias("_parts"))
    parts = cut(parts)
    split = lookup(visits, parts, keys, "inner", materialise=False)
    split = split.withColumn("_part", F.pmod(F.xxhash64("_points"), F.col("_parts")).cast("int")).drop("_parts")
    copies = lookup(points, parts, keys, "inner", materialise=False)
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")

    def serve(_key, visitors: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        if not len(visitors) or not len(hosts):
            return pd.DataFrame({"_point": [], "_near": [], "_far": []})
        ids, vectors = candidates(hosts, columns)
        asked = np.concatenate(visitors["_vectors"].tolist()).reshape(-1, len(columns))
        near, far = nearest_of(asked, vectors, ids, k + 1)
        return pd.DataFrame({"_point": np.concatenate(visitors["_points"].tolist()), "_near": near, "_far": far})

    return split.groupBy(*keys, "_part").cogroup(copies.groupBy(*keys, "_part")).applyInPandas(serve, "_point long, _near array<long>, _far array<double>")


# -- forest of random-projection trees ----------------------------------------------------------------


def _direction(seed: int, tree: int, cell: int, place: int, d: int) -> np.ndarray:
    """The direction in which a place of a cell's own tree is cut."""
    return np.random.default_rng((seed, tree, cell & 0x7FFFFFFFFFFFFFFF, place)).normal(size=d)


def _cuts(x: np.ndarray, levels: int, seed: int, tree: int, cell: int) -> np.ndarray:
    """Medians of a complete tree of so many levels, each of the points that come to its place."""
    cuts, at = np.zeros((1 << levels) - 1), np.zeros(len(x), np.int64)
    for place in range(len(cuts)):
        here = np.flatnonzero(at == place)
        if len(here):
            along = x[here] @ _direction(seed, tree, cell, place, x.shape[1])
            cuts[place] = np.median(along)
            at[here] = 2 * place + 1 + (along > cuts[place])
    return cuts


def _leaf_of(x: np.ndarray, cuts: np.ndarray, seed: int, tree: int, cell: int) -> np.ndarray:
    """Number of the leaf that each point comes to."""
    at = np.zeros(len(x), np.int64)
    for place in range(len(cuts)):
        here = np.flatnonzero(at == place)
        if len(here):
            at[here] = 2 * place + 1 + (x[here] @ _direction(seed, tree, cell, place, x.shape[1]) > cuts[place])
    return at - len(cuts)


def _halves(x: np.ndarray, most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Places of the points, cut at medians along random directions into leaves of at most so many."""
    todo, done = [np.arange(len(x))], []
    while todo:
        here = todo.pop()
        if len(here) <= most:
            done.append(here)
            continue
        order = here[np.argsort(x[here] @ rng.normal(size=x.shape[1]), kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return done


def knn_forest(
    df: DataFrame, columns: Sequence[str], ident: str, k: int = 5, trees: int = TREES, leaf: int = LEAF, cell: int = CELL, seed: int = 0
) -> DataFrame:
    """``(id, neighbour_id, rank, distance)`` with the k nearest other rows among those of some leaf of the row.

    Each point is compared with the points of one leaf per tree, however many points there are; true neighbours can be missed,
    the more the more directions the data have. ``ident`` must be unique, the columns must be without nulls. Cells above ``cell`` points
    are cut in rounds of up to ``FAN`` parts each; a task cuts the rest into leaves of at most ``leaf`` points.
    """
    columns = list(columns)
    rows, points = distinct_points(df, columns, ident, k)
    d, spark = len(columns), df.sparkSession
    vector = F.array(*columns).alias("_v")
    state = points.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("_tree"), F.lit(0).cast("long").alias("_cell"), "_point", vector, "_ids")
    schema = "_tree int, _cell long, _point long, _v array<double>, _ids array<long>"
    whole = points.count()
    sizes = spark.range(trees).select(F.col("id").cast("int").alias("_tree"), F.lit(0).cast("long").alias("_cell"), F.lit(whole).alias("_n"))
    for _ in range(64):
        large = cut(sizes.where(F.col("_n") > cell))
        if large.isEmpty():
            break
        levels = F.least(F.ceil(F.log2(F.col("_n") / cell)), F.lit(int(math.log2(FAN)))).cast("int")
        large = large.withColumn("_levels", F.greatest(levels, F.lit(1)))
        # A sample of each cell, by a hash of the point, makes the cuts of the cell.
        share = PER_CELL * F.pow(F.lit(2.0), F.col("_levels")) / F.col("_n")
        drawn = lookup(state, large, ["_tree", "_cell"], "inner", materialise=False)
        drawn = drawn.where(F.pmod(F.xxhash64("_point", "_tree"), F.lit(1 << 30)) < share * (1 << 30)).select("_tree", "_cell", "_v", "_levels")

        def cuts_of(pdf: pd.DataFrame) -> pd.DataFrame:
            tree, at = int(pdf["_tree"].iloc[0]), int(pdf["_cell"].iloc[0])
            x = np.array(pdf["_v"].tolist(), dtype=float)
            return pd.DataFrame({"_tree": [tree], "_cell": [at], "_cuts": [_cuts(x, int(pdf["_levels"].iloc[0]), seed, tree, at)]})

        cuts = cut(drawn.groupBy("_tree", "_cell").applyInPandas(cuts_of, "_tree int, _cell long, _cuts array<double>"))
        parts = large.select("_tree", "_cell", F.ceil(F.col("_n") / cell).cast("int").alias("_parts"))
        parts = cut(parts.join(cuts, ["_tree", "_cell"]))
        marked = lookup(state, parts.drop("_cuts"), ["_tree", "_cell"], "left", materialise=False)
        still = marked.where(F.col("_parts").isNull()).drop("_parts")
        open_ = marked.where(F.col("_parts").isNotNull()).withColumn("_part", F.pmod(F.xxhash64("_point"), F.col("_parts")).cast("int"))
        spread = parts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        spread = spread.select(F.col("_tree").alias("_t"), F.col("_cell").alias("_c"), F.col("_part").alias("_p"), "_cuts")

        def descend(key, pdf: pd.DataFrame, by: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf) or not len(by):
                return pdf[["_tree", "_cell", "_point", "_v", "_ids"]].iloc[:0]
            tree, at = int(key[0]), int(key[1])
            leaves = _leaf_of(np.array(pdf["_v"].tolist(), dtype=float), np.asarray(by["_cuts"].iloc[0]), seed, tree, at)
            # A cell's name is a hash of its path: 63 bits, and equal names in one tree would only join two cells.
            names = np.array([hash((at, int(n))) & 0x7FFFFFFFFFFFFFFF for n in range(int(leaves.max()) + 1)], np.int64)
            return pdf.assign(_cell=names[leaves])[["_tree", "_cell", "_point", "_v", "_ids"]]

        moved = open_.groupBy("_tree", "_cell", "_part").cogroup(spread.groupBy("_t", "_c", "_p")).applyInPandas(descend, schema)
        state = cut(still.unionByName(moved))
        sizes = state.groupBy("_tree", "_cell").agg(F.count(F.lit(1)).alias("_n"))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["_v"].tolist(), dtype=float)
        marks = pdf["_point"].to_numpy()
        points, near, far = [], [], []
        for here in _halves(x, leaf, np.random.default_rng((seed, int(pdf["_tree"].iloc[0]), int(marks.min()) & 0x7FFFFFFFFFFFFFFF))):
            ids = pdf["_ids"].iloc[here]
            counts = ids.map(len).to_numpy()
            flat, vectors = np.concatenate(ids.tolist()).astype(np.int64), np.repeat(x[here], counts, axis=0)
            order = np.argsort(flat, kind="stable")
            i, f = nearest_of(x[here], vectors[order], flat[order], k + 1)
            points.append(marks[here])
            near += i
            far += f
        return pd.DataFrame({"_point": np.concatenate(points), "_near": near, "_far": far})

    found = state.groupBy("_tree", "_cell").applyInPandas(answer, "_point long, _near array<long>, _far array<double>")
    return _ranked(rows, points, found, columns, ident, k)
