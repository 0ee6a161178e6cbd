"""Near-duplicate vectors by tiles in the order of principal components.

Vectors of equal label are turned to principal axes and cut into tiles along the first. Two tiles meet only if
their boxes over the leading axes are near enough. Within a pair of tiles products are summed axis block by axis
block, the leading ones first; what the rest can add is bounded by the product of the suffix norms, and rows
leave as soon as no partner can reach the threshold. Pairs near the threshold are computed on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.llm.components import components, lowest_labels
from devicelens.llm.support import small_batches
from devicelens.llm.vectors import content_key, principal_axes, unblob, usable
from devicelens.session import cut

#: Vectors of a tile, axes of its box, axes added per step.
TILE, BOX, STEP = 2_000, 8, 16


def links_between(a: np.ndarray, b: np.ndarray, turned: np.ndarray, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places (row of ``a``, row of ``b``) with cosine at or above the threshold; ``turned`` are the principal axes."""
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    x, y = (a / norm_a[:, None]) @ turned, (b / norm_b[:, None]) @ turned
    # Norms of what follows axis k: what the axes from k on can add to a product at most.
    rest = lambda z: np.sqrt(np.maximum(0, np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1]))
    rest_x, rest_y = rest(x), rest(y)
    rows, columns = np.arange(len(x)), np.arange(len(y))
    product, d, slack = np.zeros((len(x), len(y))), x.shape[1], 1e-9
    for k in range(0, d, step):
        product += x[rows, k : k + step] @ y[columns, k : k + step].T
        if k + step >= d:
            break
        possible = product + np.outer(rest_x[rows, k + step], rest_y[columns, k + step]) >= threshold - slack
        keep_rows, keep_columns = possible.any(1), possible.any(0)
        if not keep_rows.any():
            return np.zeros(0, int), np.zeros(0, int)
        if keep_rows.mean() * keep_columns.mean() < 0.8:
            product = product[np.ix_(keep_rows, keep_columns)]
            rows, columns = rows[keep_rows], columns[keep_columns]
    i, j = np.nonzero(product >= threshold - slack)
    near = product[i, j] < threshold + slack
    r, c = rows[i], columns[j]
    good = np.ones(len(r), bool)
    if near.any():
        p, q = r[near], c[near]
        good[near] = (a[p] * b[q]).sum(1) / (norm_a[p] * norm_b[q]) >= threshold
    return r[good], c[good]


def near_vectors(rows: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", tile: int = TILE) -> DataFrame:
    """The id, ``n_links``, ``component_id``, ``kept`` of every row.

    Vectors link if their labels are equal and not null, they have as many components, and their cosine reaches the
    threshold. A vector that is null, zero or holds null or non-finite components links with nothing, nor does a row
    with a null id or label: 0 links, its own id as component. Equal vectors of a label are compared once and count as often
    as they occur, so repeated rows are links of each other. An empty table gives no rows; other columns are not read.
    ``kept`` is whether the id is its component's smallest.
    """
    every = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    takes_part = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    every = cut(every.withColumn("key", F.when(takes_part, content_key(F.col("vector")))))
    valid = every.where("key is not null")
    names = valid.groupBy("label", "key").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    distinct = valid.join(names.select(F.col("node").alias("id"), "label", "key", "copies"), ["id", "label", "key"]).dropDuplicates(["label", "key"])
    distinct = cut(distinct.select(F.col("id").alias("node"), "label", "copies", "vector", F.size("vector").alias("d")))
    axes = principal_axes(distinct)
    shared = distinct.sparkSession.sparkContext.broadcast(axes)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = {d: v[:, 0] for d, v in shared.value.items()}
        for batch in batches:
            vectors = [np.array(v.as_py()) for v in batch.column(2)]
            value = [float(v @ first[len(v)] / np.linalg.norm(v)) for v in vectors]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(value, pa.float64())], ["node", "label", "d", "lead"])

    kind = distinct.schema["label"].dataType.simpleString()
    led = cut(distinct.select("node", "label", "vector", "d").mapInArrow(lead, f"node long, label {kind}, d int, lead double"))
    most = led.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // tile))
    cuts = led.groupBy("label", "d").agg(F.percentile_approx("lead", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("cuts"))
    placed = led.join(cuts, ["label", "d"]).withColumn("range", F.size(F.filter("cuts", lambda x: x < F.col("lead"))) if parts > 1 else F.lit(0))
    held = placed.groupBy("label", "d", "range").agg(F.ceil(F.count("*") / tile).cast("int").alias("sub"))
    placed = placed.join(held, ["label", "d", "range"]).select("node", F.struct("range", F.pmod(F.xxhash64("node"), F.col("sub")).alias("sub")).alias("tile"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["vector"].tolist(), dtype=np.float64)
        turned = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ shared.value[x.shape[1]][:, :BOX]
        return pd.DataFrame(
            {
                "label": [pdf["label"].iloc[0]],
                "d": [x.shape[1]],
                "tile": [f"{pdf['range'].iloc[0]:012d}-{pdf['sub'].iloc[0]:06d}"],
                "low": [turned.min(0).tolist()],
                "high": [turned.max(0).tolist()],
                "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
                "copies": [pdf["copies"].to_numpy(np.int64).tobytes()],
                "data": [x.tobytes()],
            }
        )

    schema = f"label {kind}, d int, tile string, low array<double>, high array<double>, nodes binary, copies binary, data binary"
    flat = distinct.join(placed, "node").select("node", "label", "d", "copies", "vector", F.col("tile.range").alias("range"), F.col("tile.sub").alias("sub"))
    tiles = cut(flat.groupBy("label", "d", "range", "sub").applyInPandas(pack, schema))
    a, b = tiles.select("label", "d", F.col("tile").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i")), tiles.select("label", "d", F.col("tile").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    gaps = F.zip_with(
        F.zip_with("low_i", "high_j", lambda p, q: p - q), F.zip_with("low_j", "high_i", lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0))
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = a.join(b, ["label", "d"]).where("i <= j").where(apart <= 2 - 2 * threshold + 1e-9).select("label", "d", "i", "j")
    side = lambda s: tiles.select("label", "d", F.col("tile").alias(s), F.struct("nodes", "copies", "data").alias(f"{s}_data"))
    met = pairs.join(side("i"), ["label", "d", "i"]).join(side("j"), ["label", "d", "j"]).select("i", "j", "i_data", "j_data")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = [np.frombuffer(row[s]["nodes"], np.int64) for s in ("i_data", "j_data")]
                copies = [np.frombuffer(row[s]["copies"], np.int64) for s in ("i_data", "j_data")]
                x, y = (unblob(row[s]["data"], len(n)) for s, n in zip(("i_data", "j_data"), nodes))
                r, c = links_between(x, y, shared.value[x.shape[1]], threshold)
                if row["i"] == row["j"]:
                    r, c = r[r < c], c[r < c]
                # Numbered in the order of their ids, the smallest of a component is its smallest id.
                names, place = np.unique(np.concatenate(nodes), return_inverse=True)
                p, q = place[r], place[len(nodes[0]) + c]
                count = np.bincount(p, copies[1][c], len(names)) + np.bincount(q, copies[0][r], len(names))
                root = names[lowest_labels(len(names), p, q)]
                seen = count > 0
                yield pa.RecordBatch.from_arrays([pa.array(names[seen]), pa.array(count[seen].astype(np.int64)), pa.array(root[seen])], ["node", "links", "root"])

    with small_batches(rows.sparkSession):
        found = cut(met.mapInArrow(compare, "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.select("node", "root"))
    named = names.join(links, "node", "left").join(grouped, "node", "left")
    named = named.select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    result = every.join(named, ["label", "key"], "left")
    component = F.coalesce("component_id", "id")
    return result.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
