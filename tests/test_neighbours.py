"""Exact neighbours and oversampling against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators import neighbours as module
from devicelens.operators.neighbours import knn_forest, knn_self
from devicelens.plans.oversample import smote


def points(seed=0, n=700):
    """Clusters of unequal density, one vector with many copies, rounded so that distances tie."""
    rng = np.random.default_rng(seed)
    xyz = np.vstack([rng.normal(0, 1, (n // 2, 3)), rng.normal(20, 8, (n // 2, 3))]).round(1)
    xyz[50:280] = [0.5, 0.5, 0.5]
    ids = rng.permutation(n) * 3 + 1
    return pd.DataFrame({"id": ids, "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2]})


def brute(pdf, columns, k):
    v, ids = pdf[columns].to_numpy(), pdf["id"].to_numpy()
    out = {}
    for i in range(len(v)):
        gap = v[i] - v
        d = sum(gap[:, j] ** 2 for j in range(len(columns)))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[ids[i]] = [(ids[j], r + 1, np.sqrt(d[j])) for r, j in enumerate(order)]
    return out


@pytest.mark.parametrize("rows_per_tile,columns", [(2000, ["x", "y", "z"]), (20, ["x", "y", "z"]), (9, ["x", "y"]), (15, ["x"])])
def test_knn_is_exact(spark, rows_per_tile, columns):
    pdf = points()
    found = knn_self(spark.createDataFrame(pdf).repartition(4), columns, "id", 4, rows_per_tile).toPandas()
    expected = brute(pdf, columns, 4)
    assert len(found) == 4 * len(pdf)
    for ident, group in found.sort_values("rank").groupby("id"):
        got = list(zip(group["neighbour_id"], group["rank"]))
        assert got == [(i, r) for i, r, _ in expected[ident]]
        np.testing.assert_allclose(group["distance"], [d for _, _, d in expected[ident]], atol=1e-12)


def test_smote_parity_and_position(spark):
    pdf = points(1, 300)
    pdf["defect"] = (pdf.index % 7 == 0).astype("int32")
    made = smote(spark.createDataFrame(pdf), "defect", ["x", "y", "z"], "id", k=3, rows_per_tile=10)
    balance = {r["defect"]: r["count"] for r in made.groupBy("defect").count().collect()}
    assert balance[0] == balance[1] == (pdf["defect"] == 0).sum()
    rare = pdf[pdf["defect"] == 1]
    near = brute(rare.reset_index(drop=True), ["x", "y", "z"], 3)
    v = rare.set_index("id")[["x", "y", "z"]]
    pairs = [(v.loc[a].to_numpy(), v.loc[b].to_numpy()) for a, bs in near.items() for b, _, _ in bs]
    for s in made.where(F.col("synthetic")).toPandas()[["x", "y", "z"]].to_numpy():
        detour = min(np.linalg.norm(s - a) + np.linalg.norm(s - b) - np.linalg.norm(a - b) for a, b in pairs)
        assert detour < 1e-9


def random_points(spark, n, d, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    columns = [f"c{j}" for j in range(d)]
    pdf = pd.DataFrame(x, columns=columns).assign(id=rng.permutation(n) * 2)
    return pdf, columns, spark.createDataFrame(pdf).repartition(8)


def recall_of(found, pdf, columns, k, queries=150):
    x, ids = pdf[columns].to_numpy(), pdf["id"].to_numpy()
    got = found.groupby("id")["neighbour_id"].agg(set)
    hits = 0
    for i in range(queries):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        hits += len(got.get(ids[i], set()) & set(ids[np.argsort(d)[:k]]))
    return hits / (queries * k)


def test_forest_finds_neighbours_in_many_columns(spark):
    """28 columns without any structure, where every tile would be in reach of every point."""
    pdf, columns, df = random_points(spark, 12_000, 28)
    found = knn_forest(df, columns, "id", 5, cell=6_000, leaf=3_000).toPandas()
    assert (found.groupby("id").size() == 5).all() and found["id"].nunique() == len(pdf)
    assert recall_of(found, pdf, columns, 5) >= 0.9
    vectors = pdf.set_index("id")[columns]
    some = found.head(500)
    gap = vectors.loc[some["id"]].to_numpy() - vectors.loc[some["neighbour_id"]].to_numpy()
    np.testing.assert_allclose(some["distance"], np.sqrt((gap * gap).sum(axis=1)), atol=1e-9)


def test_forest_cuts_cells_in_rounds(spark, monkeypatch):
    """Cells of two parts per round, so that there are several rounds, in few columns that the trees follow well."""
    monkeypatch.setattr(module, "FAN", 4)
    pdf, columns, df = random_points(spark, 3_000, 3)
    found = knn_forest(df, columns, "id", 4, trees=8, cell=150, leaf=100).toPandas()
    assert recall_of(found, pdf, columns, 4) >= 0.9


def test_forest_with_copies(spark):
    pdf = points()
    found = knn_forest(spark.createDataFrame(pdf).repartition(4), ["x", "y", "z"], "id", 4).toPandas()
    expected = brute(pdf, ["x", "y", "z"], 4)
    for ident, group in found.sort_values("rank").groupby("id"):
        assert list(zip(group["neighbour_id"], group["rank"])) == [(i, r) for i, r, _ in expected[ident]]


def test_smote_by_forest_keeps_parity(spark):
    pdf = points(1, 300)
    pdf["defect"] = (pdf.index % 7 == 0).astype("int32")
    made = smote(spark.createDataFrame(pdf), "defect", ["x", "y", "z"], "id", k=3, search=knn_forest, trees=3)
    balance = {r["defect"]: r["count"] for r in made.groupBy("defect").count().collect()}
    assert balance[0] == balance[1]
