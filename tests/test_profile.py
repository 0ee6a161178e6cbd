"""Summaries and quantiles against pandas, also with many blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators import profile
from devicelens.operators.profile import (
    binary_metrics, check_expectations, describe, group_quantiles, null_counts, rate, rmse, table_stats, top_keys,
)
from devicelens.plans.features import center
from devicelens.plans.labeling import above_quantile, label_defects
from devicelens.operators.ordered import ordered


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(2)
    n = 900
    k = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abcde"), n))
    x = rng.normal(10, 3, n).round(1)
    x[rng.random(n) < 0.1] = np.nan
    x[:200] = 7.0  # one value on many rows
    return pd.DataFrame({"id": np.arange(n), "k": k, "x": x, "y": rng.integers(0, 2, n)})


@pytest.fixture(scope="module")
def sdf(spark, pdf):
    rows = [(int(i), k, None if np.isnan(x) else float(x), int(y)) for i, k, x, y in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, k string, x double, y int").repartition(6)


@pytest.mark.parametrize("rows_per_block", [2_000_000, 10])
def test_quantiles(sdf, pdf, rows_per_block):
    probs = {"p0": 0.0, "p25": 0.25, "p89": 0.89, "p93": 0.93, "p100": 1.0}
    got = group_quantiles(sdf, ["k"], "x", probs, rows_per_block=rows_per_block).toPandas().set_index("k").sort_index()
    expected = pdf.groupby("k")["x"].quantile(list(probs.values())).unstack()
    np.testing.assert_allclose(got[list(probs)].to_numpy(), expected.to_numpy(), rtol=1e-12)


def test_approximate_quantiles(sdf, pdf):
    got = group_quantiles(sdf, ["k"], "x", {"m": 0.5}, exact=False).toPandas().set_index("k")["m"].sort_index()
    np.testing.assert_allclose(got, pdf.groupby("k")["x"].median(), atol=0.2)


def test_describe(sdf, pdf):
    got = describe(sdf, ["x", "y"]).toPandas().set_index("column_name")
    for c in ("x", "y"):
        expected = pdf[c].describe()
        np.testing.assert_allclose(got.loc[c, ["n", "mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float), expected, rtol=1e-9)


def test_describe_large_table(spark):
    df = spark.range(60_000).select(((F.col("id") * 7919) % 60_000 / 7).alias("a"), F.when(F.col("id") % 3 == 0, 5).alias("b"))
    df = df.withColumn("c", F.lit(None).cast("double"))
    found = {}
    real = profile._ranked_in_brackets
    profile._ranked_in_brackets = lambda *args: found.setdefault("q", real(*args))
    try:
        got = describe(df, ["a", "b", "c"]).toPandas().set_index("column_name")
    finally:
        profile._ranked_in_brackets = real
    assert found["q"] is not None  # the brackets held all quartiles
    expected = df.select("a", "b").toPandas().describe()
    for c in ("a", "b"):
        np.testing.assert_allclose(got.loc[c, ["q25", "q50", "q75"]].astype(float), expected.loc[["25%", "50%", "75%"], c], rtol=1e-12)
    assert got.loc["c", "n"] == 0 and np.isnan(got.loc["c", "q50"])
    near = describe(df, ["a"], exact=False).toPandas().iloc[0]
    assert abs(near["q50"] - expected.loc["50%", "a"]) < 10


def test_counts_and_rates(spark, sdf, pdf):
    assert {r.column_name: r.n_null for r in null_counts(sdf).collect()}["x"] == pdf["x"].isna().sum()
    got = {r.k: r.rate for r in rate(sdf, F.col("y") == 1, ["k"]).collect()}
    np.testing.assert_allclose([got[k] for k in sorted(got)], pdf.groupby("k")["y"].mean())
    assert rate(spark.range(0).withColumn("y", F.lit(1)), F.col("y") == 1).first().rate == 0.0
    assert top_keys(sdf, F.col("y") == 1, "k").first().k == "hot"
    stats = table_stats(sdf, ["x"]).first()
    assert (stats.min_x, stats.max_x) == (pdf["x"].min(), pdf["x"].max())


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "p int, y int")
    row = binary_metrics(df, "p", "y").first()
    assert (row.tp, row.fp, row.fn, row.defects_predicted) == (2, 1, 1, 3)
    assert abs(row.f1 - 2 / 3) < 1e-12 and abs(row.recall - 2 / 3) < 1e-12
    none = binary_metrics(df.where("y = 0 and p = 0"), "p", "y").first()
    assert (none.recall, none.f1) == (0.0, 0.0)
    assert rmse(spark.createDataFrame([(1.0, 3.0), (2.0, None)], "p double, y double"), "p", "y").first().rmse == 2.0


def test_expectations_with_missing_metric(spark):
    metrics = spark.createDataFrame([(0.5, None)], "a double, b double")
    got = {r.rule: r.passed for r in check_expectations(metrics, {"low": ("a", "a < 1"), "unknown": ("b", "b > 0")}).collect()}
    assert got == {"low": True, "unknown": False}


def test_group_values(sdf, pdf):
    got = center(sdf, "x", ["k"], "c").orderBy("id").toPandas()["c"].astype(float)
    np.testing.assert_allclose(got, (pdf["x"] - pdf.groupby("k")["x"].transform("mean") / 2).abs())
    flags = above_quantile(sdf, ["k"], "x", 0.9, "f").orderBy("id").toPandas()["f"]
    expected = pdf["x"] > pdf.groupby("k")["x"].transform(lambda s: s.quantile(0.9))
    assert (flags.fillna(False).astype(bool) == expected).all()


@pytest.mark.parametrize("rows_per_block", [2_000_000, 25])
def test_labels_against_pandas(spark, rows_per_block):
    rng = np.random.default_rng(4)
    n = 600
    pdf = pd.DataFrame({"event_id": np.arange(n), "device_id": np.where(np.arange(n) % 3, "1", "2")})
    pdf["temperature"] = rng.normal(40, 6, n)
    pdf["factory_id"] = np.where(pdf["device_id"] == "1", "A06", "D18")
    pdf["model_id"] = np.where(pdf["device_id"] == "1", "SkyJet134", "SkyJet334")
    pdf["delay"], pdf["rotation_speed"] = rng.uniform(0, 50, n), rng.uniform(0, 900, n)
    pdf["density"], pdf["air_pressure"] = rng.uniform(0, 6, n), rng.uniform(700, 1100, n)
    frame = ordered(spark.createDataFrame(pdf), ["device_id"], ["event_id"], rows_per_block)
    got = label_defects(frame, outcomes=[1, 2, 3, 4, 5], rows_per_block=rows_per_block).orderBy("event_id").toPandas()["defect"]
    g = pdf.groupby("device_id")["temperature"]
    gap = pdf["temperature"] - g.transform(lambda s: s.shift(1).ewm(5).mean())
    p89, p93 = (g.transform(lambda s, q=q: s.quantile(q)) for q in (0.89, 0.93))
    conditions = [
        (gap > 1.8) & (pdf.factory_id == "A06") & (pdf.temperature > p89),
        (gap > 1.8) & (pdf.model_id == "SkyJet234") & (pdf.temperature > p89),
        (gap > 1.9) & (pdf.model_id == "SkyJet334") & (pdf.temperature > p93),
        (pdf.delay > 39) & (pdf.rotation_speed > 590),
        (pdf.density > 4.2) & (pdf.air_pressure < 780),
    ]
    assert (got == np.select(conditions, [1, 2, 3, 4, 5], default=0)).all()
