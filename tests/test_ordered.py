"""Ordered operators against pandas, with one block per key and with many small blocks."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators import ordered as module
from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import ordered

BLOCKS = [2_000_000, 7, 40]


def series_frame() -> pd.DataFrame:
    """A busy key, a small one, a null key, a key of one row; nulls at the head and in long runs."""
    rng = np.random.default_rng(3)
    parts = []
    for key, n in (("busy", 400), ("small", 9), ("one", 1), (None, 60)):
        x = rng.normal(50, 10, n).round(3)
        x[rng.random(n) < 0.3] = np.nan
        x[: min(3, n)] = np.nan
        if n == 400:
            x[100:190] = np.nan
        t = np.sort(rng.integers(0, max(2, n // 3), n))  # many equal times
        parts.append(pd.DataFrame({"k": key, "t": t, "day": t // 9, "x": x}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["id"] = np.arange(len(pdf))
    return pdf


@pytest.fixture(scope="module")
def pdf():
    return series_frame()


@pytest.fixture(scope="module")
def sdf(spark, pdf):
    rows = [
        (k, int(t), int(d), None if np.isnan(x) else float(x), int(i))
        for k, t, d, x, i in pdf[["k", "t", "day", "x", "id"]].itertuples(index=False)
    ]
    shuffled = [rows[i] for i in np.random.default_rng(1).permutation(len(rows))]
    return spark.createDataFrame(shuffled, "k string, t int, day int, x double, id long").repartition(5)


def by_id(df, *columns):
    out = df.select("id", *columns).toPandas().sort_values("id").reset_index(drop=True)
    return out[list(columns)].astype("float64")


def check(actual, expected):
    np.testing.assert_allclose(actual.to_numpy(), expected.to_numpy(dtype="float64"), rtol=1e-9, atol=1e-9)


def grouped(pdf, keys):
    return pdf.groupby(keys, dropna=False, group_keys=False)


@pytest.mark.parametrize("rows_per_block", BLOCKS)
def test_positions(sdf, pdf, rows_per_block):
    frame = ordered(sdf, ["k"], ["t", "id"], rows_per_block)
    assert frame.split == (rows_per_block < 400)
    frame = frame.row_number("n").row_number("m", ["day"]).dense_rank(F.col("day"), "r").scaled_position("s")
    frame = frame.running_sum("id", "c").group_sum(F.col("id"), "g")
    got = by_id(frame.result(), "n", "m", "r", "s", "c", "g")
    g = grouped(pdf, "k")
    size = g["id"].transform("size")
    expected = pd.DataFrame(
        {
            "n": g.cumcount() + 1,
            "m": grouped(pdf, ["k", "day"]).cumcount() + 1,
            "r": g["day"].rank("dense"),
            "s": np.where(size > 1, g.cumcount() * 10 / np.maximum(size - 1, 1), 0),
            "c": g["id"].cumsum(),
            "g": g["id"].transform("sum"),
        }
    )
    check(got, expected)


@pytest.mark.parametrize("rows_per_block", BLOCKS)
@pytest.mark.parametrize("within", [[], ["day"]])
def test_lags_and_fills(sdf, pdf, rows_per_block, within):
    frame = ordered(sdf, ["k"], ["t", "id"], rows_per_block)
    frame = frame.lags({"l1": ("x", 1), "l5": ("x", 5), "i3": ("id", 3)}, within)
    frame = frame.difference("id", 3, "d3", within).with_column("f", F.col("x")).with_column("b", F.col("x"))
    frame = frame.fill(["f"], ["ffill", 0], within).fill(["b"], ["bfill", "ffill", 0], within)
    got = by_id(frame.result(), "l1", "l5", "i3", "d3", "f", "b")
    g = grouped(pdf, ["k", *within])
    expected = pd.DataFrame(
        {
            "l1": g["x"].shift(1),
            "l5": g["x"].shift(5),
            "i3": g["id"].shift(3),
            "d3": g["id"].transform(lambda s: s.diff().diff().diff()),
            "f": g["x"].transform(lambda s: s.ffill().fillna(0)),
            "b": g["x"].transform(lambda s: s.bfill().ffill().fillna(0)),
        }
    )
    check(got, expected)


EWMA_CASES = [
    ({"com": 5}, 0, []),
    ({"com": 5}, 1, []),
    ({"com": 5}, 3, ["day"]),
    ({"com": 5}, 1, ["day"]),
    ({"span": 600}, 1, []),
    ({"span": 600}, 3, []),
    ({"com": 0.05}, 1, ["day"]),
    ({"com": 0}, 0, []),
]


@pytest.mark.parametrize("rows_per_block", [2_000_000, 7])
@pytest.mark.parametrize("decay,shift,within", EWMA_CASES)
def test_ewma(sdf, pdf, rows_per_block, within, decay, shift):
    frame = ordered(sdf, ["k"], ["t", "id"], rows_per_block).ewma("x", "y", shift=shift, within=within, **decay)
    got = by_id(frame.result(), "y")
    g = grouped(pdf, ["k", *within])
    expected = g["x"].transform(lambda s: s.shift(shift).ewm(**decay).mean()).to_frame("y")
    check(got, expected)


def test_ewma_long_series_does_not_overflow(spark):
    n = 9000
    pdf = pd.DataFrame({"id": np.arange(n), "x": np.random.default_rng(5).normal(50, 9, n)})
    pdf.loc[2000:5500, "x"] = np.nan
    sdf = spark.createDataFrame([(int(i), None if np.isnan(x) else float(x)) for i, x in pdf.itertuples(index=False)], "id long, x double")
    for rows_per_block in (2_000_000, 1000):
        got = by_id(ordered(sdf, [], ["id"], rows_per_block).ewma("x", "y", com=5, shift=0).result(), "y")
        check(got, pdf["x"].ewm(5).mean().to_frame("y"))


def test_many_cut_points_and_carries_go_by_shuffle(sdf, pdf, monkeypatch):
    """Beyond the size of a broadcast the same tables are joined by shuffle."""
    monkeypatch.setattr(module, "lookup", functools.partial(lookup, max_broadcast_rows=3))
    frame = ordered(sdf, ["k"], ["t", "id"], rows_per_block=7).row_number("n").lag("x", 2, "l").ewma("x", "y", com=5)
    got = by_id(frame.result(), "n", "l", "y")
    g = grouped(pdf, "k")
    expected = pd.DataFrame({"n": g.cumcount() + 1, "l": g["x"].shift(2), "y": g["x"].transform(lambda s: s.shift(1).ewm(5).mean())})
    check(got, expected)


@pytest.mark.parametrize("fold", [2, 5])
def test_states_are_folded_in_two_levels(sdf, pdf, monkeypatch, fold):
    monkeypatch.setattr(module, "FOLD", fold)
    frame = ordered(sdf, ["k"], ["t", "id"], rows_per_block=7).ewma("x", "a", com=5).ewma("x", "b", span=600, shift=0).ewma("x", "c", com=2, within=["day"])
    got = by_id(frame.result(), "a", "b", "c")
    g = grouped(pdf, "k")["x"]
    expected = pd.DataFrame({
        "a": g.transform(lambda s: s.shift(1).ewm(5).mean()),
        "b": g.transform(lambda s: s.ewm(span=600).mean()),
        "c": grouped(pdf, ["k", "day"])["x"].transform(lambda s: s.shift(1).ewm(2).mean()),
    })
    check(got, expected)


def count_jobs(spark, frame):
    """Jobs that the rows of a frame take."""
    group = f"jobs-{id(frame)}"
    spark.sparkContext.setJobGroup(group, "")
    frame.result().write.format("noop").mode("overwrite").save()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return found


def test_jobs_do_not_grow_with_the_operators(spark, sdf):
    one = ordered(sdf, ["k"], ["t", "id"], rows_per_block=40).row_number("n")
    many = ordered(sdf, ["k"], ["t", "id"], rows_per_block=40)
    many = many.row_number("n").dense_rank(F.col("day"), "r").lags({"l1": ("x", 1), "i3": ("id", 3)}).running_sum("id", "c").group_sum(F.col("id"), "g")
    many = many.ewma("x", "e", com=5).ewma("x", "f", span=600).with_column("w", F.col("x")).fill(["w"], ["ffill"])
    assert count_jobs(spark, many) <= count_jobs(spark, one) + 4


def test_waves_respect_what_is_read(sdf, pdf):
    """Results that feed later operators, columns that are replaced, and columns read before they are replaced."""
    results = []
    for size in (2_000_000, 7):
        frame = ordered(sdf, ["k"], ["t", "id"], size).row_number("n").lag("n", 1, "m").with_column("z", F.col("m") * 2).running_sum("z", "s")
        frame = frame.lag("x", 1, "before").fill(["x"], ["ffill", 0]).lag("x", 1, "after").dense_rank(F.col("n"), "r").ewma("after", "e", com=3, shift=2)
        frame = frame.with_column("x", F.col("x") + 1).lag("x", 1, "last").without("z")
        results.append(by_id(frame.result(), "n", "m", "s", "before", "x", "after", "r", "e", "last"))
    check(results[1], results[0])
    assert "z" not in frame.result().columns


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_cut_points_in_two_steps(sdf, pdf, monkeypatch, fan):
    monkeypatch.setattr(module, "FAN", fan)
    frame = ordered(sdf, ["k"], ["t", "id"], 7).row_number("n").lag("id", 2, "l").ewma("x", "y", com=5)
    got = by_id(frame.result(), "n", "l", "y")
    g = grouped(pdf, "k")
    expected = pd.DataFrame(
        {"n": g.cumcount() + 1, "l": g["id"].shift(2), "y": g["x"].transform(lambda s: s.shift(1).ewm(5).mean())}
    )
    check(got, expected)
    sizes = [r["count"] for r in frame.df.groupBy("k", "_block").count().collect()]
    assert max(sizes) <= 14 and len(sizes) > 60


def test_keyless_series_is_split(sdf, pdf):
    frame = ordered(sdf, [], ["t", "id"], rows_per_block=20).row_number("n")
    assert frame.df.select("_block").distinct().count() > 10
    got = by_id(frame.result(), "n")
    expected = pdf.sort_values(["t", "id"]).assign(n=np.arange(1, len(pdf) + 1)).sort_values("id")[["n"]]
    check(got, expected)


@pytest.mark.parametrize("seed", range(3))
def test_random_series(spark, seed):
    """Random sizes, gaps and block lengths; the same rows in any partitioning."""
    rng = np.random.default_rng(100 + seed)
    n = int(rng.integers(50, 250))
    pdf = pd.DataFrame({"id": rng.permutation(n), "k": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05])})
    pdf["x"] = np.where(rng.random(n) < rng.random(), np.nan, rng.normal(0, 1, n))
    rows = [(int(i), k, None if np.isnan(x) else float(x)) for i, k, x in pdf.itertuples(index=False)]
    sdf = spark.createDataFrame(rows, "id long, k string, x double").repartition(int(rng.integers(1, 6)))
    pdf = pdf.sort_values("id").reset_index(drop=True)
    frame = ordered(sdf, ["k"], ["id"], int(rng.integers(2, 20)))
    frame = frame.lag("x", int(lag := rng.integers(1, 5)), "l").ewma("x", "e", com=2, shift=1).with_column("f", F.col("x"))
    got = by_id(frame.fill(["f"], ["bfill", "ffill", 0]).row_number("n").result(), "l", "e", "f", "n")
    g = grouped(pdf, "k")
    expected = pd.DataFrame(
        {
            "l": g["x"].shift(lag),
            "e": g["x"].transform(lambda s: s.shift(1).ewm(2).mean()),
            "f": g["x"].transform(lambda s: s.bfill().ffill().fillna(0)),
            "n": g.cumcount() + 1,
        }
    )
    check(got, expected)


@pytest.mark.parametrize("rows_per_block", [4, 7, 1000])
@pytest.mark.parametrize("nulls", [0, 12, 40])
def test_nulls_in_the_order_span_blocks(spark, rows_per_block, nulls):
    """A run of null order values over several blocks is one value, and all operators still agree with one block."""
    rows = [(i, None if i < nulls else float(i // 3), float(i % 5) if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v double, x double").withColumn("k", F.lit("a"))

    def table(size):
        frame = ordered(df, ["k"], ["v", "id"], size)
        frame = frame.dense_rank(F.col("v"), "rank").row_number("n").running_sum("x", "s").lags({"l": ("x", 3)})
        frame = frame.fill(["x"], ["ffill"]).ewma("x", "m", com=2)
        return [tuple(round(c, 9) if isinstance(c, float) else c for c in r) for r in frame.result().orderBy("id").collect()]

    got = table(rows_per_block)
    assert got == table(2_000_000)
    ranks = {r[0]: r[4] for r in got}
    assert [ranks[i] for i in range(40)] == pd.Series([-1.0 if r[1] is None else r[1] for r in rows]).rank(method="dense").astype(int).tolist()
