"""Shocks of moving-average models and robust lines against plain loops."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators.ordered import ordered
from devicelens.plans import innovations as module
from devicelens.plans.forecast import arima_forecast
from devicelens.plans.robust import huber_lines


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"k": ["busy"] * 300 + ["small"] * 9 + ["one"], "id": np.arange(310), "w": rng.normal(size=310).round(4)})
    pdf.loc[[0, 7, 100, 101, 250, 302], "w"] = np.nan
    rows = [(k, int(i), None if np.isnan(w) else float(w)) for k, i, w in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "k string, id long, w double").repartition(5)


def plain(w, theta):
    out, before = [], [0.0] * len(theta)
    for x in w:
        e = np.nan if np.isnan(x) else x - sum(a * b for a, b in zip(theta, before))
        out.append(e)
        before = [0.0 if np.isnan(e) else e, *before[:-1]][: len(theta)]
    return out


@pytest.mark.parametrize("theta", [[0.6], [0.4, -0.2], [0.5, 0.1, -0.3, 0.2], [-0.97], [0.0, 0.0]])
@pytest.mark.parametrize("rows_per_block", [2, 7, 40, 2_000_000])
def test_shocks_equal_the_plain_loop(spark, series, theta, rows_per_block):
    """Also where a busy key spans many blocks, some of them shorter than the number of terms."""
    pdf, df = series
    frame = ordered(df, ["k"], ["id"], rows_per_block)
    made = module.innovations(frame, "w", F.array(*[F.lit(t) for t in theta]), "e")
    assert made.columns == [*df.columns, "e"]
    got = made.toPandas().sort_values("id")["e"].to_numpy()
    want = np.concatenate([plain(part["w"].to_numpy(), theta) for _, part in pdf.groupby("k", sort=False)])
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_terms_whose_shocks_grow_are_drawn_in():
    for theta in ([1.5], [0.3, 2.0], [-1.0]):
        tamed = module.tamed(theta)
        assert np.abs(np.linalg.eigvals(module.companion(tamed))).max() <= module.RADIUS + 1e-12
    assert module.tamed([0.4, -0.2]).tolist() == [0.4, -0.2] and not len(module.tamed(None)) and not len(module.tamed([np.nan]))


def test_map_of_a_block_and_answers_agree():
    rng = np.random.default_rng(1)
    theta = np.array([0.5, -0.3, 0.1])
    w = rng.normal(size=9)
    w[4] = np.nan
    before = rng.normal(size=3)
    whole = module.shocks(np.concatenate([before, w]), theta)  # any start will do
    state = whole[2::-1]
    own = np.nan_to_num(module.shocks(w, theta))
    answers = np.array([a if a is not None else [0.0] * 3 for a in module.answers(w, theta)])
    np.testing.assert_allclose(own + answers @ state, np.nan_to_num(whole[3:]), atol=1e-12)
    np.testing.assert_allclose(module.passed_on(w, theta) @ state + own[:-4:-1], np.nan_to_num(whole)[:-4:-1], atol=1e-12)


def test_recursive_forecast_finds_a_moving_average(spark):
    rng = np.random.default_rng(3)
    e = rng.normal(size=3_000)
    x = 5 + e + 0.7 * np.concatenate([[0.0], e[:-1]])
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "id": np.arange(len(x)), "x": x}))
    for size in (400, 2_000_000):
        made = arima_forecast(ordered(df, ["k"], ["id"], size), "x", (0, 0, 1), "p", recursive=True).toPandas().sort_values("id")
        error = np.sqrt(np.mean((made["p"] - x)[20:] ** 2))
        assert not made["p"].isna().any() and error < 1.06  # the shocks themselves have 1, the plain mean 1.22


@pytest.mark.parametrize("busy_rows", [0, 100, 10**9])
def test_lines_of_many_keys_in_few_passes(spark, busy_rows):
    """Small keys read their rows a fixed number of times, however many steps they take; alone or together, the lines agree."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": np.repeat(np.arange(60), 40)[:2_000], "x": rng.normal(3, 2, 2_000).round(3)})
    pdf.loc[:400, "k"] = 0
    pdf["y"] = 1.5 * pdf["x"] + rng.standard_t(1.5, 2_000).round(3) * 9
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.createDataFrame(pdf).repartition(3).mapInPandas(count, "k long, x double, y double")
    found = {r.k: r for r in huber_lines(df, "k", "x", "y", 1.345, busy_rows=busy_rows).collect()}
    if busy_rows:
        assert seen.value <= 6 * len(pdf)
    assert {k: r.n_rows for k, r in found.items()} == pdf.groupby("k").size().to_dict()
    for k, part in pdf.groupby("k"):
        push = np.clip(part["y"] - found[k].intercept - found[k].slope * part["x"], -1.345, 1.345)
        assert abs(push.mean()) < 1e-7 and abs((push * (part["x"] - part["x"].mean())).mean()) < 1e-6


def test_runs_are_whole(spark):
    """Each key comes in one piece and in order, several at a time, also one that is longer than a call's rows."""
    from devicelens.operators.groups import map_runs

    df = spark.range(3_000).select(F.when(F.col("id") % 7 > 2, "long").when(F.col("id") % 7 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id").repartition(4)

    def sums(table, starts):
        import pyarrow as pa

        at = [*starts.tolist(), table.num_rows]
        ids = table.column("id").to_numpy()
        assert all((np.diff(ids[a:b]) > 0).all() for a, b in zip(at, at[1:]))
        return pa.table([table.column("k").combine_chunks().take(pa.array(starts)), pa.array(np.diff(at)), pa.array(np.add.reduceat(ids, starts))], names=["k", "n", "s"])

    for rows in (1, 100, 10**6):
        made = map_runs(df, ["k"], ["id"], sums, "k string, n long, s long", rows)
        assert sorted(map(str, made.collect())) == sorted(map(str, df.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()))


def test_huber_line_is_at_its_optimum(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for k, n in (("a", 4_000), ("b", 300), ("c", 40), ("d", 2), ("e", 1)):
        x = rng.normal(3, 2, n)
        y = 1.5 * x - 2 + rng.normal(0, 1, n)
        y[: n // 5] += 200  # a fifth is far off
        rows += [(k, float(a), float(b)) for a, b in zip(x, y)]
        want[k] = (x, y)
    rows += [("a", None, 1.0), ("b", 1.0, None), ("f", 2.0, 3.0), ("f", 2.0, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(6)
    found = {r.k: r for r in huber_lines(df, "k", "x", "y", 1.345).collect()}
    assert {k: r.n_rows for k, r in found.items()} == {"a": 4_000, "b": 300, "c": 40, "d": 2, "e": 1, "f": 2}
    for k in "abc":
        x, y = want[k]
        push = np.clip(y - found[k].intercept - found[k].slope * x, -1.345, 1.345)
        assert abs(push.mean()) < 1e-7 and abs((push * (x - x.mean())).mean()) < 1e-6
    assert abs(found["a"].slope - 1.5) < 0.1
    assert abs(found["f"].intercept + 2 * found["f"].slope - 4) < 1e-6 or found["f"].pull < 1e-6
