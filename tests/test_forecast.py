"""Forecasts and order search against a direct computation in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators.ordered import ordered
from devicelens.plans.forecast import arima_forecast, best_order, choose_orders, tune_orders


def series(n=300):
    rng = np.random.default_rng(11)
    rows = []
    for key, size in (("a", n), ("b", 60)):
        x = np.zeros(size)
        e = rng.normal(size=size)
        for t in range(2, size):
            x[t] = 0.6 * x[t - 1] - 0.2 * x[t - 2] + e[t] + 0.4 * e[t - 1]
        rows.append(pd.DataFrame({"k": key, "t": np.arange(size), "x": x + 50}))
    return pd.concat(rows, ignore_index=True)


def by_hand(x, order, m=None, first=None):
    """Two-stage regression; rows before `first` are left out of the fits."""
    p, d, q = order
    z = np.diff(x, n=d) if d else x.copy()
    z = np.concatenate([np.full(d, np.nan), z])
    m = (max(p, q) + 4 if q else 0) if m is None else m
    n = len(x)

    def lagged(v, i):
        return np.concatenate([np.full(i, np.nan), v[: n - i]])

    def regress(cols, y, use):
        a = np.column_stack(cols)
        ok = use & np.isfinite(a).all(axis=1) & np.isfinite(y)
        return np.linalg.lstsq(a[ok], y[ok], rcond=None)[0], a

    use = np.arange(n) >= (first or 0)
    const = [np.ones(n)] if d == 0 else []
    shocks = []
    if q:
        b, a = regress([*const, *[lagged(z, i) for i in range(1, m + 1)]], z, use)
        e = z - a @ b
        shocks = [lagged(e, j) for j in range(1, q + 1)]
    cols = [*const, *[lagged(z, i) for i in range(1, p + 1)], *shocks]
    if not cols:
        return np.where(np.isfinite(z), x - z, np.nan), z
    b, a = regress(cols, z, use)
    fitted = a @ b
    return fitted + (x - z), z - fitted


def filled(expected, x, order):
    """Rows without all lags: the highest known difference does not change; 0 for the first row."""
    p, d, q = order
    out = expected.copy()
    for t in np.flatnonzero(~np.isfinite(expected)):
        k = min(d, t)
        if k:
            out[t] = x[t] - np.diff(x[t - k : t + 1], n=k)[0]
        else:
            out[t] = x[t - 1] if t and p + q + d else 0.0
    return out


@pytest.mark.parametrize("order", [(1, 1, 0), (2, 0, 0), (0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 2, 4), (0, 1, 2)])
@pytest.mark.parametrize("rows_per_block", [2_000_000, 50])
def test_forecast(spark, order, rows_per_block):
    pdf = series(150)
    frame = ordered(spark.createDataFrame(pdf), ["k"], ["t"], rows_per_block)
    got = arima_forecast(frame, "x", order, "f").toPandas().sort_values(["k", "t"])
    for key, part in got.groupby("k"):
        x = pdf[pdf.k == key]["x"].to_numpy()
        expected = filled(by_hand(x, order)[0], x, order)
        np.testing.assert_allclose(part["f"].to_numpy(dtype=float), expected, rtol=1e-6)


def test_both_fits_read_the_series_once(spark):
    """One pass for the two fits, and one for the result: what comes before the differences is not done again for each fit."""
    read = spark.sparkContext.accumulator(0)
    pdf = series(150)

    @F.udf("double")
    def watched(x):
        read.add(1)
        return x

    df = spark.createDataFrame(pdf).withColumn("x", watched("x"))
    assert arima_forecast(ordered(df, ["k"], ["t"]), "x", (1, 2, 4), "f").toPandas()["f"].notna().all()
    assert read.value <= 2 * len(pdf)


def test_order_search(spark):
    pdf = series()
    grid = [(1, 0, 0), (1, 1, 0), (2, 0, 1), (0, 2, 2), (3, 3, 4), (0, 0, 0)]
    found = tune_orders(ordered(spark.createDataFrame(pdf), ["k"], ["t"]), "x", grid)
    got = {(r.p, r.d, r.q): (r.n_rows, r.rmse) for r in found.collect()}
    assert set(got) == set(grid)
    first = 3 + 8 + 4
    for order in grid:
        error, count = 0.0, 0
        for _, part in pdf.groupby("k"):
            # The search takes its residuals from the long order of the whole grid.
            _, e = by_hand_search(part["x"].to_numpy(), order, 8, first)
            error += np.sum(e[first:] ** 2)
            count += len(e) - first
        assert got[order][0] == count
        np.testing.assert_allclose(got[order][1], np.sqrt(error / count), rtol=1e-6)
    assert best_order(found) == min(got, key=lambda o: got[o][1])


def by_hand_search(x, order, m, first):
    p, d, q = order
    n = len(x)
    z = np.concatenate([np.full(d, np.nan), np.diff(x, n=d)]) if d else x.copy()
    lag = lambda v, i: np.concatenate([np.full(i, np.nan), v[: n - i]])
    use = np.arange(n) >= first
    const = [np.ones(n)] if d == 0 else []
    a = np.column_stack([*const, *[lag(z, i) for i in range(1, m + 1)]])
    b = np.linalg.lstsq(a[use], z[use], rcond=None)[0]
    e = z - a @ b
    cols = [*const, *[lag(z, i) for i in range(1, p + 1)], *[lag(e, j) for j in range(1, q + 1)]]
    if not cols:
        return None, z
    a = np.column_stack(cols)
    b = np.linalg.lstsq(a[use], z[use], rcond=None)[0]
    return None, z - a @ b


def test_budget_is_repeatable():
    assert choose_orders(budget=16) == choose_orders(budget=16)
    assert len(choose_orders(budget=16)) == 16 and len(choose_orders(budget=None)) == 80
