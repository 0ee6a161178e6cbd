"""One-step forecasts of ordered series by ARIMA(p, d, q) regressions, for all keys at once.

The orders are fitted by the two-stage regression of Hannan and Rissanen, not by maximum
likelihood: a long autoregression gives residuals, then the series is regressed on its own
lags and on lagged residuals. Every stage is a sum of products per key (combined before the
shuffle), so a key with most of the rows costs no more than its share of the scan. The
lagged values of a row are the only thing that needs order.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import OrderedFrame, nth_difference, ordered
from devicelens.plans.innovations import innovations
from devicelens.plans.regress import least_squares, linear, product_sums, solve_sums, unpack
from devicelens.session import cut, stored

Order = tuple[int, int, int]

# The default order and the search space.
DEFAULT_ORDER: Order = (1, 2, 4)
ORDER_GRID: list[Order] = [(p, d, q) for p in range(4) for d in range(4) for q in range(5)]


def _long_order(p: int, q: int) -> int:
    return max(p, q) + 4 if q else 0


def _present(columns: Sequence[Column]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & c.isNotNull()
    return known


def _with_lags(frame: OrderedFrame, column: str, depth: int) -> tuple[DataFrame, list[Column]]:
    """Columns x_t, x_{t-1}, …, x_{t-depth}."""
    names = [f"_x{i}" for i in range(1, depth + 1)]
    if depth:
        frame = frame.lags({n: (column, i) for i, n in enumerate(names, 1)})
    return frame.result(), [F.col(column), *map(F.col, names)]


def _undo(values: Sequence[Column], d: int) -> Column:
    """What must be added to the forecast of the d-th difference to get one of the value."""
    total = F.lit(0.0)
    for i in range(1, d + 1):
        total = total + F.lit(float(math.comb(d, i) * (-1) ** (i + 1))) * values[i]
    return total


def arima_forecast(frame: OrderedFrame, column: str, order: Order = DEFAULT_ORDER, out: str = "predicted_temp", recursive: bool = False) -> DataFrame:
    """Add the in-sample one-step forecast of each row.

    Shocks come from the long autoregression of the fit; with ``recursive`` they are those of the fitted model itself, one step
    after the other (:func:`innovations`), and moving-average terms whose shocks would not fade are drawn in.

    The column should have no nulls (fill or drop them first). One model is fitted per key. A row that lacks
    some of the lags, at the head of its key, gets what the highest known difference says if it does not change
    (the last value, when only that is known), and the first row of a key gets 0.
    """
    p, d, q = order
    m = _long_order(p, q)
    depth = d + max(p, m + q)
    df, x = _with_lags(frame, column, depth)
    keys = list(frame.keys)
    if keys[0] not in df.columns:  # one series over the whole table
        keys = ["_all"]
        df = df.withColumn("_all", F.lit(0))
    z = [f"_z{j}" for j in range(depth - d + 1)]
    df = df.withColumns({n: nth_difference(x[j : j + d + 1], d) for j, n in enumerate(z)})
    without_shocks = [_undo(x, k) for k in range(d, 0, -1)] + ([x[1]] if depth else [])
    df = df.withColumns({"_undo": _undo(x, d), "_plain": F.coalesce(*without_shocks, F.lit(0.0))}).drop(*[f"_x{i}" for i in range(1, depth + 1)])
    constant = [F.lit(1.0)] if d == 0 else []
    spent = ["_undo", *z]
    # Both fits read the differences from a narrow copy: what made them (trips, fills, lags) is not done again for each.
    narrow = stored(df.select(*keys, *z), "differences") if q else df
    shocks: list[Column] = []
    if q:
        terms = [[*constant, *[F.col(z[j + i]) for i in range(1, m + 1)]] for j in range(q + 1)]
        long = _fit(narrow, keys, terms[0], F.col(z[0]), "_long", [F.col(c) for c in z[: m + 1]])
        df, narrow = (lookup(part, long, keys, materialise=False) for part in (df, narrow))
        made = {f"_e{j}": F.col(z[j]) - linear(F.col("_long"), terms[j]) for j in range(1, q + 1)}
        df, narrow = df.withColumns(made), narrow.withColumns(made)
        shocks = [F.col(f"_e{j}") for j in range(1, q + 1)]
        spent += ["_long", *[f"_e{j}" for j in range(1, q + 1)]]
    terms = [*constant, *[F.col(z[i]) for i in range(1, p + 1)], *shocks]
    if terms:
        # A shock is known where its differences are, and its key has a long fit: cheaper to ask than the shocks.
        known = [*map(F.col, z), F.col("_long")] if q else [*terms, F.col(z[0])]
        df = lookup(df, _fit(narrow, keys, terms, F.col(z[0]), "_short", known), keys, materialise=False)
        predicted = linear(F.col("_short"), terms)
        spent.append("_short")
        if recursive and q:
            own = len(constant) + p
            rest = F.col(z[0]) - linear(F.col("_short"), terms[:own])
            again = ordered(df.withColumn("_rest", rest), [k for k in keys if k != "_all"], frame.order_by, frame.rows_per_block)
            df = innovations(again, "_rest", F.slice("_short", own + 1, q), "_shock")
            predicted = F.col(z[0]) - F.col("_shock")
            spent += ["_rest", "_shock"]
    else:
        predicted = F.lit(0.0)
    return df.withColumn(out, F.coalesce(predicted + F.col("_undo"), F.col("_plain"))).drop(*spent, "_plain", "_all")


def _fit(df: DataFrame, keys: list[str], terms: Sequence[Column], target: Column, out: str, known: Sequence[Column]) -> DataFrame:
    """Coefficients per key from its rows where all of ``known`` is there, one small row each."""
    rows = df.where(_present(known))
    sums = rows.groupBy(*keys).agg(product_sums([*terms, target]).alias("_sums"))
    return cut(sums.select(*keys, solve_sums(F.col("_sums"), len(terms)).alias(out)))


def choose_orders(grid: Iterable[Order] = ORDER_GRID, budget: int | None = 16, seed: int = 0) -> list[Order]:
    """The whole grid, or a repeatable choice of ``budget`` of its points."""
    grid = sorted(set(grid))
    if budget is None or budget >= len(grid):
        return grid
    picked = np.random.default_rng(seed).permutation(len(grid))[:budget]
    return [grid[i] for i in sorted(picked)]


def tune_orders(frame: OrderedFrame, column: str, orders: Iterable[Order] = ORDER_GRID) -> DataFrame:
    """``(p, d, q, n_rows, rmse)`` for every order, the best first; models are fitted per key.

    Two aggregations serve the whole grid: all orders with the same d are regressions on parts
    of the same terms, and the squared error of each follows from the same sums of products.
    All orders are judged on the same rows, those with every lag that the largest one needs.
    """
    orders = sorted(set(orders))
    most_p, most_d, most_q = (max(o[i] for o in orders) for i in range(3))
    m = _long_order(most_p, most_q)
    depth = most_d + max(most_p, m + most_q)
    df, x = _with_lags(frame, column, depth)
    keys = [k for k in frame.keys if k in df.columns]
    span = range(depth - most_d + 1)
    degrees = sorted({d for _, d, _ in orders})
    per_d = [
        F.struct(F.lit(d).alias("d"), *[nth_difference(x[j : j + d + 1], d).alias(f"_z{j}") for j in span]) for d in degrees
    ]
    long = df.where(_present(x)).select(*keys, F.inline(F.array(*per_d)))
    group = [*keys, "d"]
    one, target = F.lit(1.0), F.col("_z0")

    # Stage 1: residuals of the long autoregression (with a constant for d = 0 only).
    shocks: list[Column] = []
    if most_q:
        terms = [[one, *[F.col(f"_z{j + i}") for i in range(1, m + 1)]] for j in range(most_q + 1)]
        sums = long.groupBy(*group).agg(product_sums([*terms[0], target]).alias("_sums"))
        both = F.when(F.col("d") == 0, solve_sums(F.col("_sums"), m + 1)).otherwise(
            solve_sums(F.col("_sums"), m + 1, range(1, m + 1))
        )
        long = lookup(long, cut(sums.select(*group, both.alias("_long"))), group, materialise=False)
        long = long.withColumns({f"_e{j}": F.col(f"_z{j}") - linear(F.col("_long"), terms[j]) for j in range(1, most_q + 1)})
        shocks = [F.col(f"_e{j}") for j in range(1, most_q + 1)]

    # Stage 2: every (p, q) uses some of these terms.
    terms = [one, *[F.col(f"_z{i}") for i in range(1, most_p + 1)], *shocks, target]
    sums = long.groupBy(*group).agg(product_sums(terms).alias("_sums"), F.count(F.lit(1)).alias("_n"))
    k = len(terms)

    def judge(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            matrices, degree = unpack(pdf["_sums"], k), pdf["d"].to_numpy()
            for p, d, q in orders:
                mine = degree == d
                used = ([0] if d == 0 else []) + list(range(1, p + 1)) + list(range(1 + most_p, 1 + most_p + q))
                gram, moment = matrices[mine][:, used][:, :, used], matrices[mine][:, used, k - 1]
                b = least_squares(gram, moment)
                fitted = 2 * np.einsum("ni,ni->n", b, moment) - np.einsum("ni,nij,nj->n", b, gram, b)
                error = np.maximum(matrices[mine, k - 1, k - 1] - fitted, 0.0)
                # One row per order and batch: keys are summed up here already.
                yield pd.DataFrame({"p": [p], "d": [d], "q": [q], "n": [pdf["_n"][mine].sum()], "error": [error.sum()]})

    judged = sums.select("d", "_sums", "_n").mapInPandas(judge, "p int, d int, q int, n long, error double")
    scored = judged.groupBy("p", "d", "q").agg(F.sum("n").alias("n_rows"), F.sqrt(F.sum("error") / F.sum("n")).alias("rmse"))
    return scored.orderBy("rmse", "p", "d", "q")


def best_order(scores: DataFrame) -> Order:
    row = scores.orderBy("rmse", "p", "d", "q").first()
    return row["p"], row["d"], row["q"]
