"""True one-step shocks of models with moving-average terms, in blocks of the series.

A shock is what a reading differs from its forecast, and the forecast needs the shocks before: ``e_t = w_t - θ₁ e_{t-1} - … - θ_q e_{t-q}``.
One such step is an affine map of the last q shocks, and affine maps compose to affine maps. So each block of a busy
key runs by itself from zero shocks, and notes how its first rows answer to the shocks before it; the maps of whole
blocks are put together on one small row per block; and each row adds its answer to what truly came before.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.operators.groups import map_runs
from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import BLOCK, HOT, OrderedFrame
from devicelens.session import cut, stored

#: Shocks must fade: terms whose shocks would not are drawn in until they lose this share per step.
RADIUS = 0.98
#: Answers smaller than this are none.
NOTHING = 1e-18
#: Blocks up to this length keep their answers for the next block with the same gaps, so many of them at a time.
SHORT, KEPT = 4_096, 1_000


def companion(theta: np.ndarray) -> np.ndarray:
    """The map of (e_{t-1}, …, e_{t-q}) to (e_t, …, e_{t-q+1}) without input."""
    q = len(theta)
    step = np.zeros((q, q))
    step[0] = -theta
    step[np.arange(1, q), np.arange(q - 1)] = 1.0
    return step


def tamed(theta: Sequence[float] | None) -> np.ndarray:
    """The terms, drawn in if their shocks would not fade; none for missing ones."""
    theta = np.array([] if theta is None else theta, dtype=float)
    theta = np.where(np.isfinite(theta), theta, 0.0)
    if not len(theta) or not theta.any():
        return np.zeros(0)
    radius = np.abs(np.linalg.eigvals(companion(theta))).max()
    return theta * (RADIUS / radius) ** np.arange(1, len(theta) + 1) if radius > RADIUS else theta


def shocks(w: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The recursion from zero shocks; a missing input has no shock, and counts as none for the rows behind it."""
    q = len(theta)
    if not q:
        return w.copy()
    out, known, before = np.full(len(w), np.nan), np.isfinite(w).tolist(), [0.0] * q
    terms = theta.tolist()
    for t, (x, here) in enumerate(zip(w.tolist(), known)):
        e = 0.0
        if here:
            e = x - sum([a * b for a, b in zip(terms, before)])
            out[t] = e
        before = [e, *before[:-1]]
    return out


def answers(w: np.ndarray, theta: np.ndarray) -> list[list[float] | None]:
    """How the shock of each row answers to the q shocks before the first one, as long as it does."""
    out: list[list[float] | None] = [None] * len(w)
    state = np.eye(len(theta))
    for t in range(len(w)):
        if not len(theta) or np.abs(state).max() < NOTHING:
            break
        new = -theta @ state if np.isfinite(w[t]) else np.zeros(len(theta))
        out[t] = new.tolist()
        state = np.vstack([new, state[:-1]])
    return out


def passed_on(w: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The map of the q shocks before a block to its own last q, without input."""
    q = len(theta)
    state = np.eye(q)
    for known in np.isfinite(w):
        if np.abs(state).max() < NOTHING:
            return np.zeros((q, q))
        state = np.vstack([-theta @ state if known else np.zeros(q), state[:-1]])
    return state


def innovations(frame: OrderedFrame, w: str, theta: Column, out: str) -> DataFrame:
    """Add the shocks of column ``w`` for moving-average terms ``theta`` (array<double>, the same on all rows of a key).

    ``w`` is the reading less what the other terms forecast; where it is null, the shock is null and counts as 0 behind it.
    Terms whose shocks would not fade are drawn in (:func:`tamed`). Rows before the first have no shocks.
    """
    df = frame.df.withColumns({"_w": F.col(w).cast("double"), "_theta": theta.cast("array<double>")})
    order, home = list(frame.order_by), frame._home
    schema = T.StructType([*df.schema.fields, T.StructField("_e", T.DoubleType()), T.StructField("_answer", T.ArrayType(T.DoubleType())), T.StructField("_map", T.ArrayType(T.DoubleType()))])
    split = frame.split

    def local(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        x = rows.column("_w").combine_chunks().fill_null(float("nan")).to_numpy(zero_copy_only=False)
        firsts = pa.array(starts)
        given = rows.column("_theta").combine_chunks().take(firsts).to_pylist()
        hots = rows.column(HOT).combine_chunks().take(firsts).to_pylist() if split else [False] * len(starts)
        e = np.empty(len(x))
        answer: list = [None] * len(x)
        map_: list = [None] * len(x)
        drawn: dict[tuple, np.ndarray] = {}
        kept: dict[tuple, tuple] = {}
        for start, end, theta, hot in zip(starts.tolist(), [*starts[1:].tolist(), len(x)], given, hots):
            theta = tuple(theta or ())
            terms = drawn.get(theta)
            if terms is None:
                if len(drawn) >= KEPT:
                    drawn.clear()
                terms = drawn[theta] = tamed(theta)
            w = x[start:end]
            e[start:end] = shocks(w, terms)
            if not hot or not len(terms):
                continue
            # Both depend on the terms and on which rows are known, not on the readings.
            same = (theta, np.isfinite(w).tobytes()) if len(w) <= SHORT else None
            found = kept.get(same)
            if found is None:
                found = answers(w, terms), passed_on(w, terms).ravel().tolist()
                if same:
                    if len(kept) >= KEPT:
                        kept.clear()
                    kept[same] = found
            answer[start:end], map_[end - 1] = found
        rows = rows.append_column("_e", pa.array(np.where(np.isfinite(e), e, 0), pa.float64(), mask=~np.isfinite(e)))
        rows = rows.append_column("_answer", pa.array(answer, pa.list_(pa.float64())))
        return rows.append_column("_map", pa.array(map_, pa.list_(pa.float64())))

    made = map_runs(df, home, order, local, schema)
    if not split:
        return made.withColumn(out, F.col("_e")).drop("_w", "_theta", "_e", "_answer", "_map")
    made = stored(made, "shocks")
    longest = made.agg(F.max(F.size("_theta"))).first()[0] or 0
    in_order = Window.partitionBy(*home).orderBy(*[F.col(c).desc() for c in order])
    ends = made.where(HOT).select(*home, *order, "_e", "_map").withColumn("_back", F.row_number().over(in_order)).where(F.col("_back") <= max(1, longest))
    ends = ends.groupBy(*home).agg(
        F.array_sort(F.collect_list(F.struct("_back", F.coalesce("_e", F.lit(0.0)).alias("e")))).alias("_last"), F.max("_map").alias("_map")
    )
    keys = list(frame.keys)
    # A block shorter than q hands on its own shocks and those before it: the map has both.
    carry = T.StructType([*[ends.schema[c] for c in home], T.StructField("_shocks_before", T.ArrayType(T.DoubleType()))])

    def fold(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        new, before = set(starts.tolist()), []
        state: np.ndarray | None = None
        for i, (last, map_) in enumerate(zip(rows.column("_last").to_pylist(), rows.column("_map").to_pylist())):
            q = 0 if map_ is None else int(round(len(map_) ** 0.5))
            state = np.zeros(q) if state is None or i in new else state
            before.append(state.tolist())
            if q:
                own = np.array([r["e"] for r in last][:q] + [0.0] * max(0, q - len(last)))
                state = own + np.asarray(map_, dtype=float).reshape(q, q) @ state
        return rows.select(home).append_column("_shocks_before", pa.array(before, pa.list_(pa.float64())))

    carries = cut(map_runs(ends, keys, [BLOCK], fold, carry))
    joined = lookup(made, carries, home, materialise=False)
    answer = F.aggregate(F.zip_with("_answer", "_shocks_before", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return joined.withColumn(out, F.col("_e") + F.coalesce(answer, F.lit(0.0))).drop("_w", "_theta", "_e", "_answer", "_map", "_shocks_before", BLOCK, HOT)
