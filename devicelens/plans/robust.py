"""A robust line per key: Huber's estimate, whose every step is a merge of partial sums."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.operators.groups import map_runs, per_group
from devicelens.operators.lookup import lookup
from devicelens.session import cut, stored

#: Rows of a key beyond which its steps are taken by all tasks together.
BUSY_ROWS = 500_000
_SUMS = ["n", "inside", "sx", "sxx", "gx", "g0", "loss"]


def huber_lines(df: DataFrame, key: str, x: str, y: str, limit: float, steps: int = 60, tolerance: float = 1e-10, busy_rows: int = BUSY_ROWS) -> DataFrame:
    """``(key, n_rows, slope, intercept, pull, loss)``: the line per key with the least sum of Huber's loss.

    The loss of a residual r is r²/2 up to ``limit``, beyond it ``limit`` (|r| - limit/2): a far reading pulls no more than one
    at the limit. Each step is Newton's, on sums over the rows within the limit, and is
    halved where it would not lower the loss. ``pull`` is what is left of the slope of the loss, per row; 0 at the optimum. Rows with a null
    are left out.

    Keys of up to ``busy_rows`` rows take all their steps in one task, many keys side by side, each until it has arrived: one
    shuffle in all. Keys with more rows step together, from partial sums per partition.
    """
    rows = df.select(key, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    kind = rows.schema[key].dataType.simpleString()
    state = f"{key} {kind}, _m double, _s double, a double, b double, da double, db double, loss double, pull double, n long"

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = {c: "first" for c in ("_m", "_s", "a", "b", "da", "db", "before")}
        return pdf.groupby(key, as_index=False).agg({**kept, **{c: "sum" for c in _SUMS}})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        worse = pdf["loss"] > pdf["before"] * (1 + 1e-12) + 1e-12
        a, b = np.where(worse, pdf["a"], pdf["a"] + pdf["da"]), np.where(worse, pdf["b"], pdf["b"] + pdf["db"])
        # A little more on the diagonal where too few rows lie within the limit to tell a slope.
        more = 1e-9 * pdf["n"] + (pdf["inside"] < 2) * pdf["n"]
        h00, h01, h11 = pdf["inside"] + more, pdf["sx"], pdf["sxx"] + more
        det = h00 * h11 - h01 * h01
        da, db = (h11 * pdf["g0"] - h01 * pdf["gx"]) / det, (h00 * pdf["gx"] - h01 * pdf["g0"]) / det
        da, db = np.where(worse, pdf["da"] / 2, da), np.where(worse, pdf["db"] / 2, db)
        loss = np.where(worse, pdf["before"], pdf["loss"])
        pull = np.where(worse, np.inf, np.maximum(pdf["g0"].abs(), pdf["gx"].abs()) / pdf["n"])
        return pdf[[key, "_m", "_s"]].assign(a=a, b=b, da=da, db=db, loss=loss, pull=pull, n=pdf["n"].astype("int64"))

    def terms(z, r) -> dict:
        """What each row adds to the sums of its key."""
        inside = (np.abs(r) <= limit).astype(float)
        push = np.clip(r, -limit, limit)
        loss = np.where(inside > 0, r * r / 2, limit * (np.abs(r) - limit / 2))
        return dict(inside=inside, sx=inside * z, sxx=inside * z * z, gx=push * z, g0=push, loss=loss)

    names = [c.split()[0] for c in state.split(", ")]

    def solve(table: pa.Table, starts: np.ndarray) -> pa.Table:
        of, sizes = _numbered(starts, table.num_rows)
        x, y = (table.column(c).to_numpy() for c in ("_x", "_y"))
        mean = np.bincount(of, x) / sizes
        spread = np.sqrt(np.bincount(of, (x - mean[of]) ** 2) / sizes)
        spread[~(spread > 0)] = 1.0
        z = (x - mean[of]) / spread[of]
        middle = y[np.lexsort((y, of))][starts + (sizes - 1) // 2]
        zero = np.zeros(len(sizes))
        lines = pd.DataFrame({key: np.arange(len(sizes)), "_m": mean, "_s": spread, "a": middle, "b": zero, "da": zero, "db": zero, "loss": np.inf, "pull": np.inf, "n": sizes})
        going = lines
        for _ in range(steps):
            r = y - (going["a"] + going["da"]).to_numpy()[of] - (going["b"] + going["db"]).to_numpy()[of] * z
            sums = {c: np.bincount(of, v, minlength=len(going)) for c, v in terms(z, r).items()}
            going = finish(going.assign(before=going["loss"], **sums))
            lines.loc[going[key], names[1:]] = going[names[1:]].to_numpy()
            move = (np.maximum(going["da"].abs(), going["db"].abs()) > tolerance) & (going["pull"] >= tolerance)
            if not move.any():
                break
            # Keys that have arrived leave with their rows.
            rest, place = move.to_numpy()[of], np.cumsum(move) - 1
            x, y, z, of = x[rest], y[rest], z[rest], place.to_numpy()[of[rest]]
            going = going[move].reset_index(drop=True)
        columns = [table.column(key).combine_chunks().take(pa.array(starts))]
        return pa.table([*columns, *[pa.array(lines[c].to_numpy(), pa.int64() if c == "n" else pa.float64()) for c in names[1:]]], names=names)

    sizes = cut(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))
    busy = cut(sizes.where(F.col("_rows") > busy_rows).select(key, F.lit(True).alias("_busy")))
    n_busy = busy.count()
    if n_busy:
        marked = lookup(rows, busy, [key], materialise=False, n_rows=n_busy)
        small, large = marked.where("_busy is null").drop("_busy"), stored(marked.where("_busy").drop("_busy"), "busy")
    else:
        small, large = rows, None
    found = map_runs(small, [key], [], solve, state)
    if large is not None:
        found = found.unionByName(_step_together(large, key, kind, limit, steps, tolerance, state, terms, merge, finish))
    slope = F.col("b") / F.col("_s")
    return found.select(key, F.col("n").alias("n_rows"), slope.alias("slope"), (F.col("a") - slope * F.col("_m")).alias("intercept"), "pull", "loss")


def _numbered(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's run, and the length of each run."""
    sizes = np.diff(np.append(starts, n))
    return np.repeat(np.arange(len(sizes)), sizes), sizes


def _step_together(rows: DataFrame, key: str, kind: str, limit: float, steps: int, tolerance: float, state: str, terms, merge, finish) -> DataFrame:
    """Lines of busy keys: each step is a pass over their rows, which merges sums."""
    moments = rows.groupBy(key).agg(F.avg("_x").alias("_m"), F.coalesce(F.nullif(F.stddev_pop("_x"), F.lit(0.0)), F.lit(1.0)).alias("_s"), F.percentile_approx("_y", 0.5).alias("a"))
    # In units of each key's own spread, from a flat line through the median.
    lines = cut(moments.select(key, "_m", "_s", "a", F.lit(0.0).alias("b"), F.lit(0.0).alias("da"), F.lit(0.0).alias("db"), F.lit(float("inf")).alias("loss"), F.lit(float("inf")).alias("pull"), F.lit(0).cast("long").alias("n")))

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        z = (pdf["_x"] - pdf["_m"]) / pdf["_s"]
        r = pdf["_y"] - (pdf["a"] + pdf["da"]) - (pdf["b"] + pdf["db"]) * z
        return merge(pdf[[key, "_m", "_s", "a", "b", "da", "db"]].assign(before=pdf["loss"], n=1.0, **terms(z, r)))

    summary = f"{key} {kind}, _m double, _s double, a double, b double, da double, db double, before double, " + ", ".join(f"{c} double" for c in _SUMS)
    for _ in range(steps):
        with_line = lookup(rows, lines.drop("n", "pull"), [key], "inner", materialise=False)
        lines = cut(per_group(with_line, [key], partial, summary, merge, finish, state))
        left = lines.agg(F.max(F.when(F.greatest(F.abs("da"), F.abs("db")) > tolerance, F.col("pull")))).first()[0]
        if left is None or left < tolerance:
            break
    return lines
