"""Counts, rates, summaries, quality checks: one pass over the table each."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.operators.ordered import ROWS_PER_BLOCK, ordered
from devicelens.sources.tables import rows


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return count_by(df, [label])


def top_keys(df: DataFrame, condition: Column, key: str, n: int = 1, out: str = "n") -> DataFrame:
    """Keys with the most rows that meet the condition; equal counts are ordered by key."""
    return count_by(df.where(condition), [key], out).orderBy(F.col(out).desc(), F.col(key)).limit(n)


def rate(df: DataFrame, condition: Column, keys: Sequence[str] = (), out: str = "rate") -> DataFrame:
    """Share of rows that meet the condition; a null condition counts as not met. 0 for no rows."""
    share = F.coalesce(F.avg(F.coalesce(condition, F.lit(False)).cast("double")), F.lit(0.0))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), share.alias(out))


def rate_of(condition: Column, among: Column | None = None) -> Column:
    """The same as an aggregate expression, optionally among some rows only."""
    met = F.coalesce(condition, F.lit(False)).cast("double")
    return F.coalesce(F.avg(met if among is None else F.when(among, met)), F.lit(0.0))


def table_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """avg_x, min_x and max_x of all columns in a single job."""
    measures = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *measures)


def unpivot(df: DataFrame, columns: Sequence[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """One row per row and column, values as double."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])
    return df.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return counted.select(F.inline(pairs))


def schema_profile(df: DataFrame) -> DataFrame:
    """Name, type and position of each column, with the shape of the table."""
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("dtype"))
            for i, (n, t) in enumerate(df.dtypes)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.inline(entries))


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probs: Mapping[str, float],
    exact: bool = True,
    accuracy: int = 10_000,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Interpolated quantiles per key, one output column per entry of ``probs``.

    ``percentile`` keeps all distinct values of a key in one task. The exact form here first
    counts equal values (combined before the shuffle, so a frequent value costs nothing) and
    then finds the wanted ranks by an ordered running count, which splits busy keys.
    ``exact=False`` uses the mergeable sketch of ``percentile_approx`` in a single aggregation.
    """
    if not exact:
        picks = [F.percentile_approx(column, p, accuracy).alias(out) for out, p in probs.items()]
        return df.where(F.col(column).isNotNull()).groupBy(*keys).agg(*picks)
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    frame = ordered(counts, keys, [column], rows_per_block)
    frame = frame.running_sum("_n", "_upto").group_sum(F.col("_n"), "_all")
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1

    def value_at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col(column)))

    ends = []
    for i, p in enumerate(probs.values()):
        spot = F.lit(float(p)) * (F.col("_all") - 1)
        ends += [
            value_at(F.floor(spot)).alias(f"_lo{i}"),
            value_at(F.ceil(spot)).alias(f"_hi{i}"),
            F.max(spot - F.floor(spot)).alias(f"_part{i}"),
        ]
    found = frame.df.groupBy(*keys).agg(*ends)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(out)
            for i, out in enumerate(probs)
        ],
    )


QUARTERS = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
BRACKET = 1e-3


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column, nulls left out.

    The table is not shuffled for the quartiles: the first scan, which also takes the other
    measures, brackets each of them by a sketch; the second counts what lies below the brackets
    and ranks only the few values inside. ``exact=False`` stops after the first scan.
    """
    columns = list(columns)
    wanted = [p for q in QUARTERS.values() for p in (q - BRACKET, q, q + BRACKET)]
    measures = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        found = {"n": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        found["sketch"] = F.percentile_approx(x, wanted, accuracy)
        measures.append(F.struct(*[v.alias(k) for k, v in found.items()]).alias(f"c{i}"))
    first = df.agg(*measures).first()
    sketches = {c: first[f"c{i}"].sketch for i, c in enumerate(columns)}
    sizes = {c: first[f"c{i}"].n for i, c in enumerate(columns)}
    if not exact:
        quarters = {c: {q: (s or [None] * len(wanted))[3 * j + 1] for j, q in enumerate(QUARTERS)} for c, s in sketches.items()}
    else:
        quarters = _ranked_in_brackets(df, columns, sizes, sketches)
        if quarters is None:  # a bracket missed its quartile
            table = group_quantiles(unpivot(df, columns), ["column_name"], "value", QUARTERS)
            quarters = {r["column_name"]: r.asDict() for r in rows(table)}
    summary = []
    for i, c in enumerate(columns):
        r, q = first[f"c{i}"], quarters.get(c, {})
        summary.append((c, r.n, r.mean, r.std, r.min, *[q.get(k) for k in QUARTERS], r.max))
    names = ["mean", "std", "min", *QUARTERS, "max"]
    schema = "column_name string, n long, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame(summary, schema)


def _ranked_in_brackets(
    df: DataFrame, columns: Sequence[str], sizes: Mapping[str, int], sketches: Mapping[str, Sequence[float]]
) -> dict[str, dict[str, float]] | None:
    """Exact quartiles from brackets that hold them; None if one does not (then they must be found otherwise)."""
    brackets = [(c, q, sketches[c][3 * j], sketches[c][3 * j + 2]) for c in columns if sizes[c] for j, q in enumerate(QUARTERS)]
    if not brackets:
        return {}
    below = df.agg(*[F.count_if(F.col(c).cast("double") < lo).alias(f"b{i}") for i, (c, _, lo, _) in enumerate(brackets)]).first()
    inside = [
        F.struct(F.lit(i).alias("bracket"), F.when(F.col(c).cast("double").between(lo, hi), F.col(c).cast("double")).alias("value"))
        for i, (c, _, lo, hi) in enumerate(brackets)
    ]
    counts = df.select(F.inline(F.filter(F.array(*inside), lambda x: x["value"].isNotNull()))).groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("_n"))
    frame = ordered(counts, ["bracket"], ["value"]).running_sum("_n", "_upto")
    start = F.element_at(F.array(*[F.lit(below[f"b{i}"]) for i in range(len(brackets))]), F.col("bracket") + 1)
    spots = [QUARTERS[q] * (sizes[c] - 1) for c, q, _, _ in brackets]
    spot = F.element_at(F.array(*[F.lit(float(s)) for s in spots]), F.col("bracket") + 1)
    last = start + F.col("_upto") - 1
    first = last - F.col("_n") + 1

    def value_at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col("value")))

    found = {r["bracket"]: (r["lo"], r["hi"]) for r in rows(
        frame.df.groupBy("bracket").agg(value_at(F.floor(spot)).alias("lo"), value_at(F.ceil(spot)).alias("hi"))
    )}
    quarters: dict[str, dict[str, float]] = {}
    for i, (c, q, _, _) in enumerate(brackets):
        lo, hi = found.get(i, (None, None))
        if lo is None or hi is None:
            return None
        quarters.setdefault(c, {})[q] = lo + (hi - lo) * (spots[i] - math.floor(spots[i]))
    return quarters


def rmse(df: DataFrame, prediction: str, label: str, keys: Sequence[str] = (), out: str = "rmse") -> DataFrame:
    """Root of the mean squared error over the rows where both are known."""
    error = F.col(prediction) - F.col(label)
    return df.groupBy(*keys).agg(F.count(error).alias("n_rows"), F.sqrt(F.avg(error * error)).alias(out))


def binary_metrics(df: DataFrame, prediction: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts, precision, recall and F1 of class 1, and the number of predicted positives."""
    p, y = F.col(prediction) == 1, F.col(label) == 1
    counts = df.groupBy(*keys).agg(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn")
    )

    def share(x: Column, whole: Column) -> Column:
        return F.when(whole == 0, F.lit(0.0)).otherwise(x / F.nullif(whole, F.lit(0)))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
            "defects_predicted": tp + fp,
        }
    )


def bin_counts(df: DataFrame, column: str, width: float, by: Sequence[str] = (), out: str = "n") -> DataFrame:
    """Rows per bin of equal width (by group): the data behind a scatter or bar chart."""
    lower = (F.floor(F.col(column) / width) * width).cast("double")
    return df.where(F.col(column).isNotNull()).groupBy(*by, lower.alias("bin")).agg(F.count(F.lit(1)).alias(out))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Values of the columns in the first row of each key."""
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return first.select(*keys, *[F.col("_first")[c].alias("first_" + c) for c in columns])


def earliest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows"))


def nearest_row(df: DataFrame, keys: Sequence[str], distance: Column, tie: str, columns: Sequence[str]) -> DataFrame:
    """Values of the columns in the row with the least distance; ties go to the lower ``tie``."""
    nearest = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(distance, F.col(tie))).alias("_near"))
    return nearest.select(*keys, *[F.col("_near")[c].alias(c) for c in columns])


def check_expectations(metrics: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Judge a one-row frame of metrics: ``{rule name: (metric, SQL condition)}`` to one row per rule."""
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(metric).cast("double").alias("value"),
                F.coalesce(F.expr(condition), F.lit(False)).alias("passed"),
            )
            for name, (metric, condition) in rules.items()
        ]
    )
    return metrics.select(F.inline(checks))
