"""One classifier per key (engine model): logistic models fitted for all keys at once, and forests in the ledger."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.functions.scalars import dot, sigmoid
from devicelens.operators.lookup import lookup, route_models
from devicelens.plans.forest import KeyedForest
from devicelens.plans.ledger import Ledger
from devicelens.plans.regress import unpack
from devicelens.session import cut
from devicelens.sources.tables import rows

RIDGE = 1e-4


def train_per_key(
    df: DataFrame,
    key: str,
    label: str,
    columns: Sequence[str],
    ridge: float = RIDGE,
    max_iter: int = 12,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Logistic regression per key: ``(key, n_used, bias, weights)``, one row per key.

    Every Newton step is one aggregation of gradient and curvature over all keys, combined
    before the shuffle: a key with most of the rows is spread like any other. Features are
    scaled by their mean and deviation over the table; the result is for the plain features.
    """
    columns = list(columns)
    spread = rows(df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))]))[0]
    centre = [float(spread[f"m{i}"] or 0.0) for i in range(len(columns))]
    width = [float(spread[f"s{i}"] or 0.0) or 1.0 for i in range(len(columns))]
    scaled = [((F.col(c) - centre[i]) / width[i]).alias(f"_f{i}") for i, c in enumerate(columns)]
    data = df.select(key, F.col(label).cast("double").alias("_y"), F.lit(1.0).alias("_one"), *scaled).persist()
    terms = [F.col("_one"), *[F.col(f"_f{i}") for i in range(len(columns))]]
    k = len(terms)
    start = data.groupBy(key).agg(F.count(F.lit(1)).alias("n_used"))
    beta = cut(start.select(key, "n_used", F.array(*[F.lit(0.0)] * k).alias("_beta"), F.lit(np.inf).alias("_move")))
    n_keys = beta.count()
    try:
        for _ in range(max_iter):
            beta = cut(_newton_step(data, beta, n_keys, key, terms, ridge))
            if beta.agg(F.max("_move")).first()[0] < tolerance:
                break
    finally:
        data.unpersist()
    slopes = [F.col("_beta")[i + 1] / width[i] for i in range(len(columns))]
    bias = F.col("_beta")[0]
    for i, slope in enumerate(slopes):
        bias = bias - slope * centre[i]
    return beta.select(key, "n_used", bias.alias("bias"), F.array(*slopes).alias("weights"))


def _newton_step(data: DataFrame, beta: DataFrame, n_keys: int, key: str, terms: Sequence[Column], ridge: float) -> DataFrame:
    k = len(terms)
    p = sigmoid(dot(F.col("_beta"), F.array(*terms)))
    with_p = lookup(data, beta.select(key, "_beta"), [key], materialise=False, n_rows=n_keys).withColumn("_p", p)
    curve = F.col("_p") * (1 - F.col("_p"))
    hessian = F.array(*[F.sum(curve * a * b) for i, a in enumerate(terms) for b in terms[i:]])
    gradient = F.array(*[F.sum((F.col("_y") - F.col("_p")) * a) for a in terms])
    sums = with_p.groupBy(key).agg(hessian.alias("_h"), gradient.alias("_g"))

    @F.pandas_udf("array<double>")
    def move(h: pd.Series, g: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        beta = np.array([np.asarray(v, dtype=float) for v in b])
        penalty = ridge * n.to_numpy(dtype=float)[:, None] * np.ones(k)
        penalty[:, 0] = ridge * 1e-3  # the bias is all but free
        curvature = unpack(h, k) + penalty[:, :, None] * np.eye(k)
        pull = np.array([np.asarray(v, dtype=float) for v in g]) - penalty * beta
        # Steps on separable keys grow without bound; a limit on each keeps the weights finite.
        step = np.clip(np.linalg.solve(curvature, pull[:, :, None])[:, :, 0], -5.0, 5.0)
        return pd.Series(list(beta + step), dtype="object")

    joined = lookup(sums, beta, [key], "inner", materialise=False, n_rows=n_keys)
    moved = joined.withColumn("_new", move("_h", "_g", "_beta", "n_used"))
    gap = F.array_max(F.zip_with("_new", "_beta", lambda a, b: F.abs(a - b)))
    return moved.select(key, "n_used", F.col("_new").alias("_beta"), gap.alias("_move"))


def apply_per_key(df: DataFrame, models: DataFrame, key: str, columns: Sequence[str], out: str = "probability") -> DataFrame:
    """Probability by the model of the row's own key; null where there is none."""
    routed = route_models(df, models.select(key, "bias", "weights"), key)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return routed.withColumn(out, sigmoid(F.col("bias") + dot(values, F.col("weights")))).drop("bias", "weights")


def log_forest_per_key(ledger: Ledger, forest: KeyedForest, name: str, **parent) -> str:
    """Forests logged as one child run per key below one parent, which holds them all; the parent's id.

    The child runs are written by one job from the forests themselves, so their number does not matter.
    """
    run_id = ledger.log_saved(forest.save, name, **parent)
    path = ledger.model_path(run_id)
    text = lambda c: F.col(c).cast("string")
    ledger.append_runs(
        forest.models.select(
            F.concat_ws("/", F.lit(run_id), "key").alias("run_id"),
            F.lit(run_id).alias("parent_run_id"),
            F.col("key").alias("name"),
            F.create_map(F.lit("depth"), F.lit(str(forest.depth)), F.lit("trees"), F.size("trees").cast("string")).alias("params"),
            F.create_map(F.lit("n_used"), F.col("n_used").cast("double"), F.lit("n_positive"), F.col("n_positive").cast("double")).alias("metrics"),
            F.create_map(F.lit(forest.key), text("key")).alias("tags"),
            F.lit(path).alias("model_path"),
        )
    )
    return run_id


def load_forest_per_key(ledger: Ledger, parent_run_id: str) -> KeyedForest:
    return KeyedForest.load(ledger.spark, ledger.model_path(parent_run_id))
