"""Equi-joins of large frames with one-row-per-key tables, safe for busy keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.session import cut

#: A table goes by broadcast up to so many rows, if they also take no more than so many bytes (as JSON).
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
BUSY_SHARE = 1 / 2000
SAMPLE_FRACTION = 1e-3
SALTS = 64


def null_safe(names: Sequence[str], prefix: str) -> Column:
    """Join condition ``name <=> prefix+name`` for all names."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(prefix + name))
    return condition


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS,
    busy_share: float = BUSY_SHARE,
    materialise: bool = True,
    n_rows: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``table`` (at most one row per key) to ``df`` on equal, or equally null, keys.

    A table of up to ``max_broadcast_rows`` rows and ``max_broadcast_bytes`` is broadcast. A larger one is
    shuffled, in one join: keys which hold at least ``busy_share`` of the rows of ``df`` (at most 1/share of
    them) are dealt over ``SALTS`` parts, and their rows of the table are there for each part.

    The size must be known first, so the table is materialised: it is small beside ``df``, and
    what it takes to compute it is then done once. Pass False for a table that is stored already,
    and ``n_rows`` where its number of rows is known.
    """
    on = list(on)
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if materialise:
        table = cut(table)
    if n_rows is None or n_rows <= max_broadcast_rows:
        known = table.limit(max_broadcast_rows + 1) if n_rows is None else table.limit(1_000)
        n, size = known.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct("*"))))).first()
        size = (size or 0) if n_rows is None else (size or 0) / max(1, n) * n_rows
        if (n if n_rows is None else n_rows) <= max_broadcast_rows and size <= max_broadcast_bytes:
            return _join(df, table, on, how, small=True)
    busy = _busy_keys(df, on, busy_share).withColumn("_busy", F.lit(True))
    hashed = [F.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(SALTS)).cast("int")
    left = _join(df, busy, on, "left", small=True).withColumn("_salt", F.when(F.col("_busy"), salt).otherwise(0)).drop("_busy")
    copies = F.sequence(F.lit(0), F.when(F.col("_busy"), SALTS - 1).otherwise(0))
    right = _join(table, busy, on, "left", small=True).withColumn("_salt", F.explode(copies)).drop("_busy")
    return _join(left, right, [*on, "_salt"], how, small=False).drop("_salt")


def _join(df: DataFrame, table: DataFrame, on: list[str], how: str, small: bool) -> DataFrame:
    right = table.withColumnsRenamed({c: "_r_" + c for c in on})
    joined = df.join(F.broadcast(right) if small else right, null_safe(on, "_r_"), how)
    return joined.drop(*["_r_" + c for c in on])


def _busy_keys(df: DataFrame, on: list[str], share: float) -> DataFrame:
    """Keys with at least the given share of the rows of a sample; materialised, so all uses agree."""
    counts = cut(df.select(*on).sample(SAMPLE_FRACTION, seed=17).groupBy(*on).count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    if total < 1 / share:  # too few sampled rows to tell: count all
        counts = cut(df.select(*on).groupBy(*on).count())
        total = counts.agg(F.sum("count")).first()[0] or 0
    return cut(counts.where(F.col("count") >= max(1.0, total * share)).select(*on))


def enrich_daily(df: DataFrame, daily: DataFrame, on: str = "date") -> DataFrame:
    """Left-join a table with one row per day."""
    return lookup(df, daily, [on])


def route_models(df: DataFrame, models: DataFrame, key: str = "model_id", keep_unrouted: bool = True) -> DataFrame:
    """Bring each row the model of its own key; rows without one keep nulls or are left out."""
    return lookup(df, models, [key], "left" if keep_unrouted else "inner")
