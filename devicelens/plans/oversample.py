"""Synthetic minority oversampling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.functions.scalars import hash_int, unit_hash
from devicelens.operators.lookup import lookup
from devicelens.operators.neighbours import knn_self
from devicelens.operators.profile import class_balance
from devicelens.operators.sampling import global_index
from devicelens.sources.tables import repeat_rows, rows


def smote(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    ident: str,
    k: int = 5,
    seed: int = 0,
    search: Callable[..., DataFrame] = knn_self,
    **options,
) -> DataFrame:
    """Add synthetic rows of the rarer class (label 1 or 0) until both classes have the same size.

    Each synthetic row lies between a minority row and one of its k nearest minority
    neighbours: ``a + u (b - a)`` with the neighbour and ``u`` chosen by a hash. The copies are
    spread evenly over the minority rows. Give it the training rows only. ``search`` finds the
    neighbours (with ``options``): exactly, or by ``knn_forest`` where there are many columns. Columns of
    the result: the features, the label and ``synthetic``.
    """
    columns = list(columns)
    counts = {r[label]: r["n"] for r in rows(class_balance(df, label))}
    if len(counts) != 2:
        raise ValueError(f"two classes are needed, found {sorted(counts, key=str)}")
    minority = min(counts, key=lambda c: (counts[c], str(c)))
    m = counts[minority]
    missing = max(counts.values()) - m
    original = df.select(*columns, label, F.lit(False).alias("synthetic"))
    if not missing or m < 2:
        return original
    k = min(k, m - 1)
    rare = df.where(F.col(label) == minority).select(F.col(ident).alias("_a"), *columns)
    found = search(rare, columns, "_a", k, **options)
    near = found.groupBy("_a").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("neighbour_id").alias("b")))).alias("_near"))

    # Row number i of the m rare rows makes floor(missing / m) copies, the first ones one more.
    numbered = global_index(rare, ["_a"], "_i")
    share = F.lit(missing // m) + (F.col("_i") <= missing % m).cast("long")
    copies = repeat_rows(numbered.withColumn("_n", share).drop("_i"), F.col("_n"), "_c").drop("_n")
    draw = F.concat_ws("|", "_a", "_c", F.lit(seed))
    ends = rare.select(F.col("_a").alias("_b"), *[F.col(c).alias("_to_" + c) for c in columns])
    drawn = lookup(copies.withColumn("_u", unit_hash(draw, "|u")), near, ["_a"], "inner")
    drawn = drawn.withColumn("_b", F.get("_near", (hash_int(draw, "|n") % F.size("_near")).cast("int"))["b"]).drop("_near")
    made = lookup(drawn, ends, ["_b"], "inner")

    def between(c: str) -> Column:
        return (F.col(c) + F.col("_u") * (F.col("_to_" + c) - F.col(c))).alias(c)

    label_type = df.schema[label].dataType
    synthetic = made.select(*[between(c) for c in columns], F.lit(minority).cast(label_type).alias(label), F.lit(True).alias("synthetic"))
    return original.unionByName(synthetic)
