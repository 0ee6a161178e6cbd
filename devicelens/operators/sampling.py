"""Row samples and ordered splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from devicelens.functions.scalars import unit_hash
from devicelens.operators.ordered import BLOCK, ROWS_PER_BLOCK, ordered
from devicelens.session import stored


def row_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample; depends on the partitioning of the data."""
    return df.sample(fraction, seed)


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Bernoulli sample by a hash of the key: the same rows on every run and in every layout."""
    return df.where(unit_hash(F.col(key), salt) < fraction)


def global_index(df: DataFrame, order_by: Sequence[str], out: str = "id", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Dense row number 1 … n over the whole table in the given order, without a single-task window."""
    return ordered(df, [], order_by, rows_per_block).row_number(out).result()


def row_at(df: DataFrame, order_by: Sequence[str], rank: int, rows_per_block: int = ROWS_PER_BLOCK) -> Row | None:
    """Values of the order columns in row number ``rank`` (from 1) of the whole table.

    Only the order columns are read; of a large table only the one block that holds the row is sorted.
    """
    frame = ordered(df.select(*order_by), [], order_by, rows_per_block)
    narrow = frame.df
    if frame.split:
        sizes = narrow.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n"))
        upto = sizes.withColumn("upto", F.sum("n").over(Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)))
        home = upto.where(F.col("upto") >= rank).orderBy(BLOCK).first()
        if home is None:
            return None
        narrow = narrow.where(F.col(BLOCK) == home[BLOCK])
        rank -= home["upto"] - home["n"]
    in_order = Window.partitionBy(*frame.keys).orderBy(*order_by)
    return narrow.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") == rank).select(*order_by).first()


def ordered_split(
    df: DataFrame, fraction: float, order_by: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The first ``floor(n * fraction)`` rows in order, and the rest.

    Both are filters on the order columns, which must be unique together: the rows themselves
    are neither sorted nor shuffled. Nulls come first in the order.
    """
    order_by = list(order_by)
    size = math.floor(df.count() * fraction)
    last = row_at(df, order_by, size, rows_per_block) if size else None
    if last is None:
        return df.where(F.lit(False)), df
    edge = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in order_by])
    in_head = F.struct(*order_by) <= edge
    head, tail = df.where(in_head), df.where(~in_head)
    first, value = F.col(order_by[0]), last[order_by[0]]
    if value is None:
        return head, tail
    # Comparing the first column by itself as well lets the scan skip files and row groups.
    value = F.lit(value).cast(df.schema[order_by[0]].dataType)
    return head.where(first.isNull() | (first <= value)), tail.where(first >= value)


def indexed_split(
    df: DataFrame, fraction: float, order_by: Sequence[str], id_column: str = "id", rows_per_block: int = ROWS_PER_BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The same split of a table that also gets dense row numbers in order; it is numbered once, and stored."""
    indexed = stored(global_index(df, order_by, id_column, rows_per_block), "indexed")
    last = math.floor(indexed.count() * fraction)
    return indexed.where(F.col(id_column) <= last), indexed.where(F.col(id_column) > last)
