"""Functions in Python over groups, rows and partitions, with bounded groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 2048
MERGE_ROWS = 200_000
#: Rows that a call on runs of keys gets at least, if there are so many.
RUN_ROWS = 50_000

Reducer = Callable[[pd.DataFrame], pd.DataFrame]


def per_group(
    df: DataFrame,
    keys: Sequence[str],
    partial: Reducer,
    partial_schema: T.StructType | str,
    merge: Reducer,
    finish: Reducer,
    schema: T.StructType | str,
) -> DataFrame:
    """A fit per key, written in pandas, which never brings the rows of a key together.

    * ``partial`` turns a batch of rows, of any keys, into one summary row per key;
    * ``merge`` turns summary rows into one per key, and must be associative;
    * ``finish`` turns the merged summaries (one row per key) into result rows.

    Each partition merges its own summaries before the shuffle, so a key with most of the rows
    costs one summary row per partition. All three work on many keys at once: there is no call
    per key. Functions that need rows in order are windows: see :mod:`devicelens.operators.ordered`.
    """

    def merged(frames: Iterable[pd.DataFrame]) -> pd.DataFrame | None:
        held: list[pd.DataFrame] = []
        count = 0
        for pdf in frames:
            held.append(pdf)
            count += len(pdf)
            if count > MERGE_ROWS and len(held) > 1:
                held = [merge(pd.concat(held, ignore_index=True))]
                # Grow with the number of keys, so that merging stays linear in the input.
                count = len(held[0]) // 2
        return merge(pd.concat(held, ignore_index=True)) if held else None

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = merged(partial(pdf) for pdf in frames if len(pdf))
        if found is not None:
            yield found

    def complete(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = merged(pdf for pdf in frames if len(pdf))
        if found is not None:
            yield finish(found)

    return df.mapInPandas(summarise, partial_schema).repartition(*keys).mapInPandas(complete, schema)


def run_starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Places where another key begins than in the row before; nulls are a key like others."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        column = rows.column(k).combine_chunks()
        here, before = column.slice(1), column.slice(0, max(0, len(column) - 1))
        differs = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def map_runs(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: T.StructType | str, rows: int = RUN_ROWS
) -> DataFrame:
    """Apply ``fn`` to whole keys, many at a time: rows in order, those of a key together, and the places where each key starts.

    A call per key costs milliseconds, and with very many keys most of the time. Here a task sorts its keys (on disk, where they
    do not fit) and passes at least ``rows`` rows at once; no key is cut, so memory is that of the largest one.
    The rows are dealt over all cores at least: what Python does to them is much for their size.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartition(parts, *keys).sortWithinPartitions(*keys, *order_by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, enough = 0, rows
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < enough:
                continue
            table = pa.Table.from_batches(held)
            starts = run_starts(table, keys)
            last = int(starts[-1])
            if last:
                yield from fn(table.slice(0, last), starts[:-1]).to_batches()
            held = table.slice(last).to_batches()
            count = table.num_rows - last
            enough = max(rows, 2 * count)  # a long key is looked through again only when it has doubled
        if count:
            table = pa.Table.from_batches(held)
            yield from fn(table, run_starts(table, keys)).to_batches()

    return placed.mapInArrow(run, schema)


def rebatch(frames: Iterable[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Cut a sequence of frames into frames of exactly ``size`` rows, the last one excepted."""
    held: list[pd.DataFrame] = []
    count = 0
    for pdf in frames:
        start = 0
        while start < len(pdf):
            take = min(size - count, len(pdf) - start)
            held.append(pdf.iloc[start : start + take])
            count += take
            start += take
            if count == size:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held, count = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def numeric_batches(
    df: DataFrame, columns: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str, batch: int = BATCH
) -> DataFrame:
    """Feed numeric columns to ``fn`` in batches of fixed size within each partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rebatch(frames, batch):
            yield fn(pdf)

    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(run, schema)


def make_udf(fn: Callable[..., pd.Series], returns: str = "double", **params) -> Callable[..., Column]:
    """A vectorised function of columns with parameters bound by a closure."""

    @F.pandas_udf(returns)
    def run(*columns: pd.Series) -> pd.Series:
        return fn(*columns, **params)

    return run
