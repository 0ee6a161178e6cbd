"""Training tables for the neural classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from devicelens.operators.sampling import indexed_split
from devicelens.sources.tables import write_path


def prepare_training(
    df: DataFrame,
    order_by: Sequence[str],
    fraction: float = 0.7,
    drop: Sequence[str] = (),
    train_path: str | None = None,
    test_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Number the rows in time order, split head and tail, drop the key columns, write both if asked.

    Columns in ``order_by`` may be among the dropped ones: they go after the numbering.
    """
    train, test = (part.drop(*drop) for part in indexed_split(df, fraction, order_by))
    for part, path in ((train, train_path), (test, test_path)):
        if path:
            write_path(part, path)
    return train, test
