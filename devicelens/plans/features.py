"""Feature table of a telemetry table: trips, smoothed temperature and density, fills, one-hot columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.functions.scalars import smoothed_gap
from devicelens.operators.columns import one_hot
from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import OrderedFrame

# Decay of the two smoothed columns.
TEMPERATURE_COM = 5
DENSITY_SPAN = 600


def add_rolling_temp(frame: OrderedFrame, shift: int = 1, within: Sequence[str] = ("trip_id",)) -> OrderedFrame:
    """``rolling_mean_temp`` and ``temp_difference`` (mean minus actual)."""
    frame = frame.ewma("temperature", "rolling_mean_temp", com=TEMPERATURE_COM, shift=shift, within=within)
    return frame.with_column("temp_difference", smoothed_gap(F.col("temperature"), F.col("rolling_mean_temp")))


def add_rolling_density(frame: OrderedFrame, shift: int = 1) -> OrderedFrame:
    """``rolling_mean_density`` over all trips of the device."""
    return frame.ewma("density", "rolling_mean_density", span=DENSITY_SPAN, shift=shift)


def feature_frame(
    frame: OrderedFrame,
    fill_columns: Sequence[str] = ("airflow_rate", "rotation_speed", "air_pressure", "temperature", "delay", "density"),
    trip: Sequence[str] = ("trip_id",),
    shift: int = 1,
) -> OrderedFrame:
    """Smoothed and filled columns beside the telemetry of a frame that has a trip number.

    All windows use the partitioning of the frame: one shuffle in all. Nulls are filled forward
    within the trip (all listed columns and the smoothed ones), then with 0.
    """
    frame = add_rolling_temp(frame, shift, trip)
    frame = frame.fill([*fill_columns, "rolling_mean_temp", "temp_difference"], ["ffill", 0], trip)
    # The mean itself carries on over nulls: only its head can be null.
    return add_rolling_density(frame, shift).fill(["rolling_mean_density"], [0])


def build_features(frame: OrderedFrame, vocab: Mapping[str, Sequence[str]] | None, **options) -> DataFrame:
    """:func:`feature_frame` as a table. One-hot columns come last, so that they are never shuffled."""
    df = feature_frame(frame, **options).result()
    return one_hot(df, vocab) if vocab else df


def center(df: DataFrame, column: str, keys: Sequence[str], out: str) -> DataFrame:
    """Absolute deviation from half the mean of the key."""
    means = df.groupBy(*keys).agg(F.avg(column).alias("_mean"))
    return lookup(df, means, keys).withColumn(out, F.abs(F.col(column) - F.col("_mean") / 2)).drop("_mean")
