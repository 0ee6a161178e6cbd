"""Rule-based defect labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelens.functions.scalars import deviation, rule_case
from devicelens.operators.lookup import lookup
from devicelens.operators.ordered import ROWS_PER_BLOCK, OrderedFrame
from devicelens.operators.profile import group_quantiles
from devicelens.plans.features import TEMPERATURE_COM
from devicelens.sources.sensor import local_defect_rules


def with_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probs: Mapping[str, float], rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """The quantiles of the row's own key beside each row."""
    return lookup(df, group_quantiles(df, keys, column, probs, rows_per_block=rows_per_block), keys)


def above_quantile(df: DataFrame, keys: Sequence[str], column: str, p: float, out: str) -> DataFrame:
    """Whether the value is above the p-quantile of its key."""
    compared = with_quantiles(df, keys, column, {"_q": p})
    return compared.withColumn(out, F.col(column) > F.col("_q")).drop("_q")


def defect_rules() -> list[Column]:
    """The five rules in order of precedence, on ``temp_gap``, ``p89`` and ``p93`` beside the telemetry."""
    # Gaps, percentiles, factory and models that the rules name.
    gap, temperature = F.col("temp_gap"), F.col("temperature")
    return [
        (gap > 1.8) & (F.col("factory_id") == "A06") & (temperature > F.col("p89")),
        (gap > 1.8) & (F.col("model_id") == "SkyJet234") & (temperature > F.col("p89")),
        (gap > 1.9) & (F.col("model_id") == "SkyJet334") & (temperature > F.col("p93")),
        *local_defect_rules(),
    ]


def label_defects(
    frame: OrderedFrame,
    rules: Sequence[Column] | None = None,
    outcomes: Sequence[float | int] | None = None,
    out: str = "defect",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Label each reading with the outcome of the first rule it meets (1 each when not given), else 0."""
    smoothed = frame.ewma("temperature", "_mean_temp", com=TEMPERATURE_COM, shift=1)
    smoothed = smoothed.with_column("temp_gap", deviation(F.col("temperature"), F.col("_mean_temp")))
    # The percentiles come from the plain readings, so their pass does not repeat the smoothing.
    quantiles = group_quantiles(frame.df, frame.keys, "temperature", {"p89": 0.89, "p93": 0.93}, rows_per_block=rows_per_block)
    df = lookup(smoothed.result(), quantiles, frame.keys)
    return df.withColumn(out, rule_case(rules or defect_rules(), outcomes)).drop("_mean_temp", "temp_gap", "p89", "p93")
