"""Data-quality metrics of a telemetry table, and the ranges they should lie in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.operators.profile import rate_of

# Accepted ranges of the telemetry data.
QUALITY_RULES = {
    "SkyJet234 defect rate": ("skyjet234_rate", "skyjet234_rate < 0.06e0"),
    "SkyJet334 defect rate": ("skyjet334_rate", "skyjet334_rate < 0.06e0"),
    "overall defect rate": ("defect_rate", "defect_rate > 0.005e0 and defect_rate < 0.035e0"),
    "no null temperature": ("temperature_nulls", "temperature_nulls = 0"),
    "no null airflow": ("airflow_nulls", "airflow_nulls = 0"),
    "average temperature": ("avg_temperature", "avg_temperature > 0 and avg_temperature < 100"),
    "minimum temperature": ("min_temperature", "min_temperature > -100"),
    "maximum temperature": ("max_temperature", "max_temperature < 150"),
    "average rotation": ("avg_rotation_speed", "avg_rotation_speed < 1000"),
    "average density": ("avg_density", "avg_density < 6"),
}


def quality_metrics(df: DataFrame) -> DataFrame:
    """All metrics in one aggregation: one scan, one row."""
    defect = F.col("defect") == 1
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("temperature").isNull()).alias("temperature_nulls"),
        F.count_if(F.col("airflow_rate").isNull()).alias("airflow_nulls"),
        rate_of(defect).alias("defect_rate"),
        *[rate_of(defect, F.col("model_id") == m).alias(f"{m.lower()}_rate") for m in ("SkyJet234", "SkyJet334")],
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.avg("rotation_speed").alias("avg_rotation_speed"),
        F.avg("density").alias("avg_density"),
    )
