"""Telemetry schema, and a telemetry view over an ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.functions.scalars import nth_of, ratio, rule_case
from devicelens.operators.ordered import ROWS_PER_BLOCK, OrderedFrame, ordered

# Factories and engine models of the telemetry data.
FACTORIES = ["A06", "D18", "J15", "C04", "T10"]
ENGINE_MODELS = [
    "SkyJet134", "SkyJet234", "SkyJet334", "EcoJet1000", "JetLift7000", "EcoJet2000", "FlyForceX550",
    "TurboFan3200", "SkyBolt1", "SkyBolt2", "MightyWing1100", "EcoJet3000", "AeroGlider4150", "SkyBolt250",
]
# Thresholds of the two purely local defect rules.
DELAY_LIMIT, ROTATION_LIMIT = 39, 590
DENSITY_LIMIT, PRESSURE_LIMIT = 4.2, 780

VOCABULARY = {"factory_id": FACTORIES, "model_id": ENGINE_MODELS}
KEY = ["device_id"]
ORDER = ["ts", "event_id"]

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("trip_id", T.IntegerType()),
        T.StructField("factory_id", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("airflow_rate", T.DoubleType()),
        T.StructField("rotation_speed", T.DoubleType()),
        T.StructField("air_pressure", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("delay", T.FloatType()),
        T.StructField("density", T.FloatType()),
        T.StructField("defect", T.FloatType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_defect_rules() -> list[Column]:
    """The rules that need the row alone."""
    return [
        (F.col("delay") > DELAY_LIMIT) & (F.col("rotation_speed") > ROTATION_LIMIT),
        (F.col("density") > DENSITY_LIMIT) & (F.col("air_pressure") < PRESSURE_LIMIT),
    ]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One telemetry reading per event: all columns that need no other row."""
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            F.col("user_id").cast("string").alias("device_id"),
            nth_of(FACTORIES, F.col("user_id") % len(FACTORIES)).alias("factory_id"),
            nth_of(ENGINE_MODELS, F.col("user_id") % len(ENGINE_MODELS)).alias("model_id"),
            "ts",
            F.when(k % 7 == 0, None).otherwise(15 + value * 0.5).alias("temperature"),
            (k * 10.0).alias("rotation_speed"),
            (value * 0.4).alias("delay"),
            ((k % 13) * 0.4).alias("density"),
            (1113 - value * 1.25).alias("air_pressure"),
        )
        .withColumn("defect", rule_case(local_defect_rules()))
    )


def assign_trips(frame: OrderedFrame, ts: str = "ts", grain: str = "day", out: str = "trip_id") -> OrderedFrame:
    """Trip number: the n-th distinct day (week, month …) on which the device reported."""
    day = F.to_date(ts) if grain == "day" else F.date_trunc(grain, ts)
    return frame.dense_rank(day, out)


def airflow(frame: OrderedFrame, rotation: str, pressure: str, n: int = 5, out: str = "airflow_rate", within=()) -> OrderedFrame:
    """Rotation speed n readings ago over the present air pressure."""
    frame = frame.lag(rotation, n, "_rotation", within)
    return frame.with_column(out, ratio(F.col("_rotation"), F.col(pressure))).without("_rotation")


def series(spark: SparkSession, sf_dir: str, rows_per_block: int = ROWS_PER_BLOCK) -> OrderedFrame:
    """Readings as one ordered series per device."""
    return ordered(readings(spark, sf_dir), KEY, ORDER, rows_per_block)


def telemetry(spark: SparkSession, sf_dir: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The complete telemetry view: readings with trip number and airflow."""
    frame = airflow(assign_trips(series(spark, sf_dir, rows_per_block)), "rotation_speed", "air_pressure")
    return frame.result()
