"""Registered queries, and SQL for the same views over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from devicelens.sources.sensor import ENGINE_MODELS, FACTORIES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with SQL for an independent check if it can be stated."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def _case(expression: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expression} {whens} END"


# `r` has the row-wise columns of the telemetry view, `s` all of them.
_READINGS = f"""
k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
r0 AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id,
    {_case("user_id % 5", FACTORIES)} AS factory_id,
    {_case("user_id % 14", ENGINE_MODELS)} AS model_id,
    ts,
    CASE WHEN k % 7 = 0 THEN NULL ELSE 15 + value * 0.5e0 END AS temperature,
    k * 10.0e0 AS rotation_speed, value * 0.4e0 AS delay, (k % 13) * 0.4e0 AS density,
    1113 - value * 1.25e0 AS air_pressure
  FROM k),
r AS (
  SELECT *, CASE WHEN (delay > 39 AND rotation_speed > 590) OR (density > 4.2e0 AND air_pressure < 780)
    THEN 1 ELSE 0 END AS defect
  FROM r0)"""
_SERIES = """,
s AS (
  SELECT *,
    CAST(dense_rank() OVER (PARTITION BY device_id ORDER BY CAST(ts AS DATE)) AS INTEGER) AS trip_id,
    lag(rotation_speed, 5) OVER (PARTITION BY device_id ORDER BY ts, event_id) / nullif(air_pressure, 0) AS airflow_rate
  FROM r)"""


def on_readings(select: str, *ctes: str) -> str:
    """SQL over the view ``r``; further CTEs may be given as ``name AS (…)``."""
    return "WITH " + ", ".join([_READINGS.strip(), *ctes]) + "\n" + select


def on_series(select: str, *ctes: str) -> str:
    """SQL over the views ``r`` and ``s``."""
    return "WITH " + ", ".join([(_READINGS + _SERIES).strip(), *ctes]) + "\n" + select
