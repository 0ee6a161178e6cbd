"""Stream scoring: equal to batch scoring, restartable, idempotent, named, continuous."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators.ordered import ordered
from devicelens.plans.features import build_features
from devicelens.session import scratch_path
from devicelens.sources.sensor import airflow, assign_trips, readings
from devicelens.sources.tables import stream_table, write_path
from devicelens.streaming.features import write_features
from devicelens.streaming.score import drain, score_stream, write_batch


def scorer(df):
    return df.select("event_id", (F.col("delay") > 30).cast("int").alias("predictions"))


def scored(spark, sink):
    return sorted(map(tuple, spark.read.parquet(sink).select("event_id", "predictions").collect()))


def test_drain_restart_and_replay(spark, sf_dir):
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
    df = readings(spark, sf_dir)
    head, tail = df.where("event_id < 400"), df.where("event_id >= 400")
    write_path(head, source)

    def run():
        query = score_stream(stream_table(spark, source, files_per_batch=1), scorer, sink, checkpoint, name="stream_to_predictions")
        assert query.name == "stream_to_predictions"
        drain(query, 120)

    run()
    assert scored(spark, sink) == sorted(map(tuple, scorer(head).collect()))
    run()  # nothing new
    assert scored(spark, sink) == sorted(map(tuple, scorer(head).collect()))
    write_path(tail, source, mode="append")
    run()
    assert scored(spark, sink) == sorted(map(tuple, scorer(df).collect()))
    # A replayed batch replaces its own rows only.
    write_batch(scorer(head), 0, sink)
    assert scored(spark, sink) == sorted(map(tuple, scorer(df).collect()))


def test_continuous_until_stopped(spark, sf_dir):
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
    write_path(readings(spark, sf_dir).limit(50), source)
    query = score_stream(stream_table(spark, source), scorer, sink, checkpoint, trigger=None)
    try:
        query.processAllAvailable()
        assert query.isActive and len(scored(spark, sink)) == 50
        write_path(readings(spark, sf_dir).limit(10), source, mode="append")
        time.sleep(0.1)
        query.processAllAvailable()
        assert len(scored(spark, sink)) == 60
        with pytest.raises(TimeoutError):
            drain(query, 1)
    finally:
        query.stop()


def test_table_stream(spark, sf_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_test")
    readings(spark, sf_dir).limit(30).write.mode("overwrite").saveAsTable("stream_test.features")
    try:
        sink = scratch_path(spark, "sink")
        drain(score_stream(stream_table(spark, "stream_test.features"), scorer, sink, scratch_path(spark, "checkpoint")), 120)
        assert len(scored(spark, sink)) == 30
    finally:
        spark.sql("DROP DATABASE stream_test CASCADE")


def test_features_of_a_stream_equal_those_of_the_table(spark):
    """Random readings with gaps in three runs, with a restart between them, against the batch operators."""
    rng = np.random.default_rng(9)
    n = 400
    pdf = pd.DataFrame({"event_id": np.arange(n), "device_id": rng.choice(["a", "b", "c"], n, p=[0.7, 0.25, 0.05])})
    pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 60 * 24 * 50, n)), unit="min")
    for c in ("rotation_speed", "air_pressure", "temperature", "delay", "density"):
        pdf[c] = rng.normal(50, 9, n).round(2)
        if c != "density":
            pdf.loc[rng.random(n) < 0.2, c] = np.nan
    pdf.loc[5, "air_pressure"] = 0.0
    pdf["factory_id"], pdf["model_id"], pdf["defect"] = "f", "m", 0
    plain = [[None if x != x else x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in row] for row in pdf.astype(object).itertuples(index=False)]
    numbers = ", ".join(f"{c} double" for c in pdf.columns[3:8])
    df = spark.createDataFrame(plain, f"event_id long, device_id string, ts timestamp_ntz, {numbers}, factory_id string, model_id string, defect int")
    frame = assign_trips(ordered(df, ["device_id"], ["ts", "event_id"]), grain="week")
    batch = build_features(airflow(frame, "rotation_speed", "air_pressure", within=["trip_id"]), None).toPandas().set_index("event_id").sort_index()
    source, sink, checkpoint = (scratch_path(spark, x) for x in ("source", "sink", "checkpoint"))
    for low, high in ((0, 150), (150, 151), (151, n)):
        write_path(df.where(F.col("event_id").between(low, high - 1)), source, mode="append")
        drain(write_features(stream_table(spark, source), sink, checkpoint), 120)
    got = spark.read.parquet(sink).toPandas().set_index("event_id").sort_index()
    assert got.index.tolist() == list(range(n))
    for c in ("trip_id", "airflow_rate", "rotation_speed", "air_pressure", "temperature", "delay", "density", "rolling_mean_temp", "temp_difference", "rolling_mean_density"):
        np.testing.assert_allclose(got[c].astype(float), batch[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_devices_of_a_stream_share_groups(spark, monkeypatch):
    """Many devices make no more groups than there are, and each keeps a state of its own over a restart."""
    from devicelens.streaming import features

    monkeypatch.setattr(features, "GROUPS", 4)
    n = 240
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp_ntz").alias("ts")
    numbers = [((F.col("id") * k) % 17 + 1.0).alias(c) for k, c in enumerate(("rotation_speed", "air_pressure", "temperature", "delay", "density"), 2)]
    device = F.when(F.col("id") % 80 != 7, F.concat(F.lit("d"), F.col("id") % 80)).alias("device_id")
    df = spark.range(n).select(F.col("id").alias("event_id"), device, t, *numbers, F.lit("f").alias("factory_id"), F.lit("m").alias("model_id"), F.lit(0).alias("defect"))
    source, sink, checkpoint = (scratch_path(spark, x) for x in ("source", "sink", "checkpoint"))
    for low, high in ((0, 100), (100, n)):
        write_path(df.where(F.col("event_id").between(low, high - 1)), source, mode="append")
        query = write_features(stream_table(spark, source), sink, checkpoint)
        drain(query, 120)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    frame = assign_trips(ordered(df, ["device_id"], ["ts", "event_id"]), grain="week")
    batch = build_features(airflow(frame, "rotation_speed", "air_pressure", within=["trip_id"]), None).toPandas().set_index("event_id").sort_index()
    got = spark.read.parquet(sink).toPandas().set_index("event_id").sort_index()
    assert got.index.tolist() == list(range(n)) and got["device_id"].isna().sum() == 3
    for c in ("trip_id", "airflow_rate", "temperature", "rolling_mean_temp", "temp_difference", "rolling_mean_density"):
        np.testing.assert_allclose(got[c].astype(float), batch[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
