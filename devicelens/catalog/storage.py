"""Queries that write, read back and compare: tables, replayed streams, runs and versions in the ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from devicelens.catalog.learning import _BIAS, _RUNS, _WEIGHTS, _logit, _logit_sql, _runs
from devicelens.catalog.registry import on_readings, query
from devicelens.catalog.series import _FEATURE_SQL, _SMOOTHED, FEATURE_CTES
from devicelens.catalog.tabular import r6
from devicelens.operators.columns import one_hot, with_constant
from devicelens.plans.ledger import Ledger
from devicelens.plans.models import train_rf
from devicelens.session import cut, scratch_path
from devicelens.sources.sensor import VOCABULARY, readings
from devicelens.sources.tables import from_local, read_table, reset_schema, rows, stream_table, table_names, to_local, write_path, write_table
from devicelens.streaming.features import write_features
from devicelens.streaming.score import drain, score_stream, write_batch


@query(
    on_readings(
        """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN delay END AS delay, CASE WHEN event_id % 2 = 1 THEN density END AS density,
        'checked' AS state FROM r"""
    )
)
def table_round_trip(spark, sf_dir):
    """A managed table written with one column, appended to with another, and read back with both."""
    name = f"round_trip_{uuid.uuid4().hex}"
    df = with_constant(readings(spark, sf_dir).select("event_id", "delay", "density"), "state", "checked")
    try:
        write_table(df.where("event_id % 2 = 0").drop("density"), name)
        write_table(df.where("event_id % 2 = 1").drop("delay"), name, mode="append", merge_schema=True)
        return cut(read_table(spark, name).select("event_id", "delay", "density", "state"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query(on_readings("SELECT factory_id, count(*) AS n_rows, round(sum(delay), 4) AS delay FROM r GROUP BY factory_id"))
def folder_round_trip(spark, sf_dir):
    """A partitioned folder, read back and summed up; the small result goes to the driver and returns."""
    path = scratch_path(spark, "round_trip")
    write_path(readings(spark, sf_dir), path, partition_by=["factory_id"])
    found = read_table(spark, path).groupBy("factory_id").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("delay"), 4).alias("delay"))
    return from_local(spark, to_local(found), "factory_id string, n_rows long, delay double")


@query(on_readings(f"SELECT event_id, CAST({_logit_sql(_WEIGHTS, _BIAS)} > 0.5e0 AS INTEGER) AS predictions FROM r"))
def stream_restart(spark, sf_dir):
    """A stream in two runs from one checkpoint, more rows between them, and a batch played again: each row once."""
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
    df = readings(spark, sf_dir)

    def scorer(batch):
        return batch.select("event_id", (_logit(_WEIGHTS, _BIAS) > 0.5).cast("int").alias("predictions"))

    head, tail = df.where("event_id % 3 = 0"), df.where("event_id % 3 <> 0")
    write_path(head, source)
    for more in (tail, None):
        drain(score_stream(stream_table(spark, source), scorer, sink, checkpoint))
        if more is not None:
            write_path(more, source, mode="append")
    write_batch(scorer(head), 0, sink)
    return spark.read.parquet(sink).drop("batch_id")


@query(on_readings("SELECT run_id AS name, CASE WHEN n > 0 THEN n::DOUBLE ELSE 0 END AS n_defects, 'string' AS key_type FROM runs WHERE parent_run_id IS NULL", _RUNS))
def ledger_runs(spark, sf_dir):
    """One logged run per factory, with parameters, metrics and the signature of its rows, read back from the ledger."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    for r in rows(_runs(spark, sf_dir).where("parent_run_id is null")):
        ledger.log_run(r["name"], {"factory": r["name"]}, r["metrics"], {"factory_id": r["name"]}, inputs=readings(spark, sf_dir).select("device_id"))
    kind = F.get_json_object("signature", "$.fields[0].type")
    return ledger.runs().select("name", F.coalesce(F.col("metrics")["n_defects"], F.lit(0.0)).alias("n_defects"), kind.alias("key_type"))


@query(
    on_readings(
        """SELECT name, CAST(version AS INTEGER) AS version, CASE version WHEN 1 THEN 'Archived' ELSE 'Production' END AS stage
        FROM (SELECT DISTINCT factory_id AS name FROM r), (SELECT unnest([1, 2]) AS version)"""
    )
)
def ledger_versions(spark, sf_dir):
    """Two versions of a model per factory; the second one goes to production and the first to the archive."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    for r in rows(readings(spark, sf_dir).select("factory_id").distinct().orderBy("factory_id")):
        for version in (1, 2):
            assert ledger.register(r["factory_id"], ledger.log_run(f"{r['factory_id']} {version}")) == version
            ledger.set_stage(r["factory_id"], version, "Production")
        ledger.set_stage(r["factory_id"], 1, "Archived")
    return ledger.stages().join(ledger.versions().select("name", "version"), ["name", "version"])


@query(on_readings(_FEATURE_SQL, *FEATURE_CTES))
def stream_features(spark, sf_dir):
    """The feature table of raw readings that come as a stream, in two runs from one checkpoint: the same as the batch table."""
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
    df = readings(spark, sf_dir)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = df.agg(F.percentile_approx(at, 0.4)).first()[0]
    write_path(df.where(at <= middle), source)
    for more in (df.where(at > middle), None):
        drain(write_features(stream_table(spark, source), sink, checkpoint, finish=lambda batch: one_hot(batch, VOCABULARY)))
        if more is not None:
            write_path(more, source, mode="append")
    found = spark.read.parquet(sink).drop("batch_id", "ts")
    return found.withColumns({c: r6(c) for c in _SMOOTHED})


@query(on_readings(f"SELECT event_id, CAST({_logit_sql(_WEIGHTS, _BIAS)} > 0.5e0 AS INTEGER) AS predictions, 'named' AS stream_name FROM r"))
def stream_continuous(spark, sf_dir):
    """A named stream without a trigger, which runs on until it is stopped."""
    source, sink = scratch_path(spark, "source"), scratch_path(spark, "sink")
    write_path(readings(spark, sf_dir), source)

    def scorer(batch):
        return batch.select("event_id", (_logit(_WEIGHTS, _BIAS) > 0.5).cast("int").alias("predictions"))

    name = f"named_{uuid.uuid4().hex[:8]}"
    running = score_stream(stream_table(spark, source), scorer, sink, scratch_path(spark, "checkpoint"), trigger=None, name=name)
    try:
        running.processAllAvailable()
        shown = running.name.split("_")[0] if running.isActive else "ended"
    finally:
        running.stop()
    return spark.read.parquet(sink).drop("batch_id").withColumn("stream_name", F.lit(shown))


@query(on_readings("SELECT factory_id, factory_id || '_user_sensor_bronze' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_before FROM r GROUP BY factory_id"))
def reset_names(spark, sf_dir):
    """Tables named after their user, in a schema that is reset: what was in it before is gone."""
    schema = f"reset_{uuid.uuid4().hex[:12]}"
    df, parts = readings(spark, sf_dir).select("event_id", "factory_id"), []
    factories = [r["factory_id"] for r in rows(df.select("factory_id").distinct())]
    try:
        for user in ("old", *factories):
            names = table_names(f"{user}.user@example.com", schema)
            if user in ("old", factories[0]):
                reset_schema(spark, names)
            before = 0 if user != factories[0] else spark.sql(f"SHOW TABLES IN {schema}").count()
            write_table(df.where(F.col("factory_id") == user), names["bronze_table"])
            if user != "old":
                shown = read_table(spark, names["bronze_table"]).groupBy("factory_id").agg(F.count(F.lit(1)).alias("n_rows"))
                parts.append(shown.withColumn("table_name", F.lit(names["bronze_table"].split(".")[1])).withColumn("n_before", F.lit(before).cast("long")))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return cut(found)
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


@query("SELECT unnest(['delay', 'density', 'rotation_speed', 'air_pressure']) AS feature, 1e0 AS total, true AS plausible")
def run_importances(spark, sf_dir):
    """Importances kept with the run that they belong to, and read back from the ledger."""
    columns = ["delay", "density", "rotation_speed", "air_pressure"]
    df = readings(spark, sf_dir)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    model = train_rf(df, "defect", columns, trees=10)
    run = ledger.log_run("forest")
    found = read_table(spark, ledger.log_importances(run, model, columns))
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    return found.join(F.broadcast(total)).select("feature", "total", F.col("importance").between(0.0, 1.0).alias("plausible"))
