"""Reading, writing and naming of tables; spines; bounded transfer to and from the driver."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicelens.session import scratch_path, shared_dir


def _is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, name: str, merge_schema: bool = False) -> DataFrame:
    """Read a catalog table, or a Parquet folder when the name is a path."""
    if not _is_path(name):
        return spark.read.table(name)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(name)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write a managed table.

    With ``merge_schema`` columns may come and go between writes: an append adds the new columns
    to the table first, and an overwrite takes the union of both column sets (absent ones null).
    ``bucket_by`` stores the rows hashed on a key, so that later joins and windows need no shuffle.
    """
    spark = df.sparkSession
    if merge_schema and spark.catalog.tableExists(name):
        old = spark.read.table(name).schema
        added = [f for f in df.schema if f.name not in old.fieldNames()]
        absent = [f for f in old if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df
        if mode == "append":
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            df = df.select(*old.fieldNames(), *[f.name for f in added])
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(name)


def write_path(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stream_table(spark: SparkSession, name: str, schema: T.StructType | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Read a catalog table, or a Parquet folder with the given schema, as a stream."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not _is_path(name):
        return reader.table(name)
    return reader.schema(schema or spark.read.parquet(name).schema).parquet(name)


def table_names(user: str, schema: str = "telemetry") -> dict[str, str]:
    """Names of the tables and folders that belong to a user."""
    slug = re.sub(r"\.", "_", user.split("@")[0])
    # The keys and suffixes that jobs refer to.
    tables = {
        "bronze_table": "sensor_bronze",
        "silver_table": "sensor_silver",
        "silver_features": "features_table",
        "predictions_table": "predictions",
    }
    folders = {
        "checkpoint_location": "sensor_checkpoints",
        "train_table": "train_table",
        "test_table": "test_table",
        "ledger": "ledger",
        "models": "models",
    }
    names = {"current_user": slug, "schema": schema, "model_name": f"device_defect_{slug}"}
    names |= {key: f"{schema}.{slug}_{suffix}" for key, suffix in tables.items()}
    names |= {key: f"{slug}_{schema}/{suffix}" for key, suffix in folders.items()}
    return names


def current_names(spark: SparkSession, schema: str = "telemetry") -> dict[str, str]:
    """:func:`table_names` of the current user; folders lie below the shared folder."""
    names = table_names(scalar(spark.sql("select current_user()")), schema)
    base = shared_dir(spark)
    return {key: os.path.join(base, value) if "/" in value else value for key, value in names.items()}


def reset_schema(spark: SparkSession, names: dict[str, str]) -> dict[str, str]:
    """Drop and create the schema. Returns names with a new checkpoint folder; the old one is left alone."""
    spark.sql(f"DROP SCHEMA IF EXISTS {names['schema']} CASCADE")
    spark.sql(f"CREATE SCHEMA {names['schema']}")
    return names | {"checkpoint_location": scratch_path(spark, "sensor_checkpoints")}


def from_local(spark: SparkSession, pdf: pd.DataFrame, schema: T.StructType | str) -> DataFrame:
    """A small local frame (a lookup table) with an explicit schema."""
    return spark.createDataFrame(pdf, schema)


def to_local(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """Bring a small result to the driver; refuses when there are more rows than allowed."""
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate or filter before bringing them to the driver")
    return pdf


def scalar(df: DataFrame):
    """First value of the first row."""
    row = df.first()
    return None if row is None else row[0]


def rows(df: DataFrame, cap: int = 10_000) -> list[Row]:
    """Few rows on the driver; refuses when there are more."""
    found = df.limit(cap + 1).collect()
    if len(found) > cap:
        raise ValueError(f"more than {cap} rows")
    return found


def row_spine(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """Ids 0 … n-1, made on the executors."""
    return spark.range(n).withColumnRenamed("id", name)


def time_spine(
    df: DataFrame, start: Column, step_seconds: int, out: str, n: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Repeat each row for start, start + step, … : ``n`` times or up to ``end``.

    Long series are made in chunks that are spread over the cluster, so one row may
    stand for any number of steps.
    """
    if (n is None) == (end is None):
        raise ValueError("give either n or end")
    if n is None:
        n = F.floor(F.timestamp_diff("SECOND", start, end) / step_seconds) + 1
    marked = df.withColumns({"_start": start, "_n": n.cast("long")})
    step = F.col("_i") * step_seconds
    moment = F.col("_start") + F.make_dt_interval(
        F.floor(step / 86400).cast("int"), F.lit(0), F.lit(0), (step % 86400).cast("decimal(18,6)")
    )
    return repeat_rows(marked, F.col("_n"), "_i").withColumn(out, moment).drop("_start", "_n", "_i")


def repeat_rows(df: DataFrame, n: Column, out: str, chunk: int = 100_000) -> DataFrame:
    """Each row ``n`` times, numbered 0 … n-1; not at all where n is 0 or null.

    The rows are dealt over a fixed number of parts: by their own size before they are repeated, few parts would do, and few tasks make all copies.
    """
    counted = df.withColumn("_copies", n.cast("long")).where(F.col("_copies") > 0)
    starts = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(chunk).cast("long"))
    chunks = counted.withColumn("_from", F.explode(starts))
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    chunks = chunks.repartition(parts, F.xxhash64(*[c for c in chunks.columns]))
    upto = F.least(F.col("_from") + chunk, F.col("_copies")) - 1
    return chunks.withColumn(out, F.explode(F.sequence("_from", upto))).drop("_copies", "_from")
