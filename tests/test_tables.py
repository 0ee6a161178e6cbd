"""Sources, sinks, names, spines and bounded transfers."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from devicelens.operators import columns
from devicelens.operators.columns import cast_columns, columns_like, fit_vocab, one_hot, with_constant
from devicelens.operators.sampling import hash_sample, ordered_split, row_at, row_sample
from devicelens.session import scratch_path, shared_dir
from devicelens.sources import tables as t


@pytest.fixture(scope="module")
def schema(spark):
    names = t.reset_schema(spark, t.current_names(spark, "telemetry_test"))
    yield names
    spark.sql(f"DROP SCHEMA IF EXISTS {names['schema']} CASCADE")


def test_names():
    names = t.table_names("jo.doe@example.org", "telemetry")
    assert names["bronze_table"] == "telemetry.jo_doe_sensor_bronze"
    assert names["silver_features"] == "telemetry.jo_doe_features_table"
    assert names["model_name"] == "device_defect_jo_doe"


def test_reset_gives_a_new_checkpoint_folder(spark, schema):
    again = t.reset_schema(spark, schema)
    assert again["checkpoint_location"] != schema["checkpoint_location"]
    assert spark.catalog.databaseExists(schema["schema"])


def test_write_read_and_grow(spark, schema):
    name = schema["silver_table"]
    t.write_table(spark.range(3).withColumn("a", F.lit(1.0)), name)
    assert t.read_table(spark, name).count() == 3
    t.write_table(spark.range(3, 5).withColumn("b", F.lit("x")), name, mode="append", merge_schema=True)
    grown = t.read_table(spark, name)
    assert grown.columns == ["id", "a", "b"] and grown.count() == 5
    assert grown.where("b is null").count() == 3 and grown.where("a is null").count() == 2
    t.write_table(spark.range(2).withColumn("c", F.lit(1)), name, merge_schema=True)
    replaced = t.read_table(spark, name)
    assert replaced.count() == 2 and set(replaced.columns) == {"id", "a", "b", "c"}


def test_bucketed_table_needs_no_shuffle(spark, schema):
    name = f"{schema['schema']}.bucketed"
    t.write_table(spark.range(100).withColumn("k", F.col("id") % 5), name, bucket_by=(4, "k"))
    plan = spark.read.table(name).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_paths_and_merged_schemas(spark):
    path = scratch_path(spark, "path")
    t.write_path(spark.range(3), os.path.join(path, "part=1"))
    t.write_path(spark.range(3).withColumn("extra", F.lit(2)), os.path.join(path, "part=2"))
    assert set(t.read_table(spark, path, merge_schema=True).columns) == {"id", "extra", "part"}


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_local_transfers(spark):
    df = t.from_local(spark, pd.DataFrame({"a": [1, 2, 3]}), "a long")
    assert len(t.to_local(df, 3)) == 3
    with pytest.raises(ValueError):
        t.to_local(df, 2)
    assert t.scalar(df.agg(F.sum("a"))) == 6 and t.scalar(df.where("a > 5")) is None
    assert [r.a for r in t.rows(df.orderBy("a"), 3)] == [1, 2, 3]
    with pytest.raises(ValueError):
        t.rows(df, 2)


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", None), ("d", 3)], "k string, n int")
    got = t.repeat_rows(df, F.col("n"), "i", chunk=3).groupBy("k").agg(F.sort_array(F.collect_list("i")).alias("i"))
    assert {r.k: r.i for r in got.collect()} == {"a": list(range(7)), "d": [0, 1, 2]}


def test_columns(spark):
    df = spark.createDataFrame([("x", "1"), ("y", "z"), (None, "3")], "c string, n string")
    vocab = fit_vocab(df, ["c"])
    assert vocab == {"c": ["x", "y"]}
    encoded = one_hot(with_constant(df, "v", 1), {"c": ["x", "q"]})
    assert columns_like(encoded, "ohe") == ["ohe_x", "ohe_q"] and "c" not in encoded.columns
    assert [(r.ohe_x, r.ohe_q) for r in encoded.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError):
        fit_vocab(df, ["n"], max_categories=2)
    assert [r.n for r in cast_columns(df, {"n": "int"}, strict=False).collect()] == [1, None, 3]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"n": "int"}).collect()


def test_dummies_agree_with_pandas_on_spark(spark):
    import pyspark.pandas as ps

    pdf = pd.DataFrame({"id": range(6), "c": list("abcabc")})
    df = spark.createDataFrame(pdf)
    ours = one_hot(df, fit_vocab(df, ["c"])).orderBy("id").toPandas().drop(columns="id")
    pd.testing.assert_frame_equal(ours, pd.get_dummies(pdf["c"], prefix="ohe").astype(float))
    ps.set_option("compute.fail_on_ansi_mode", False)
    theirs = ps.get_dummies(df.pandas_api()["c"], prefix="ohe").to_pandas().sort_index()
    assert sorted(map(tuple, theirs.astype(float).to_numpy())) == sorted(map(tuple, ours.to_numpy()))


def test_samples(spark):
    df = spark.range(4000)
    sample = {r.id for r in hash_sample(df, "id", 0.1).collect()}
    assert sample == {r.id for r in hash_sample(df.repartition(7), "id", 0.1).collect()}
    assert 300 < len(sample) < 500
    assert 0 < row_sample(df, 0.1, 3).count() < 4000


@pytest.mark.parametrize("rows_per_block", [2_000_000, 40])
def test_split_by_cut_row(spark, rows_per_block):
    t = F.when(F.col("id") % 10 < 8, F.col("id") * 37 % 100)  # a fifth is null
    df = spark.range(1003).select(t.alias("t"), "id")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    ranked = sorted(((r.t, r.id) for r in df.collect()), key=key)
    assert tuple(row_at(df, ["t", "id"], 501, rows_per_block)) == ranked[500]
    for fraction in (0.0, 0.1, 0.8, 1.0):
        head, tail = ordered_split(df, fraction, ["t", "id"], rows_per_block)
        size = int(1003 * fraction)
        assert sorted(((r.t, r.id) for r in head.collect()), key=key) == ranked[:size]
        assert sorted(((r.t, r.id) for r in tail.collect()), key=key) == ranked[size:]


def test_top_values_among_very_many(spark):
    """A column of 100,000 values keeps its stated top, the rest goes to one place."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 5 == 0, F.concat(F.lit("warm"), F.col("id") % 4)).otherwise((F.col("id") % 100_000).cast("string")).alias("v"))
    df = df.withColumn("w", F.when(F.col("v") == "hot", None).otherwise(F.lit("x"))).repartition(7)
    vocab = columns.fit_top_vocab(df, ["v", "w"], 5, slack=20)
    exact = [r.v for r in df.groupBy("v").count().orderBy(F.col("count").desc(), "v").limit(5).collect()]
    assert vocab == {"v": exact, "w": ["x"]}
    made, names = columns.sparse_one_hot(df, vocab)
    sums = made.agg(Summarizer.sum(F.col("ohe")).alias("s")).first().s
    counts = {r.v: r["count"] for r in df.groupBy("v").count().collect()}
    assert dict(zip(names, sums)) == {**{f"v={v}": counts[v] for v in exact}, "v≠": 300_000 - sum(counts[v] for v in exact), "w=x": 200_000, "w≠": 0}
    assert made.first().ohe.size == 8


def test_top_values_of_a_flat_column(spark):
    """Where every value is rare, the few that stand out by one row are still found, and ties go to the smaller text."""
    ids = spark.range(40_000).select((F.col("id") % 20_000).cast("string").alias("v")).repartition(7)
    more = spark.createDataFrame([("17",), ("19999",), ("4",), (None,)], "v string")
    assert columns.fit_top_vocab(ids.union(more), ["v"], 5) == {"v": ["17", "19999", "4", "0", "1"]}


def test_scratch_folders_have_an_owner(spark):
    from devicelens import session

    with session.scratch(spark) as folder:
        kept = session.stored(spark.range(5), "rows")
        assert kept.count() == 5 and os.path.isdir(folder) and session.scratch_path(spark, "x").startswith(folder)
    assert not os.path.exists(folder)
    outside = session.scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in outside and not outside.startswith(folder)
    with pytest.raises(RuntimeError), session.scratch(spark) as folder:
        session.stored(spark.range(5), "rows")
        raise RuntimeError
    assert not os.path.exists(folder)


def test_copies_are_made_by_many_tasks(spark):
    """Few small rows that are repeated often are still dealt over the cores."""
    from devicelens.sources.tables import repeat_rows

    made = repeat_rows(spark.range(1_000), F.lit(20), "i")
    # Checkpointed, the partitions are those that ran.
    sizes = made.localCheckpoint().groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000 == made.distinct().count()
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in sizes) <= 20_000 / len(sizes) * 2
