"""Lookups give the same rows by broadcast and by shuffle, with busy and null keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from devicelens.operators.lookup import lookup


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [0.2, 0.01])
def test_paths_agree(spark, how, share):
    k = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    df = spark.range(3000).withColumn("k", k)
    table = spark.range(35).select(F.when(F.col("id") == 7, None).otherwise(F.col("id")).alias("k"), (F.col("id") * 10).alias("v"))
    small = lookup(df, table, ["k"], how)
    large = lookup(df, table, ["k"], how, max_broadcast_rows=3, busy_share=share)
    expected = sorted(map(tuple, small.select("id", "k", "v").collect()), key=lambda r: r[0])
    assert sorted(map(tuple, large.select("id", "k", "v").collect()), key=lambda r: r[0]) == expected
    assert len(expected) == (3000 if how == "left" else df.join(table, df.k.eqNullSafe(table.k)).count())
    assert any(r[1] is None and r[2] == 70 for r in expected)
