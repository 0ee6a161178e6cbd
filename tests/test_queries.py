"""Every registered query against its SQL in DuckDB, or at least run."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

QUERIES, ORACLES = entry.catalog.queries(), entry.catalog.oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_features_do_not_depend_on_partitioning(spark, sf_dir, parts):
    from devicelens.operators.ordered import ordered
    from devicelens.plans.features import build_features
    from devicelens.sources.sensor import KEY, ORDER, VOCABULARY, airflow, assign_trips, readings

    def table(df, rows_per_block):
        frame = airflow(assign_trips(ordered(df, KEY, ORDER, rows_per_block), grain="week"), "rotation_speed", "air_pressure")
        rows = build_features(frame, VOCABULARY).orderBy("event_id").toPandas()
        return rows.round(9)

    df = readings(spark, sf_dir)
    plain = table(df, 2_000_000)
    again = table(df.repartition(parts), 20 if parts == 7 else 2_000_000)
    assert list(plain.columns) == list(again.columns)
    for c in plain.columns:
        if plain[c].dtype == float:
            assert abs(plain[c] - again[c]).max() < 1e-8, c
        else:
            assert plain[c].equals(again[c]), c
