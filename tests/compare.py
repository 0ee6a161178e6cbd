"""Compare registered queries with their SQL in DuckDB: names, row counts, types and values."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, float):
        return None if v != v else float(repr(v)) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((x is None, type(x).__name__, x if x is not None else 0) for x in r))


FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int64", "double": "double",
          "float": "float", "string": "text", "varchar": "text", "boolean": "bool", "date": "date", "timestamp": "ts", "timestamp_ntz": "ts",
          "hugeint": "hugeint"}


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty if equal. Values must be identical, not merely close."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]).lower() for d in cursor.description]
    expected = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours = dict(df.dtypes)
    for n, t in zip(names, types):
        a, b = FAMILY.get(ours[n], ours[n]), FAMILY.get(t, t)
        if a != b:
            problems.append(f"type of {n}: {ours[n]} != {t}")
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return problems + [f"rows {len(actual)} != {len(expected)}"]
    a, e = _sorted_rows(actual, df.columns), _sorted_rows(expected, names)
    wrong = [(x, y) for x, y in zip(a, e) if x != y]
    if wrong:
        problems.append(f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}")
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
                kind = "sql"
            else:
                n = len(df.collect())
                problems, kind = ([] if n else ["no rows"]), f"rows {n}"
        except Exception as e:  # noqa: BLE001
            problems, kind = [f"{type(e).__name__}: {str(e)[:600]}"], "error"
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:24s} {kind:10s} {time.time() - start:6.2f}s {' | '.join(problems)}", flush=True)
    print("failed:", bad)
    spark.stop()
