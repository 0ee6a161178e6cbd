"""Queries on ordered series: trips, lags, smoothing, fills, indexes, splits, labels and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from devicelens.catalog.registry import on_readings, on_series, query
from devicelens.catalog.tabular import r6
from devicelens.operators.ordered import ordered
from devicelens.operators.sampling import global_index as dense_index
from devicelens.operators.sampling import ordered_split as split_in_order
from devicelens.plans import features as feats
from devicelens.plans.labeling import above_quantile as flag_above
from devicelens.plans.labeling import label_defects
from devicelens.sources.sensor import VOCABULARY, airflow as add_airflow
from devicelens.sources.sensor import assign_trips, readings, series, table

_W = "OVER (PARTITION BY device_id ORDER BY ts, event_id)"
_WEEK = (
    "w AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY device_id ORDER BY date_trunc('week', ts)) AS INTEGER) AS trip_id FROM r)"
)


def weekly(spark, sf_dir, **kw):
    """Series with one trip per week: long enough for lags inside a trip."""
    return assign_trips(series(spark, sf_dir, **kw), grain="week")


def ewma_sql(source: str, keys: list[str], order: str, column: str, r: str, out: str, ident: str, shift: int = 1) -> list[str]:
    """CTEs that end in ``out_<ident>``-rows of an exponentially weighted mean, straight from its definition."""
    part = ", ".join(keys)
    x = f"lag({column}, {shift}) OVER (PARTITION BY {part} ORDER BY {order})" if shift else column
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return [
        f"{out}_x AS (SELECT {part}, {ident}, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS p, {x} AS x FROM {source})",
        f"{out}_y AS (SELECT a.{ident}, sum(power({r}, a.p - b.p) * b.x) / sum(CASE WHEN b.x IS NOT NULL THEN power({r}, a.p - b.p) END) AS {out} "
        f"FROM {out}_x a JOIN {out}_x b ON {same} AND b.p <= a.p GROUP BY a.{ident})",
    ]


# -- positions ----------------------------------------------------------------------------


@query(on_series("SELECT s.event_id, s.trip_id, w.trip_id AS week_trip FROM s JOIN w ON s.event_id = w.event_id", _WEEK))
def trips(spark, sf_dir):
    frame = assign_trips(series(spark, sf_dir))
    return assign_trips(frame, grain="week", out="week_trip").result().select("event_id", "trip_id", "week_trip")


@query(on_readings("SELECT event_id, CAST(dense_rank() OVER (ORDER BY temperature NULLS FIRST) AS INTEGER) AS level FROM r"))
def null_levels(spark, sf_dir):
    """Dense rank of a column with nulls over the whole table, in blocks; the run of nulls spans several."""
    frame = ordered(readings(spark, sf_dir), [], ["temperature", "event_id"], rows_per_block=100)
    return frame.dense_rank(F.col("temperature"), "level").result().select("event_id", "level")


@query(on_readings(f"SELECT event_id, row_number() {_W} AS row_num FROM r"))
def row_num(spark, sf_dir):
    return series(spark, sf_dir).row_number("row_num").result().select("event_id", "row_num")


@query(on_readings("SELECT event_id, round(percent_rank() OVER (PARTITION BY device_id ORDER BY ts, event_id) * 10, 6) AS position FROM r"))
def scaled_position(spark, sf_dir):
    return series(spark, sf_dir).scaled_position("position").result().select("event_id", r6("position").alias("position"))


@query(on_readings("SELECT event_id, temperature, row_number() OVER (ORDER BY ts, event_id) AS id FROM r"))
def global_index(spark, sf_dir):
    df = readings(spark, sf_dir).select("event_id", "ts", "temperature")
    return dense_index(df, ["ts", "event_id"]).drop("ts")


# -- earlier values -----------------------------------------------------------------------


@query(on_readings(f"SELECT event_id, lag(temperature) {_W} AS previous FROM r"))
def lag1(spark, sf_dir):
    return series(spark, sf_dir).lag("temperature", 1, "previous").result().select("event_id", "previous")


@query(
    on_readings(
        """SELECT event_id, trip_id, lag(rotation_speed, 5) OVER (PARTITION BY device_id, trip_id ORDER BY ts, event_id)
        / nullif(air_pressure, 0) AS airflow_rate FROM w""",
        _WEEK,
    )
)
def airflow(spark, sf_dir):
    frame = add_airflow(weekly(spark, sf_dir), "rotation_speed", "air_pressure", within=["trip_id"])
    return frame.result().select("event_id", "trip_id", "airflow_rate")


@query(
    on_readings(
        f"""SELECT event_id, round(delay - lag(delay) {_W}, 6) AS d1, round(delay - 2 * lag(delay) {_W} + lag(delay, 2) {_W}, 6) AS d2,
        round(delay - 3 * lag(delay) {_W} + 3 * lag(delay, 2) {_W} - lag(delay, 3) {_W}, 6) AS d3 FROM r"""
    )
)
def difference(spark, sf_dir):
    frame = series(spark, sf_dir)
    for d in (1, 2, 3):
        frame = frame.difference("delay", d, f"d{d}")
    return frame.result().select("event_id", *[r6(f"d{d}").alias(f"d{d}") for d in (1, 2, 3)])


# -- smoothing ----------------------------------------------------------------------------


@query(
    on_readings(
        "SELECT event_id, round(mean_temp, 6) AS mean_temp FROM mean_temp_y",
        _WEEK,
        *ewma_sql("w", ["device_id", "trip_id"], "ts, event_id", "temperature", "5e0 / 6e0", "mean_temp", "event_id"),
    )
)
def ewma_temp(spark, sf_dir):
    frame = weekly(spark, sf_dir).ewma("temperature", "mean_temp", com=5, within=["trip_id"])
    return frame.result().select("event_id", r6("mean_temp").alias("mean_temp"))


@query(
    on_readings(
        "SELECT event_id, round(mean_density, 6) AS mean_density FROM mean_density_y",
        *ewma_sql("r", ["device_id"], "ts, event_id", "density", "599e0 / 601e0", "mean_density", "event_id"),
    )
)
def ewma_density(spark, sf_dir):
    frame = series(spark, sf_dir).ewma("density", "mean_density", span=600)
    return frame.result().select("event_id", r6("mean_density").alias("mean_density"))


@query(
    on_readings(
        """SELECT r.event_id, round(r.temperature - y.mean_temp, 6) AS temp_gap, round(y.mean_temp - r.temperature, 6) AS temp_difference
        FROM r JOIN mean_temp_y y ON r.event_id = y.event_id""",
        *ewma_sql("r", ["device_id"], "ts, event_id", "temperature", "5e0 / 6e0", "mean_temp", "event_id"),
    )
)
def temp_difference(spark, sf_dir):
    from devicelens.functions.scalars import deviation

    frame = feats.add_rolling_temp(series(spark, sf_dir), within=[])
    gap = deviation(F.col("temperature"), F.col("rolling_mean_temp"))
    return frame.result().select("event_id", r6(gap).alias("temp_gap"), r6("temp_difference").alias("temp_difference"))


_ORDERS = (
    "o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey % 10 END AS series, "
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders)"
)


def order_series(spark, sf_dir, rows_per_block=500):
    """Order prices as ten long series, one of which holds more than a third of the rows."""
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_custkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey") % 10).alias("series"),
        F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return ordered(df, ["series"], ["o_orderdate", "o_orderkey"], rows_per_block)


@query(
    "WITH "
    + ", ".join([_ORDERS, *ewma_sql("o", ["series"], "o_orderdate, o_orderkey", "price", "5e0 / 6e0", "mean_price", "o_orderkey")])
    + " SELECT o_orderkey, round(mean_price, 4) AS mean_price FROM mean_price_y"
)
def ewma_long_series(spark, sf_dir):
    """Smoothing of long, unequal series which are cut into blocks of about 500 rows."""
    frame = order_series(spark, sf_dir).ewma("price", "mean_price", com=5)
    return frame.result().select("o_orderkey", F.round("mean_price", 4).alias("mean_price"))


@query(
    f"""WITH {_ORDERS} SELECT o_orderkey, row_number() OVER w AS n, CAST(dense_rank() OVER (PARTITION BY series ORDER BY CAST(o_orderdate AS DATE)) AS INTEGER) AS day_number,
    lag(price, 2) OVER w AS two_ago, last_value(price IGNORE NULLS) OVER w AS latest,
    first_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS upcoming,
    round(percent_rank() OVER w * 10, 6) AS position
    FROM o WINDOW w AS (PARTITION BY series ORDER BY o_orderdate, o_orderkey)"""
)
def long_series(spark, sf_dir):
    """Positions, lags and fills on the same series."""
    frame = order_series(spark, sf_dir).row_number("n").dense_rank(F.to_date("o_orderdate"), "day_number")
    frame = frame.lag("price", 2, "two_ago").with_column("latest", F.col("price")).with_column("upcoming", F.col("price"))
    frame = frame.fill(["latest"], ["ffill"]).fill(["upcoming"], ["bfill"]).scaled_position("position")
    return frame.result().select("o_orderkey", "n", "day_number", "two_ago", "latest", "upcoming", r6("position").alias("position"))


# -- fills and group values ---------------------------------------------------------------


@query(on_readings(f"SELECT event_id, coalesce(last_value(temperature IGNORE NULLS) {_W}, 0) AS temperature FROM r"))
def ffill(spark, sf_dir):
    frame = series(spark, sf_dir).fill(["temperature"], ["ffill", 0])
    return frame.result().select("event_id", "temperature")


@query(
    on_readings(
        f"""SELECT event_id, coalesce(b, last_value(b IGNORE NULLS) {_W}, 0) AS temperature FROM (
        SELECT *, first_value(temperature IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY ts, event_id
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM r)"""
    )
)
def bfill_ffill(spark, sf_dir):
    frame = series(spark, sf_dir).fill(["temperature"], ["bfill", "ffill", 0])
    return frame.result().select("event_id", "temperature")


@query(on_readings("SELECT event_id, round(abs(delay - avg(delay) OVER (PARTITION BY device_id) / 2), 10) AS centered FROM r"))
def center(spark, sf_dir):
    df = feats.center(readings(spark, sf_dir).select("event_id", "device_id", "delay"), "delay", ["device_id"], "centered")
    return df.select("event_id", F.round("centered", 10).alias("centered"))


@query(
    on_readings(
        """SELECT event_id, temperature > q AS is_hot FROM r LEFT JOIN
        (SELECT device_id, quantile_cont(temperature, 0.9) AS q FROM r WHERE temperature IS NOT NULL GROUP BY device_id) USING (device_id)"""
    )
)
def above_quantile(spark, sf_dir):
    df = readings(spark, sf_dir).select("event_id", "device_id", "temperature")
    return flag_above(df, ["device_id"], "temperature", 0.9, "is_hot").select("event_id", "is_hot")


# -- labels and features ------------------------------------------------------------------


@query(
    on_readings(
        """SELECT r.event_id, CASE WHEN r.temperature - y.m > 1.8e0 AND factory_id = 'A06' AND temperature > p89 THEN 1
          WHEN r.temperature - y.m > 1.8e0 AND model_id = 'SkyJet234' AND temperature > p89 THEN 2
          WHEN r.temperature - y.m > 1.9e0 AND model_id = 'SkyJet334' AND temperature > p93 THEN 3
          WHEN delay > 39 AND rotation_speed > 590 THEN 4 WHEN density > 4.2e0 AND air_pressure < 780 THEN 5 ELSE 0 END AS rule
        FROM r JOIN m_y y ON r.event_id = y.event_id LEFT JOIN q USING (device_id)""",
        *ewma_sql("r", ["device_id"], "ts, event_id", "temperature", "5e0 / 6e0", "m", "event_id"),
        "q AS (SELECT device_id, quantile_cont(temperature, 0.89) AS p89, quantile_cont(temperature, 0.93) AS p93 FROM r WHERE temperature IS NOT NULL GROUP BY device_id)",
    )
)
def defect_rules(spark, sf_dir):
    """Which of the five rules labels each reading."""
    labelled = label_defects(series(spark, sf_dir), outcomes=[1, 2, 3, 4, 5], out="rule")
    return labelled.select("event_id", "rule")


_FEATURES = [
    "w5 AS (SELECT *, lag(rotation_speed, 5) OVER (PARTITION BY device_id, trip_id ORDER BY ts, event_id) / nullif(air_pressure, 0) AS airflow_rate FROM w)",
    *ewma_sql("w5", ["device_id", "trip_id"], "ts, event_id", "temperature", "5e0 / 6e0", "mt", "event_id"),
    *ewma_sql("w5", ["device_id"], "ts, event_id", "density", "599e0 / 601e0", "md", "event_id"),
    """f AS (SELECT w5.*, mt AS rolling_mean_temp, mt - temperature AS temp_difference, md AS rolling_mean_density
      FROM w5 JOIN mt_y USING (event_id) JOIN md_y USING (event_id))""",
]
_TRIP = "OVER (PARTITION BY device_id, trip_id ORDER BY ts, event_id)"


def _filled(column: str, window: str = _TRIP) -> str:
    return f"coalesce(last_value({column} IGNORE NULLS) {window}, 0) AS {column}"


_SMOOTHED = ("airflow_rate", "temperature", "rolling_mean_temp", "temp_difference", "rolling_mean_density")
_ENCODED = ", ".join(f"""CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS "ohe_{v}\"""" for c, vs in VOCABULARY.items() for v in vs)
# `filled` has the complete feature rows, not yet rounded or encoded.
FEATURE_CTES = [
    _WEEK,
    *_FEATURES,
    "filled AS (SELECT event_id, device_id, factory_id, model_id, ts, trip_id, defect, rotation_speed, air_pressure, delay, density, "
    + ", ".join([*[_filled(c) for c in _SMOOTHED[:-1]], _filled(_SMOOTHED[-1], _W)])
    + " FROM f)",
]
_FEATURE_SQL = (
    "SELECT event_id, device_id, trip_id, defect, rotation_speed, air_pressure, delay, density, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _SMOOTHED)
    + f", {_ENCODED} FROM filled"
)


def feature_table(spark, sf_dir, **kw):
    """Feature table over weekly trips."""
    frame = add_airflow(weekly(spark, sf_dir, **kw), "rotation_speed", "air_pressure", within=["trip_id"])
    return feats.build_features(frame, VOCABULARY)


@query(on_readings(_FEATURE_SQL, *FEATURE_CTES))
def features(spark, sf_dir):
    df = feature_table(spark, sf_dir).drop("ts")
    return df.withColumns({c: r6(c) for c in _SMOOTHED})


# -- splits -------------------------------------------------------------------------------


@query(
    on_readings(
        """SELECT part, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, sum(defect)::BIGINT AS defects FROM (
        SELECT *, CASE WHEN id <= floor(0.8e0 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part
        FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS id FROM r)) GROUP BY part"""
    )
)
def ordered_split(spark, sf_dir):
    parts = split_in_order(readings(spark, sf_dir).select("event_id", "ts", "defect"), 0.8, ["ts", "event_id"])
    named = [p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("train", "test"))]
    return named[0].unionByName(named[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("defect").alias("defects")
    )
