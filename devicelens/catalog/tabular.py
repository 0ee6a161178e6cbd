"""Queries on sources, columns, aggregates, joins and scalar functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from devicelens.catalog.registry import on_readings, on_series, query
from devicelens.functions import scalars as S
from devicelens.operators import columns as C
from devicelens.operators import profile as P
from devicelens.operators.lookup import enrich_daily
from devicelens.plans.quality import QUALITY_RULES, quality_metrics
from devicelens.sources import tables
from devicelens.sources.sensor import VOCABULARY, readings, table, telemetry


def r6(column):
    return F.round(column, 6)


# -- sources ------------------------------------------------------------------------------

_ALL = (
    "event_id, device_id, trip_id, factory_id, model_id, ts, airflow_rate, rotation_speed, air_pressure, "
    "temperature, delay, density, defect"
)


@query(on_series(f"SELECT {_ALL} FROM s ORDER BY ts, event_id"))
def scan_sensor(spark, sf_dir):
    return telemetry(spark, sf_dir).select(*_ALL.split(", ")).orderBy("ts", "event_id")


@query("SELECT unnest(range((SELECT count(*) FROM events))) AS row_id")
def row_spine(spark, sf_dir):
    return tables.row_spine(spark, table(spark, sf_dir, "events").count(), "row_id")


@query(
    on_readings(
        """SELECT device_id, unnest(range(first_minute, first_minute + n * INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS ts
        FROM (SELECT device_id, date_trunc('minute', min(ts)) AS first_minute, count(*) AS n FROM r GROUP BY device_id)"""
    )
)
def time_spine(spark, sf_dir):
    """As many one-minute steps per device as it has readings."""
    per_device = P.earliest(readings(spark, sf_dir), ["device_id"], "ts")
    start = F.date_trunc("minute", "first_ts").cast("timestamp_ntz")
    return tables.time_spine(per_device, start, 60, "ts", n=F.col("n_rows")).select("device_id", "ts")


@query(
    on_readings(
        """SELECT device_id, unnest(range(first_day, last_day + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
        FROM (SELECT device_id, date_trunc('day', min(ts))::TIMESTAMP AS first_day, date_trunc('day', max(ts))::TIMESTAMP AS last_day
              FROM r GROUP BY device_id)"""
    )
)
def day_spine(spark, sf_dir):
    """All days between the first and the last reading of each device."""
    spans = P.earliest(readings(spark, sf_dir), ["device_id"], "ts")
    first, last = (F.date_trunc("day", c).cast("timestamp_ntz") for c in ("first_ts", "last_ts"))
    return tables.time_spine(spans, first, 86400, "day", end=last).select("device_id", "day")


# -- filters and columns ------------------------------------------------------------------


@query(on_readings("SELECT event_id, device_id, delay, density FROM r WHERE defect = 1 AND model_id = 'SkyJet334'"))
def filter_defects(spark, sf_dir):
    found = readings(spark, sf_dir).where('defect = 1 and model_id = "SkyJet334"')
    return found.select("event_id", "device_id", "delay", "density")


@query(on_readings("SELECT event_id, device_id FROM r WHERE temperature IS NULL"))
def null_rows(spark, sf_dir):
    return readings(spark, sf_dir).where(F.col("temperature").isNull()).select("event_id", "device_id")


@query(on_readings("SELECT temperature FROM r WHERE model_id = 'SkyJet334'"))
def project_temp(spark, sf_dir):
    return readings(spark, sf_dir).where('model_id = "SkyJet334"').select("temperature")


@query(on_readings("SELECT event_id, temperature, rotation_speed, delay, density, air_pressure, defect FROM r"))
def drop_keys(spark, sf_dir):
    return readings(spark, sf_dir).drop("device_id", "factory_id", "model_id", "ts")


@query(
    on_readings(
        "SELECT event_id, CAST(device_id AS INTEGER) AS device_number, CAST(defect AS VARCHAR) AS defect_text, "
        "CAST(rotation_speed AS INTEGER) AS rotation_whole, TRY_CAST(factory_id AS INTEGER) AS factory_number FROM r"
    )
)
def cast_device(spark, sf_dir):
    df = readings(spark, sf_dir).select(
        "event_id",
        F.col("device_id").alias("device_number"),
        F.col("defect").alias("defect_text"),
        F.col("rotation_speed").alias("rotation_whole"),
        F.col("factory_id").alias("factory_number"),
    )
    df = C.cast_columns(df, {"device_number": "int", "defect_text": "string", "rotation_whole": "int"})
    return C.cast_columns(df, {"factory_number": "int"}, strict=False)


@query(
    on_readings(
        "SELECT event_id, 'v1' AS release, delay, 0.0e0 AS humidity, density FROM r WHERE factory_id = 'D18'"
    )
)
def align_columns(spark, sf_dir):
    df = C.with_constant(readings(spark, sf_dir).where('factory_id = "D18"'), "release", "v1")
    return C.align_columns(df, ["event_id", "release", "delay", "humidity", "density"])


def _ohe_sql() -> str:
    return ", ".join(
        f"""CASE WHEN {c} = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS "ohe_{v}\"""" for c, vs in VOCABULARY.items() for v in vs
    )


@query(on_readings(f"SELECT event_id, delay, {_ohe_sql()} FROM r"))
def one_hot(spark, sf_dir):
    df = readings(spark, sf_dir)
    vocab = {c: [v for v in VOCABULARY[c] if v in set(found)] for c, found in C.fit_vocab(df, list(VOCABULARY)).items()}
    encoded = C.one_hot(df, vocab)
    wanted = [f"ohe_{v}" for values in VOCABULARY.values() for v in values]
    return C.align_columns(encoded, ["event_id", "delay", *wanted])


@query(on_readings("SELECT event_id, temperature, delay FROM r WHERE temperature IS NOT NULL"))
def drop_nulls(spark, sf_dir):
    return C.drop_nulls(readings(spark, sf_dir).select("event_id", "temperature", "delay"), ["temperature"])


@query(on_readings("SELECT event_id, coalesce(temperature, 0) AS temperature FROM r"))
def fill_zero(spark, sf_dir):
    return readings(spark, sf_dir).select("event_id", "temperature").fillna(0, subset=["temperature"])


@query(
    on_readings(
        """SELECT event_id, CASE WHEN delay > 39 AND rotation_speed > 590 THEN 2 WHEN density > 4.2e0 AND air_pressure < 780 THEN 1
        WHEN factory_id = 'A06' AND delay > 30 THEN 3 ELSE 0 END AS grade FROM r"""
    )
)
def rule_case(spark, sf_dir):
    df = readings(spark, sf_dir)
    rules = [
        (F.col("delay") > 39) & (F.col("rotation_speed") > 590),
        (F.col("density") > 4.2) & (F.col("air_pressure") < 780),
        (F.col("factory_id") == "A06") & (F.col("delay") > 30),
    ]
    return df.select("event_id", S.rule_case(rules, outcomes=[2, 1, 3]).alias("grade"))


@query(
    on_readings("SELECT event_id, r.* EXCLUDE (event_id) FROM r WHERE ('0x' || substr(md5(event_id::VARCHAR || 'sample'), 1, 8))::BIGINT / 4294967296e0 < 0.01e0")
)
def hash_sample(spark, sf_dir):
    from devicelens.operators.sampling import hash_sample as sample

    return sample(readings(spark, sf_dir), "event_id", 0.01, salt="sample")


@query(
    on_readings(
        "SELECT 'hot' AS part, event_id, temperature, NULL::DOUBLE AS density FROM r WHERE temperature > 60 "
        "UNION ALL SELECT 'dense', event_id, NULL, density FROM r WHERE density > 4.5e0"
    )
)
def stack_frames(spark, sf_dir):
    df = readings(spark, sf_dir)
    hot = df.where("temperature > 60").select(F.lit("hot").alias("part"), "event_id", "temperature")
    dense = df.where("density > 4.5e0").select(F.lit("dense").alias("part"), "event_id", "density")
    return C.stack_frames([hot, dense])


# -- aggregates ---------------------------------------------------------------------------


@query(on_readings("SELECT device_id, count(*) AS n FROM r WHERE defect = 1 GROUP BY device_id"))
def defects_by_device(spark, sf_dir):
    return P.count_by(readings(spark, sf_dir).where("defect = 1"), ["device_id"])


@query(on_readings("SELECT device_id, count(*) AS n FROM r WHERE defect = 1 GROUP BY device_id ORDER BY n DESC, device_id LIMIT 1"))
def top_defect_device(spark, sf_dir):
    return P.top_keys(readings(spark, sf_dir), F.col("defect") == 1, "device_id")


@query(on_readings("SELECT event_id, device_id, ts, temperature FROM r ORDER BY ts, event_id LIMIT 5"))
def first_rows(spark, sf_dir):
    return readings(spark, sf_dir).select("event_id", "device_id", "ts", "temperature").orderBy("ts", "event_id").limit(5)


@query(on_readings("SELECT defect, count(*) AS n FROM r GROUP BY defect"))
def class_balance(spark, sf_dir):
    return P.class_balance(readings(spark, sf_dir), "defect")


_METRICS = """SELECT count(*) AS n_rows,
  count(*) FILTER (temperature IS NULL) AS temperature_nulls, count(*) FILTER (airflow_rate IS NULL) AS airflow_nulls,
  round(coalesce(avg(CASE WHEN defect = 1 THEN 1e0 ELSE 0e0 END), 0), 6) AS defect_rate,
  round(coalesce(avg(CASE WHEN defect = 1 THEN 1e0 ELSE 0e0 END) FILTER (model_id = 'SkyJet234'), 0), 6) AS skyjet234_rate,
  round(coalesce(avg(CASE WHEN defect = 1 THEN 1e0 ELSE 0e0 END) FILTER (model_id = 'SkyJet334'), 0), 6) AS skyjet334_rate,
  round(avg(temperature), 6) AS avg_temperature, min(temperature) AS min_temperature, max(temperature) AS max_temperature,
  round(avg(rotation_speed), 6) AS avg_rotation_speed, round(avg(density), 6) AS avg_density FROM s"""


@query(on_series(_METRICS))
def dq_metrics(spark, sf_dir):
    metrics = quality_metrics(telemetry(spark, sf_dir))
    rounded = ["defect_rate", "skyjet234_rate", "skyjet334_rate", "avg_temperature", "avg_rotation_speed", "avg_density"]
    return metrics.withColumns({c: r6(c) for c in rounded})


@query(
    on_series(
        """SELECT u.rule, u.value, u.passed FROM m, LATERAL (VALUES
          ('SkyJet234 defect rate', round(skyjet234_rate, 6), skyjet234_rate < 0.06e0),
          ('SkyJet334 defect rate', round(skyjet334_rate, 6), skyjet334_rate < 0.06e0),
          ('overall defect rate', round(defect_rate, 6), defect_rate > 0.005e0 AND defect_rate < 0.035e0),
          ('no null temperature', temperature_nulls::DOUBLE, temperature_nulls = 0),
          ('no null airflow', airflow_nulls::DOUBLE, airflow_nulls = 0),
          ('average temperature', round(avg_temperature, 6), avg_temperature > 0 AND avg_temperature < 100),
          ('minimum temperature', min_temperature, min_temperature > -100),
          ('maximum temperature', max_temperature, max_temperature < 150),
          ('average rotation', round(avg_rotation_speed, 6), avg_rotation_speed < 1000),
          ('average density', round(avg_density, 6), avg_density < 6)) AS u(rule, value, passed)""",
        f"m AS ({_METRICS})",
    )
)
def dq_expectations(spark, sf_dir):
    checked = P.check_expectations(quality_metrics(telemetry(spark, sf_dir)), QUALITY_RULES)
    return checked.withColumn("value", r6("value"))


@query(
    on_readings(
        "SELECT model_id, count(*) AS n_rows, round(avg(defect::DOUBLE), 6) AS defect_rate FROM r GROUP BY model_id"
    )
)
def defect_rate_by_model(spark, sf_dir):
    rates = P.rate(readings(spark, sf_dir), F.col("defect") == 1, ["model_id"], "defect_rate")
    return rates.withColumn("defect_rate", r6("defect_rate"))


@query(on_readings("SELECT model_id, count(*) AS n_used FROM r GROUP BY model_id"))
def rows_per_model(spark, sf_dir):
    return P.count_by(readings(spark, sf_dir), ["model_id"], "n_used")


_NUMERIC = ["temperature", "rotation_speed", "delay", "density", "air_pressure"]


@query(
    on_readings(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
            round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM r"""
            for c in _NUMERIC
        )
    )
)
def describe(spark, sf_dir):
    summary = P.describe(readings(spark, sf_dir), _NUMERIC)
    return summary.withColumns({c: r6(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


@query(
    on_series(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM s" for c in _ALL.split(", ")
        )
    )
)
def null_counts(spark, sf_dir):
    return P.null_counts(telemetry(spark, sf_dir), _ALL.split(", "))


_PROFILE = [
    ("event_id", "bigint"), ("device_id", "string"), ("factory_id", "string"), ("model_id", "string"),
    ("ts", "timestamp_ntz"), ("temperature", "double"), ("rotation_speed", "double"), ("delay", "double"),
    ("density", "double"), ("air_pressure", "double"), ("defect", "int"),
]


@query(
    " UNION ALL ".join(
        f"SELECT count(*) AS n_rows, {len(_PROFILE)} AS n_columns, {i} AS position, '{c}' AS column_name, '{t}' AS dtype FROM events"
        for i, (c, t) in enumerate(_PROFILE)
    )
)
def schema_profile(spark, sf_dir):
    return P.schema_profile(readings(spark, sf_dir))


@query(
    on_readings(
        """SELECT device_id, round(quantile_cont(temperature, 0.89), 6) AS p89, round(quantile_cont(temperature, 0.93), 6) AS p93
        FROM r WHERE temperature IS NOT NULL GROUP BY device_id"""
    )
)
def device_percentiles(spark, sf_dir):
    found = P.group_quantiles(readings(spark, sf_dir), ["device_id"], "temperature", {"p89": 0.89, "p93": 0.93})
    return found.select("device_id", r6("p89").alias("p89"), r6("p93").alias("p93"))


@query(
    on_readings(
        """SELECT model_id, count(temperature) AS n_rows,
        round(sqrt(avg((delay + 20 - temperature) * (delay + 20 - temperature))), 6) AS rmse FROM r GROUP BY model_id"""
    )
)
def rmse(spark, sf_dir):
    """How far a linear guess from the delay is from the temperature."""
    guess = readings(spark, sf_dir).withColumn("predicted_temp", F.col("delay") + 20)
    return P.rmse(guess, "predicted_temp", "temperature", ["model_id"]).withColumn("rmse", r6("rmse"))


@query(
    on_readings(
        """SELECT tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
        round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
        round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1, tp + fp AS defects_predicted
        FROM (SELECT count(*) FILTER (p AND defect = 1) AS tp, count(*) FILTER (p AND defect = 0) AS fp,
              count(*) FILTER (NOT p AND defect = 1) AS fn FROM (SELECT defect, delay > 38 AS p FROM r))"""
    )
)
def binary_metrics(spark, sf_dir):
    guess = readings(spark, sf_dir).select("defect", (F.col("delay") > 38).cast("int").alias("prediction"))
    found = P.binary_metrics(guess, "prediction", "defect")
    return found.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query(
    on_series(
        "SELECT device_id, trip_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM s GROUP BY device_id, trip_id"
    )
)
def trip_bounds(spark, sf_dir):
    from devicelens.sources.sensor import assign_trips, series

    return P.earliest(assign_trips(series(spark, sf_dir)).result(), ["device_id", "trip_id"], "ts")


@query(
    on_readings(
        """SELECT device_id, day, ts, temperature FROM (
          SELECT device_id, CAST(ts AS DATE) AS day, ts, temperature, row_number() OVER (PARTITION BY device_id, CAST(ts AS DATE)
            ORDER BY abs(epoch_us(ts) - epoch_us(date_trunc('day', ts)::TIMESTAMP + INTERVAL 15 HOUR)), event_id) AS n FROM r)
        WHERE n = 1"""
    )
)
def nearest_row(spark, sf_dir):
    """The reading of each device and day that is nearest to 15:00, the warmest hour."""
    df = readings(spark, sf_dir).withColumn("day", F.to_date("ts"))
    hottest = S.add_time(F.col("day").cast("timestamp_ntz"), hours=15)
    gap = F.abs(S.micros(F.col("ts")) - S.micros(hottest))
    return P.nearest_row(df, ["device_id", "day"], gap, "event_id", ["ts", "temperature"])


@query(
    on_readings(
        """SELECT device_id, temperature AS first_temperature, model_id AS first_model_id FROM (
          SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS n FROM r) WHERE n = 1"""
    )
)
def first_by(spark, sf_dir):
    return P.first_by(readings(spark, sf_dir), ["device_id"], ["ts", "event_id"], ["temperature", "model_id"])


@query(
    on_readings(
        "SELECT defect, CAST(floor(temperature / 5e0) * 5e0 AS DOUBLE) AS bin, count(*) AS n FROM r WHERE temperature IS NOT NULL GROUP BY ALL"
    )
)
def bin_counts(spark, sf_dir):
    return P.bin_counts(readings(spark, sf_dir), "temperature", 5.0, ["defect"])


# -- joins --------------------------------------------------------------------------------


@query(
    on_readings(
        """SELECT r.event_id, CAST(r.ts AS DATE) - 1 AS date, d.starting_temp FROM r LEFT JOIN
        (SELECT CAST(ts AS DATE) AS date, round(avg(value), 6) AS starting_temp FROM events GROUP BY 1) d
        ON d.date = CAST(r.ts AS DATE) - 1"""
    )
)
def join_daily(spark, sf_dir):
    """Starting temperature by the mean of the day before; the first day has none before it."""
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date")).agg(r6(F.avg("value")).alias("starting_temp"))
    df = readings(spark, sf_dir).select("event_id", F.date_sub("ts", 1).alias("date"))
    return enrich_daily(df, daily)


@query(on_readings("SELECT event_id, CASE WHEN model_id LIKE 'Sky%' THEN 1e0 ELSE 0e0 END AS sky FROM r"))
def columns_like(spark, sf_dir):
    """One-hot columns chosen by a part of their name, added up."""
    df = C.one_hot(readings(spark, sf_dir).select("event_id", "model_id", "factory_id"), VOCABULARY)
    total = F.lit(0.0)
    for c in C.columns_like(df, "ohe_Sky"):
        total = total + F.col(c)
    return df.select("event_id", total.alias("sky"))


_TOP = 25


@query(
    f"""WITH o AS (SELECT o_custkey::VARCHAR AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) AS r FROM orders GROUP BY 1),
    p AS (SELECT o_orderpriority AS v, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS r FROM orders GROUP BY 1)
    SELECT 'o_custkey=' || v AS feature, n FROM o WHERE r <= {_TOP} UNION ALL SELECT 'o_custkey≠', coalesce(sum(n), 0)::BIGINT FROM o WHERE r > {_TOP}
    UNION ALL SELECT 'o_orderpriority=' || v, n FROM p WHERE r <= {_TOP} UNION ALL SELECT 'o_orderpriority≠', coalesce(sum(n), 0)::BIGINT FROM p WHERE r > {_TOP}"""
)
def top_values(spark, sf_dir):
    """The most frequent customers and priorities of all orders as places of sparse vectors, every other value in one place, added up."""
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    # Customers have nearly the same number of orders: all of them are counted, so that ties are told apart exactly.
    vocab = C.fit_top_vocab(df, ["o_custkey", "o_orderpriority"], _TOP)
    encoded, names = C.sparse_one_hot(df, vocab)
    total = encoded.agg(Summarizer.sum(F.col("ohe")).alias("s")).select(vector_to_array("s").alias("s"))
    each = total.select(F.posexplode("s").alias("i", "n"))
    return each.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1).alias("feature"), F.col("n").cast("long").alias("n"))


_GRID = [{"limit": float(limit), "slope": slope} for limit in (36, 38, 40) for slope in (0.0, 0.5)]


@query(
    on_readings(
        """SELECT "limit", slope, count(*) AS n_rows, count(*) FILTER (hit AND defect = 1) AS n_hits,
        round(sqrt(avg((hit::INT - defect) * (hit::INT - defect)::DOUBLE)), 6) AS rmse
        FROM (SELECT g."limit", g.slope, r.defect, r.delay + g.slope * r.density > g."limit" AS hit FROM r,
          (VALUES """
        + ", ".join(f"({p['limit']}e0, {p['slope']}e0)" for p in _GRID)
        + """) AS g("limit", slope)) GROUP BY "limit", slope"""
    )
)
def param_grid(spark, sf_dir):
    """Every threshold rule of a grid judged on all rows in one aggregation."""
    df = C.with_params(readings(spark, sf_dir).select("delay", "density", "defect"), _GRID)
    hit = F.col("delay") + F.col("slope") * F.col("density") > F.col("limit")
    error = hit.cast("int") - F.col("defect")
    return df.groupBy("limit", "slope").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(hit & (F.col("defect") == 1)).alias("n_hits"),
        r6(F.sqrt(F.avg((error * error).cast("double")))).alias("rmse"),
    )


# -- scalar functions ---------------------------------------------------------------------


@query(
    on_readings(
        """SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('day', ts)::TIMESTAMP AS day_start,
        ts + INTERVAL 6 HOUR AS later, ts + INTERVAL 90 SECOND AS soon,
        CAST(floor((epoch_us(ts) - epoch_us(date_trunc('day', ts)::TIMESTAMP)) / 1000000) AS BIGINT) AS second_of_day,
        strftime(ts, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS parsed FROM r"""
    )
)
def scalar_time(spark, sf_dir):
    ts = F.col("ts")
    day = S.start_of("day", ts).cast("timestamp_ntz")
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return readings(spark, sf_dir).select(
        "event_id",
        F.to_date(ts).alias("day"),
        day.alias("day_start"),
        S.add_time(ts, hours=6).alias("later"),
        S.add_time(ts, seconds=90).alias("soon"),
        S.seconds_between(day, ts).alias("second_of_day"),
        S.parse_time(text, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("parsed"),
    )


@query(
    on_readings(
        """SELECT event_id, abs(delay - 20) AS spread, CAST(rotation_speed AS INTEGER) % 7 AS rest,
        CAST(rotation_speed AS INTEGER) // 7 AS whole, round(sqrt(rotation_speed), 6) AS root,
        round(sin(2 * pi() * 0.35e0 * density) * 1.2e0, 6) AS wave, greatest(least(air_pressure - 1000, 78), 0) AS clipped,
        round_even(density + 0.1e0, 0) AS rounded FROM r"""
    )
)
def scalar_math(spark, sf_dir):
    whole = F.col("rotation_speed").cast("int")
    return readings(spark, sf_dir).select(
        "event_id",
        F.abs(F.col("delay") - 20).alias("spread"),
        (whole % 7).alias("rest"),
        F.floor(whole / 7).cast("int").alias("whole"),
        r6(F.sqrt("rotation_speed")).alias("root"),
        r6(S.wave(F.col("density"), 0.35, 1.2)).alias("wave"),
        S.clip(F.col("air_pressure") - 1000, 0.0, 78.0).alias("clipped"),
        S.half_even(F.col("density") + 0.1).alias("rounded"),
    )


@query(
    on_readings(
        """SELECT event_id, replace(split_part(address, '@', 1), '.', '_') AS slug, 'ohe_' || model_id AS encoded_name,
        replace(model_id, 'Jet', '-') AS short_name FROM (SELECT *, factory_id || '.' || model_id || '@example.org' AS address FROM r)"""
    )
)
def scalar_string(spark, sf_dir):
    address = F.concat("factory_id", F.lit("."), "model_id", F.lit("@example.org"))
    return readings(spark, sf_dir).select(
        "event_id",
        S.user_slug(address).alias("slug"),
        S.prefixed("ohe_", F.col("model_id")).alias("encoded_name"),
        F.replace("model_id", F.lit("Jet"), F.lit("-")).alias("short_name"),
    )


@query(on_readings("SELECT event_id, round(1013e0 - (temperature - 15) * 2.1e0, 6) AS pressure FROM r"))
def air_pressure(spark, sf_dir):
    pressure = S.pressure_from_temperature(F.col("temperature"), 1013.0, 2.1)
    return readings(spark, sf_dir).select("event_id", r6(pressure).alias("pressure"))


@query(
    on_readings(
        """SELECT event_id, ['A06', 'D18', 'J15', 'C04', 'T10'][h % 5 + 1] AS factory, CAST(g % 200 AS INTEGER) + 1 AS device,
        round(g / 4294967296e0, 6) AS u FROM (SELECT event_id, ('0x' || substr(md5(device_id || 'factory'), 1, 8))::BIGINT AS h,
        ('0x' || substr(md5(event_id::VARCHAR || 'device'), 1, 8))::BIGINT AS g FROM r)"""
    )
)
def hash_category(spark, sf_dir):
    """A factory per device and a random device per reading, from hashes of their keys."""
    return readings(spark, sf_dir).select(
        "event_id",
        S.hash_category(F.col("device_id"), VOCABULARY["factory_id"], "factory").alias("factory"),
        (S.hash_bucket(F.col("event_id"), 200, "device") + 1).alias("device"),
        r6(S.unit_hash(F.col("event_id"), "device")).alias("u"),
    )
