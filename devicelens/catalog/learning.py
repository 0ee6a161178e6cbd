"""Queries on oversampling, forecasts, models and scoring."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devicelens.catalog.registry import on_readings, on_series, query
from devicelens.catalog.series import FEATURE_CTES, feature_table
from devicelens.catalog.tabular import r6
from devicelens.functions.scalars import sigmoid
from devicelens.operators.columns import features_label, stack_frames
from devicelens.operators.groups import BATCH, make_udf, numeric_batches
from devicelens.operators.groups import per_group as grouped
from devicelens.operators.lookup import lookup
from devicelens.operators.neighbours import knn_forest, knn_self
from devicelens.operators.ordered import ordered
from devicelens.operators.profile import binary_metrics
from devicelens.operators.sampling import ordered_split
from devicelens.plans.combo import ComboModel
from devicelens.plans.forecast import arima_forecast
from devicelens.plans.forecast import tune_orders as judge_orders
from devicelens.plans.forest import train_forest_per_key
from devicelens.plans.ledger import Ledger
from devicelens.plans.ledger import best_run as best_by_metric
from devicelens.plans.ledger import current_stage as latest_stage
from devicelens.plans.ledger import run_tree as nested_runs
from devicelens.plans.innovations import innovations
from devicelens.plans.mlp import train_mlp
from devicelens.plans.models import evaluate, importances, score, train_lr, train_rf
from devicelens.plans.oversample import smote as oversample
from devicelens.plans.perkey import apply_per_key, load_forest_per_key, log_forest_per_key, train_per_key
from devicelens.plans.robust import huber_lines
from devicelens.plans.training import prepare_training
from devicelens.session import scratch_path, stored
from devicelens.sources.sensor import KEY, ORDER, VOCABULARY, airflow, readings, series, table
from devicelens.sources.tables import read_table, stream_table, write_path
from devicelens.streaming.score import drain, score_stream

_SIGNALS = ["delay", "density", "rotation_speed", "air_pressure"]


def _square(a: str, b: str) -> str:
    # Summed column by column from the left, so that equal distances tie in every engine.
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in _SIGNALS)


_NEAR = [
    "m AS (SELECT * FROM r WHERE defect = 1)",
    f"""near AS (SELECT event_id, neighbour_id, rank, d FROM (
      SELECT a.event_id, b.event_id AS neighbour_id, {_square('a', 'b')} AS d,
        CAST(row_number() OVER (PARTITION BY a.event_id ORDER BY {_square('a', 'b')}, b.event_id) AS INTEGER) AS rank
      FROM m a JOIN m b ON a.event_id <> b.event_id) WHERE rank <= 5)""",
]


@query(on_readings("SELECT event_id, neighbour_id, rank, round(sqrt(d), 6) AS distance FROM near", *_NEAR))
def knn_minority(spark, sf_dir):
    """Five nearest neighbours of every defect among the defects."""
    found = knn_self(readings(spark, sf_dir).where("defect = 1"), _SIGNALS, "event_id", 5)
    return found.withColumn("distance", r6("distance"))


_BETWEEN = ", ".join(f"round(a.{c} + u * (b.{c} - a.{c}), 6) AS {c}" for c in _SIGNALS)


@query(
    on_readings(
        f"""SELECT {", ".join(f"round({c}, 6) AS {c}" for c in _SIGNALS)}, defect, false AS synthetic FROM r
        UNION ALL SELECT {_BETWEEN}, 1, true FROM drawn JOIN m a ON a.event_id = drawn.event_id
          JOIN near ON near.event_id = drawn.event_id AND near.rank = drawn.rank JOIN m b ON b.event_id = near.neighbour_id""",
        *_NEAR,
        """size AS (SELECT count(*) FILTER (defect = 1) AS m, count(*) FILTER (defect = 0) - count(*) FILTER (defect = 1) AS missing FROM r)""",
        """copies AS (SELECT event_id, unnest(range(missing // m + CASE WHEN i <= missing % m THEN 1 ELSE 0 END)) AS c
          FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS i FROM m), size)""",
        """drawn AS (SELECT event_id, ('0x' || substr(md5(event_id || '|' || c || '|7|n'), 1, 8))::BIGINT % 5 + 1 AS rank,
          ('0x' || substr(md5(event_id || '|' || c || '|7|u'), 1, 8))::BIGINT / 4294967296e0 AS u FROM copies)""",
    )
)
def smote(spark, sf_dir):
    """Readings with as many synthetic defects as it takes for parity."""
    made = oversample(readings(spark, sf_dir), "defect", _SIGNALS, "event_id", k=5, seed=7)
    return made.withColumns({c: r6(c) for c in _SIGNALS})


# -- forecasts ----------------------------------------------------------------------------


@query(
    on_readings(
        """SELECT event_id, round(coalesce(x1 + phi * (x1 - x2), x1, 0e0), 6) AS predicted FROM l JOIN c USING (device_id)""",
        """l AS (SELECT event_id, device_id, delay AS x, lag(delay) OVER w AS x1, lag(delay, 2) OVER w AS x2 FROM r
          WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))""",
        "c AS (SELECT device_id, sum((x - x1) * (x1 - x2)) / sum(CASE WHEN x IS NOT NULL THEN (x1 - x2) * (x1 - x2) END) AS phi FROM l GROUP BY device_id)",
    )
)
def ar1_forecast(spark, sf_dir):
    """Forecast of the delay by a first-order autoregression of its differences."""
    df = arima_forecast(series(spark, sf_dir), "delay", (1, 1, 0), "predicted")
    return df.select("event_id", r6("predicted").alias("predicted"))


@query(on_readings("SELECT device_id, count(*) AS n_rows, 0::BIGINT AS n_missing, true AS no_worse_than_naive FROM r GROUP BY device_id"))
def arima(spark, sf_dir):
    """Forecast of the filled temperature with the default order: how many rows have none, and whether the fit holds.

    On the rows that the fit used, least squares can't do worse than no coefficients at all, which forecast
    what the last two values say.
    """
    filled = series(spark, sf_dir).fill(["temperature"], ["ffill", 0])
    frame = ordered(arima_forecast(filled, "temperature"), KEY, ORDER)
    df = frame.lags({"_a": ("temperature", 1), "_b": ("temperature", 2)}).row_number("_n").result()
    used = F.col("_n") > 14  # the depth of (1, 2, 4): two differences, and four shocks of eight lags each
    error = F.sum(F.when(used, F.pow(F.col("temperature") - F.col("predicted_temp"), 2)))
    naive = F.sum(F.when(used, F.pow(F.col("temperature") - 2 * F.col("_a") + F.col("_b"), 2)))
    return df.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("predicted_temp").isNull()).alias("n_missing"),
        F.coalesce(error <= naive * (1 + 1e-9) + 1e-6, F.lit(True)).alias("no_worse_than_naive"),
    )


@query(
    on_readings(
        """SELECT d, count(*) AS n_rows, round(sqrt(avg(power(z - CASE WHEN d = 0 THEN m ELSE 0 END, 2))), 4) AS rmse, 20::BIGINT AS n_no_worse
        FROM (SELECT *, avg(z) OVER (PARTITION BY device_id, d) AS m FROM z) GROUP BY d""",
        "f AS (SELECT event_id, device_id, ts, coalesce(last_value(temperature IGNORE NULLS) OVER w, 0) AS x FROM r WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))",
        """l AS (SELECT device_id, row_number() OVER w AS n, x, lag(x) OVER w AS a, lag(x, 2) OVER w AS b, lag(x, 3) OVER w AS c FROM f
          WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))""",
        """z AS (SELECT device_id, unnest([0, 1, 2, 3]) AS d, unnest([x, x - a, x - 2 * a + b, x - 3 * a + 3 * b - c]) AS z FROM l WHERE n > 15)""",
    )
)
def tune_orders(spark, sf_dir):
    """All 80 orders judged on the filled temperature of all devices.

    Orders without lags and shocks have a closed form; each of the 20 orders of a degree contains it and can't be worse.
    """
    filled = series(spark, sf_dir).fill(["temperature"], ["ffill", 0])
    judged = judge_orders(filled, "temperature")
    plain = F.max(F.when((F.col("p") == 0) & (F.col("q") == 0), F.col("rmse"))).over(Window.partitionBy("d"))
    return judged.withColumn("plain", plain).groupBy("d").agg(
        F.max("n_rows").alias("n_rows"),
        F.round(F.max("plain"), 4).alias("rmse"),
        F.count_if(F.col("rmse") <= F.col("plain") * (1 + 1e-9)).alias("n_no_worse"),
    )


# -- feature vectors, functions in Python -------------------------------------------------


@query(
    on_readings(
        f"SELECT event_id, {', '.join(f'{c} AS f{i}' for i, c in enumerate(_SIGNALS))}, CAST(defect AS DOUBLE) AS defect FROM r"
    )
)
def assemble(spark, sf_dir):
    df = features_label(readings(spark, sf_dir), "defect", _SIGNALS, keep=["event_id"])
    values = vector_to_array("features")
    return df.select("event_id", *[values[i].alias(f"f{i}") for i in range(len(_SIGNALS))], "defect")


@query(
    on_readings(
        "SELECT device_id, count(temperature) AS n_rows, round(regr_slope(temperature, delay), 6) AS slope, "
        "round(regr_intercept(temperature, delay), 4) AS intercept FROM r WHERE temperature IS NOT NULL GROUP BY device_id"
    )
)
def per_group(spark, sf_dir):
    """A straight line through temperature and delay of each device, from sums of its parts."""
    df = readings(spark, sf_dir).select("device_id", "temperature", "delay").dropna()
    sums = ["n", "sx", "sy", "sxx", "sxy"]

    def partial(pdf):
        x, y = pdf["delay"], pdf["temperature"]
        return merge(pdf[["device_id"]].assign(n=1.0, sx=x, sy=y, sxx=x * x, sxy=x * y))

    def merge(pdf):
        return pdf.groupby("device_id", as_index=False)[sums].sum()

    def finish(pdf):
        n, sx, sy, sxx, sxy = (pdf[c] for c in sums)
        slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
        intercept = (sy - slope * sx) / n
        return pd.DataFrame(
            {"device_id": pdf["device_id"], "n_rows": n.astype("int64"), "slope": slope.round(6), "intercept": intercept.round(4)}
        )

    summary = "device_id string, n double, sx double, sy double, sxx double, sxy double"
    return grouped(
        df, ["device_id"], partial, summary, merge, finish, "device_id string, n_rows long, slope double, intercept double"
    )


@query(on_readings("SELECT count(*) AS n_rows, round(sum(delay), 4) AS delay, round(sum(density), 4) AS density FROM r"))
def batch_stats(spark, sf_dir):
    """Batches of 2048 numeric rows, summed up over all batches."""

    def stats(pdf):
        return pd.DataFrame({"n": [len(pdf)], "delay": [pdf["delay"].sum()], "density": [pdf["density"].sum()]})

    batches = numeric_batches(readings(spark, sf_dir), ["delay", "density"], stats, "n long, delay double, density double")
    return batches.agg(
        F.sum("n").alias("n_rows"),
        *[F.round(F.sum(c), 4).alias(c) for c in ("delay", "density")],
    )


# A scorer with given weights stands for a fitted model where the answer must be repeatable.
_BIAS, _WEIGHTS = -14.0, {"delay": 0.25, "density": 0.5, "rotation_speed": 0.004, "air_pressure": 0.001}


def _logit_sql(weights: dict[str, float], bias: float, alias: str = "") -> str:
    total = " + ".join([f"{bias}e0", *[f"{w}e0 * {alias}{c}" for c, w in weights.items()]])
    return f"1e0 / (1e0 + exp(-({total})))"


def _logit(weights: dict[str, float], bias: float):
    total = F.lit(bias)
    for c, w in weights.items():
        total = total + F.lit(w) * F.col(c)
    return sigmoid(total)


@query(on_readings(f"SELECT event_id, round({_logit_sql(_WEIGHTS, _BIAS)}, 6) AS probability FROM r"))
def udf_score(spark, sf_dir):
    """A vectorised Python function with parameters bound by a closure."""

    def logistic(*columns, weights, bias):
        total = bias + sum(w * c for w, c in zip(weights, columns))
        return 1.0 / (1.0 + np.exp(-total))

    scorer = make_udf(logistic, weights=list(_WEIGHTS.values()), bias=_BIAS)
    df = readings(spark, sf_dir)
    return df.select("event_id", r6(scorer(*[F.col(c) for c in _WEIGHTS])).alias("probability"))


@query(
    on_readings(
        f"""SELECT event_id, r.model_id, round(1e0 / (1e0 + exp(-(bias + {" + ".join(f"w{i} * {c}" for i, c in enumerate(_SIGNALS))}))), 6) AS probability
        FROM r LEFT JOIN w ON r.model_id = w.model_id""",
        f"""w AS (SELECT model_id, -10 * avg(defect) - 3 AS bias,
          {", ".join(f"avg({c}) / (100 * max({c})) AS w{i}" for i, c in enumerate(_SIGNALS))}
          FROM r WHERE model_id <> 'SkyBolt1' GROUP BY model_id)""",
    )
)
def route_score(spark, sf_dir):
    """Each row scored by the weights of its own engine model; one model has none."""
    df = readings(spark, sf_dir)
    weights = F.array(*[F.avg(c) / (100 * F.max(c)) for c in _SIGNALS])
    models = df.where("model_id <> 'SkyBolt1'").groupBy("model_id").agg(
        (-10 * F.avg("defect") - 3).alias("bias"), weights.alias("weights")
    )
    scored = apply_per_key(df, models, "model_id", _SIGNALS)
    return scored.select("event_id", "model_id", r6("probability").alias("probability"))


_COMBO_BIAS = -3.0
_COMBO = {"temp_difference": 0.05, "rolling_mean_density": 0.4, "predicted_temp": 0.02, "ohe_A06": 0.3, "ohe_SkyJet234": 0.2}


@query(
    on_readings(
        f"""SELECT event_id, round(predicted_temp, 6) AS predicted_temp, round({_logit_sql(_COMBO, _COMBO_BIAS)}, 6) AS prediction FROM (
          SELECT *, coalesce(x1 + phi * (x1 - x2), x1, 0e0) AS predicted_temp, CASE WHEN factory_id = 'A06' THEN 1e0 ELSE 0e0 END AS "ohe_A06",
            CASE WHEN model_id = 'SkyJet234' THEN 1e0 ELSE 0e0 END AS "ohe_SkyJet234" FROM l JOIN c USING (device_id))""",
        *FEATURE_CTES,
        """l AS (SELECT *, lag(temperature) OVER w AS x1, lag(temperature, 2) OVER w AS x2 FROM filled
          WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))""",
        "c AS (SELECT device_id, sum((temperature - x1) * (x1 - x2)) / sum((x1 - x2) * (x1 - x2)) AS phi FROM l GROUP BY device_id)",
    )
)
def combo_model(spark, sf_dir):
    """Raw readings to features, forecast and prediction in one object."""

    def predict(df):
        return df.withColumn("prediction", _logit(_COMBO, _COMBO_BIAS))

    model = ComboModel(VOCABULARY, order=(1, 1, 0), trip_grain="week", predict=predict)
    scored = model.transform(readings(spark, sf_dir))
    return scored.select("event_id", r6("predicted_temp").alias("predicted_temp"), r6("prediction").alias("prediction"))


# -- streaming ----------------------------------------------------------------------------


@query(on_readings(f"SELECT event_id, defect, CAST({_logit_sql(_WEIGHTS, _BIAS)} > 0.5e0 AS INTEGER) AS predictions FROM r"))
def stream_score(spark, sf_dir):
    """The readings scored as a stream until all available rows are taken; the sink is read back."""
    source, sink = scratch_path(spark, "stream_source"), scratch_path(spark, "stream_sink")
    write_path(readings(spark, sf_dir), source)

    def scorer(batch):
        return batch.select("event_id", "defect", (_logit(_WEIGHTS, _BIAS) > 0.5).cast("int").alias("predictions"))

    drain(score_stream(stream_table(spark, source), scorer, sink, scratch_path(spark, "stream_checkpoint"), name=None))
    return spark.read.parquet(sink).drop("batch_id")


# -- classifiers --------------------------------------------------------------------------

_FEATURES = [
    "airflow_rate", "rotation_speed", "air_pressure", "temperature", "delay", "density",
    "rolling_mean_temp", "temp_difference", "rolling_mean_density",
]
_MODEL_COLUMNS = [*_FEATURES, *[f"ohe_{v}" for values in VOCABULARY.values() for v in values]]


def silver(spark, sf_dir):
    """The feature table, written out once: training makes many passes over it."""
    return stored(feature_table(spark, sf_dir), "silver")


def split(features):
    return ordered_split(features, 0.8, ["ts", "event_id"])


def upsampled(train):
    return oversample(train, "defect", _MODEL_COLUMNS, "event_id", k=5, search=knn_forest)


#: Of each class a model must find this share: what guesses the larger class only finds none of the other.
_LEARNT = 0.2
_TEST = "i AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS i, count(*) OVER () AS n FROM r)"


def by_class(scored: DataFrame, prediction: str = "predictions", keys: tuple[str, ...] = ()) -> DataFrame:
    """Per true class the rows that were scored, and whether the model finds the class."""
    right = F.avg((F.col(prediction).cast("int") == F.col("defect").cast("int")).cast("double"))
    return scored.groupBy(*keys, F.col("defect").cast("int").alias("defect")).agg(F.count(prediction).alias("n_scored"), (right > _LEARNT).alias("learnt"))


_BY_CLASS = "SELECT CAST(defect AS INTEGER) AS defect, count(*) AS n_scored, true AS learnt FROM i WHERE i > floor(0.8e0 * n) GROUP BY defect"


@query(on_readings(_BY_CLASS, _TEST))
def rf_scores(spark, sf_dir):
    """Forest of 100 trees on the first 80 % of the rows, predictions for the others."""
    train, test = split(silver(spark, sf_dir))
    return by_class(score(test, train_rf(train, "defect", _MODEL_COLUMNS)))


@query(on_readings(_BY_CLASS, _TEST))
def lr_scores(spark, sf_dir):
    """Logistic regression on the oversampled training rows."""
    train, test = split(silver(spark, sf_dir))
    return by_class(score(test, train_lr(upsampled(train), "defect", _MODEL_COLUMNS)))


@query(
    on_readings(
        """SELECT run, count(*) FILTER (defect = 1) AS n_defects, true AS learnt FROM i, (SELECT unnest(['First Run RF', 'Second Run RF']) AS run)
        WHERE i > floor(0.8e0 * n) GROUP BY run""",
        _TEST,
    )
)
def rf_eval(spark, sf_dir):
    """Held-out quality of the forest without and with oversampling."""
    train, test = split(silver(spark, sf_dir))
    runs = {"First Run RF": train, "Second Run RF": upsampled(train)}
    found = stack_frames(
        [evaluate(train_rf(rows, "defect", _MODEL_COLUMNS), test, "defect").withColumn("run", F.lit(n)) for n, rows in runs.items()]
    )
    return found.select("run", (F.col("tp") + F.col("fn")).alias("n_defects"), (F.col("recall") > _LEARNT).alias("learnt"))


@query(
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in _MODEL_COLUMNS) + "]) AS feature, 1e0 AS total, true AS plausible",
    name="importances",
)
def feature_importances(spark, sf_dir):
    """Importance of each feature: shares of one, and small for the columns that the label does not depend on."""
    train, _ = split(silver(spark, sf_dir))
    found = importances(spark, train_rf(train, "defect", _MODEL_COLUMNS), _MODEL_COLUMNS)
    share = F.col("importance")
    most = F.when(F.col("feature").startswith("ohe_"), 0.1).otherwise(1.0)
    total = F.round(F.sum(share).over(Window.partitionBy()), 6)  # a row per feature of the model
    return found.select("feature", total.alias("total"), ((share >= 0) & (share <= most)).alias("plausible"))


@query(on_readings("SELECT CAST(defect AS INTEGER) AS defect, count(*) AS n_scored, true AS learnt FROM r GROUP BY defect"))
def batch_score(spark, sf_dir):
    """Log two runs, register the one with the better held-out recall, score with the production model."""
    features = silver(spark, sf_dir)
    train, test = split(features)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    for name, fit in (("rf", train_rf), ("lr", train_lr)):
        ledger.log_model_run(fit(train, "defect", _MODEL_COLUMNS), train, "defect", _MODEL_COLUMNS, name, test=test)
    version = ledger.register("device_defect", ledger.best("test_recall"))
    ledger.set_stage("device_defect", version, "Production")
    return by_class(ledger.score(features, "device_defect"))


@query(on_readings("SELECT model_id, count(*) AS n_used, true AS at_optimum FROM r GROUP BY model_id"))
def per_key_models(spark, sf_dir):
    """A logistic model per engine model, fitted together: whether the slope of its likelihood has come to nothing."""
    df = readings(spark, sf_dir)
    models = train_per_key(df, "model_id", "defect", _SIGNALS)
    scored = apply_per_key(df, models, "model_id", _SIGNALS)
    # In units of each column's size; the small penalty leaves a slope of its own.
    slope = F.greatest(*[F.abs(F.avg((F.col("defect") - F.col("probability")) * F.col(c))) / (1 + F.avg(F.abs(c))) for c in _SIGNALS])
    checked = scored.groupBy("model_id").agg((slope < 2e-3).alias("at_optimum"))
    return models.select("model_id", "n_used").join(checked, "model_id")


# -- composite models ---------------------------------------------------------------------


def with_forecast(spark, sf_dir, **options):
    """The composite model's features, written out once, and their columns."""
    combo = ComboModel(VOCABULARY, trip_grain="week", **options)
    return combo, stored(combo.features(readings(spark, sf_dir)), "combo_features"), [*_MODEL_COLUMNS, "predicted_temp"]


@query(on_readings(_BY_CLASS, _TEST))
def arima_forest(spark, sf_dir):
    """A forest that also sees the forecast of the temperature."""
    _, features, columns = with_forecast(spark, sf_dir)
    train, test = split(features)
    return by_class(score(test, train_rf(train, "defect", columns)))


@query(on_readings("SELECT CAST(defect AS INTEGER) AS defect, count(*) AS n_rows, 0::BIGINT AS n_changed FROM r GROUP BY defect"))
def combo_saved(spark, sf_dir):
    """A composite model logged with its metrics, loaded by stage, and scored from raw readings: the same before and after."""
    combo, features, columns = with_forecast(spark, sf_dir)
    train, test = split(features)
    fitted = replace(combo, model=train_rf(train, "defect", columns, trees=20))
    raw = readings(spark, sf_dir)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    found = evaluate(fitted.model, test, "defect").first().asDict()
    run = ledger.log_composite(fitted, raw, "combo", {f"test_{k}": v for k, v in found.items()})
    ledger.set_stage("combo", ledger.register("combo", run), "Production")
    before = fitted.predicted(features).select("event_id", "defect", "prediction")
    after = ledger.score(raw, "combo", out="again").select("event_id", "again")
    both = before.join(after, "event_id")
    changed = F.count_if(~F.col("prediction").eqNullSafe(F.col("again")) | F.col("prediction").isNull())
    return both.groupBy(F.col("defect").cast("int").alias("defect")).agg(F.count(F.lit(1)).alias("n_rows"), changed.alias("n_changed"))


@query(on_readings("SELECT model_id, count(*) AS n_rows, count(*) AS n_used, 0::BIGINT AS n_unscored, true AS learnt FROM r GROUP BY model_id"))
def forest_per_model(spark, sf_dir):
    """A forest per engine model inside a composite model, logged with a run per engine, loaded by stage, and each raw reading routed to its own.

    Learnt is whether a forest finds at least half the defects among the rows it was fitted on, and clears as many of the others.
    """
    combo = ComboModel({"factory_id": VOCABULARY["factory_id"]}, trip_grain="week")
    features = stored(combo.features(readings(spark, sf_dir)), "combo_features")
    columns = [*_FEATURES, *[f"ohe_{v}" for v in VOCABULARY["factory_id"]], "predicted_temp"]
    forest = train_forest_per_key(features, "model_id", "defect", columns, trees=10)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    parent = log_forest_per_key(ledger, forest, "per model")
    raw = readings(spark, sf_dir)
    run = ledger.log_composite(replace(combo, model=load_forest_per_key(ledger, parent)), raw, "per model", parent_run_id=parent)
    ledger.set_stage("per model", ledger.register("per model", run), "Production")
    scored = ledger.score(raw, "per model")
    right = F.col("predictions") == F.col("defect")
    shares = [F.coalesce(F.avg(F.when(F.col("defect") == c, right.cast("double"))), F.lit(1.0)) for c in (0, 1)]
    found = scored.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("predictions").isNull()).alias("n_unscored"), (F.least(*shares) >= 0.5).alias("learnt")
    )
    used = ledger.runs().where((F.col("parent_run_id") == parent) & F.col("tags")["model_id"].isNotNull())
    used = used.select(F.col("tags")["model_id"].alias("model_id"), F.col("metrics")["n_used"].cast("long").alias("n_used"))
    return found.join(used, "model_id")


#: Rows of a worker, and gradient steps that each takes per epoch at least.
_SHARE, _STEPS = 8_192, 30


@query(on_series("SELECT CAST(defect AS INTEGER) AS defect, count(*) AS n_scored, true AS learnt FROM i WHERE i > floor(0.7e0 * n) GROUP BY defect", _TEST))
def mlp_scores(spark, sf_dir):
    """The neural classifier on the first 70 % of the numeric rows, with both classes of equal weight; the others scored by class.

    Few rows make smaller batches, so that each worker takes enough steps to learn.
    """
    train, test = dl_tables(spark, sf_dir)
    n = train.count()
    workers = max(1, min(n // _SHARE, spark.sparkContext.defaultParallelism))
    batch = max(16, min(BATCH, n // workers // _STEPS))
    model = train_mlp(train, "defect", _DL_COLUMNS, batch=batch, workers=workers, balanced=True)
    return by_class(model.score(test, prediction="predictions"))


@query(on_readings("SELECT device_id, count(temperature) AS n_rows, true AS at_optimum, true AS no_worse FROM r WHERE temperature IS NOT NULL GROUP BY device_id"))
def robust_lines(spark, sf_dir):
    """Huber's line through density and temperature of each device: whether its equations hold, and it beats least squares by its own measure."""
    limit = 5.0
    df = stored(readings(spark, sf_dir).select("device_id", "density", "temperature").dropna(), "lines")
    lines = huber_lines(df, "device_id", "density", "temperature", limit)
    plain = df.groupBy("device_id").agg(F.regr_slope("temperature", "density").alias("p"), F.regr_intercept("temperature", "density").alias("q"), F.avg("density").alias("m"))
    both = lookup(lookup(df, lines.select("device_id", "n_rows", "slope", "intercept"), ["device_id"]), plain, ["device_id"])

    def loss(r):
        return F.when(F.abs(r) <= limit, r * r / 2).otherwise(limit * (F.abs(r) - limit / 2))

    r = F.col("temperature") - F.col("intercept") - F.col("slope") * F.col("density")
    push = F.greatest(F.lit(-limit), F.least(F.lit(limit), r))
    flat = F.coalesce("q", F.lit(0.0)) + F.coalesce("p", F.lit(0.0)) * F.col("density")
    return both.groupBy("device_id").agg(
        F.max("n_rows").alias("n_rows"),
        (F.greatest(F.abs(F.avg(push)), F.abs(F.avg(push * (F.col("density") - F.col("m"))))) < 1e-6).alias("at_optimum"),
        (F.sum(loss(r)) <= F.sum(loss(F.col("temperature") - flat)) + 1e-6).alias("no_worse"),
    )


_PHI, _THETA = 0.5, (0.4, -0.2)


@query(
    on_readings(
        "SELECT event_id, round(e, 6) AS shock FROM e",
        "x AS (SELECT event_id, device_id, row_number() OVER w AS n, delay - 0.5e0 * lag(delay) OVER w AS w FROM r WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))",
        """e AS (SELECT event_id, device_id, n, w AS e, 0e0 AS e1, 0e0 AS e2 FROM x WHERE n = 1
          UNION ALL SELECT x.event_id, x.device_id, x.n, x.w - 0.4e0 * coalesce(e.e, 0e0) + 0.2e0 * e.e1, coalesce(e.e, 0e0), e.e1
          FROM e JOIN x ON x.device_id = e.device_id AND x.n = e.n + 1)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
)
def arma_shocks(spark, sf_dir):
    """One-step shocks of the delay under given terms, one after the other, in blocks of 20 readings."""
    frame = series(spark, sf_dir, rows_per_block=20).lag("delay", 1, "_before").with_column("_w", F.col("delay") - _PHI * F.col("_before"))
    df = innovations(frame, "_w", F.array(*[F.lit(t) for t in _THETA]), "shock")
    return df.select("event_id", r6("shock").alias("shock"))


@query(on_readings("SELECT device_id, count(*) AS n_rows, 0::BIGINT AS n_missing, true AS beats_naive FROM r GROUP BY device_id"))
def arima_recursive(spark, sf_dir):
    """Forecast of the delay with shocks of the model itself: none is missing, and it beats the last value over all rows."""
    filled = series(spark, sf_dir)
    df = arima_forecast(filled, "delay", (1, 0, 2), "predicted", recursive=True)
    df = ordered(df, KEY, ORDER).lag("delay", 1, "_before").result()
    return (
        df.groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("predicted").isNull()).alias("n_missing"), F.sum(F.pow(F.col("delay") - F.col("predicted"), 2)).alias("e"), F.sum(F.pow(F.col("delay") - F.coalesce("_before", F.lit(0.0)), 2)).alias("f"))
        .withColumn("beats_naive", F.sum("e").over(Window.partitionBy()) < F.sum("f").over(Window.partitionBy()))
        .drop("e", "f")
    )


_DL_COLUMNS = ["airflow_rate", "rotation_speed", "air_pressure", "temperature", "delay", "density"]
_DL_KEYS = ["event_id", "device_id", "ts", "factory_id", "model_id"]


def dl_rows(spark, sf_dir):
    """The numeric columns, nulls filled with 0."""
    return airflow(series(spark, sf_dir), "rotation_speed", "air_pressure").result().fillna(0, subset=["airflow_rate", "temperature"])


def dl_tables(spark, sf_dir):
    return prepare_training(dl_rows(spark, sf_dir), ["ts", "event_id"], 0.7, drop=_DL_KEYS)


_DL_SQL = ", ".join(f"coalesce({c}, 0) AS {c}" if c in ("airflow_rate", "temperature") else c for c in _DL_COLUMNS)


@query(
    on_series(
        f"""SELECT CASE WHEN id <= floor(0.7e0 * n) THEN 'train' ELSE 'test' END AS part, id, {_DL_SQL}, defect FROM (
        SELECT *, row_number() OVER (ORDER BY ts, event_id) AS id, count(*) OVER () AS n FROM s)"""
    )
)
def dl_split(spark, sf_dir):
    """Numeric training and test tables with a dense id, written and read back."""
    paths = [scratch_path(spark, p) for p in ("dl_train", "dl_test")]
    prepare_training(dl_rows(spark, sf_dir), ["ts", "event_id"], 0.7, _DL_KEYS, *paths)
    train, test = (read_table(spark, p) for p in paths)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# -- ledger -------------------------------------------------------------------------------


def _runs(spark, sf_dir):
    """Runs in the shape of the ledger, with metrics counted from the data: one per factory, one below it per engine model."""
    df = readings(spark, sf_dir).withColumn("p", (F.col("delay") > 38).cast("int"))

    def as_runs(keys, name, parent):
        found = binary_metrics(df, "p", "defect", keys).withColumn("n", F.col("tp") + F.col("fn"))
        metrics = F.when(F.col("n") > 0, F.create_map(F.lit("recall"), "recall", F.lit("n_defects"), F.col("n").cast("double")))
        return found.select(
            F.concat_ws("/", *keys).alias("run_id"),
            parent.alias("parent_run_id"),
            name.alias("name"),
            F.coalesce(metrics, F.create_map().cast("map<string,double>")).alias("metrics"),
        )

    return stack_frames(
        [
            as_runs(["factory_id"], F.col("factory_id"), F.lit(None).cast("string")),
            as_runs(["factory_id", "model_id"], F.col("model_id"), F.col("factory_id")),
        ]
    )


_RUNS = """runs AS (
  SELECT factory_id AS run_id, NULL AS parent_run_id, factory_id AS name, count(*) FILTER (delay > 38 AND defect = 1) AS tp,
    count(*) FILTER (defect = 1) AS n FROM r GROUP BY factory_id
  UNION ALL
  SELECT factory_id || '/' || model_id, factory_id, model_id, count(*) FILTER (delay > 38 AND defect = 1), count(*) FILTER (defect = 1)
  FROM r GROUP BY factory_id, model_id)"""


@query(
    on_readings(
        "SELECT run_id, name, round(CASE WHEN n > 0 THEN tp / n::DOUBLE END, 6) AS recall FROM runs "
        "ORDER BY CASE WHEN n > 0 THEN tp / n::DOUBLE END DESC NULLS LAST, run_id LIMIT 1",
        _RUNS,
    )
)
def best_run(spark, sf_dir):
    found = best_by_metric(_runs(spark, sf_dir), "recall")
    return found.select("run_id", "name", r6(F.col("metrics")["recall"]).alias("recall"))


@query(
    on_readings(
        "SELECT p.name AS parent_name, c.name, round(CASE WHEN c.n > 0 THEN c.tp / c.n::DOUBLE END, 6) AS recall FROM runs c JOIN runs p ON c.parent_run_id = p.run_id",
        _RUNS,
    )
)
def run_tree(spark, sf_dir):
    tree = nested_runs(_runs(spark, sf_dir))
    return tree.select("parent_name", "name", r6(F.col("metrics")["recall"]).alias("recall"))


@query(
    """SELECT name, version, stage FROM (
      SELECT CAST(user_id AS VARCHAR) AS name, CAST(event_id % 3 AS INTEGER) + 1 AS version, event_type AS stage,
        row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
)
def current_stage(spark, sf_dir):
    """Events read as stage changes of three versions per user: the latest one holds."""
    changes = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("name"),
        (F.col("event_id") % 3 + 1).cast("int").alias("version"),
        F.col("event_type").alias("stage"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
    )
    return latest_stage(changes)
