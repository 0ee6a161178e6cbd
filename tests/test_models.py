"""Classifiers, per-key models, the neural net, grouped fits and the ledger."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelens.operators.groups import make_udf, numeric_batches, per_group, rebatch
from devicelens.operators.profile import binary_metrics
from devicelens.plans import forest, mlp, perkey
from devicelens.plans.combo import ComboModel
from devicelens.plans.ledger import Ledger, check_signature, run_tree, signature
from devicelens.plans.models import evaluate, importances, score, train_lr, train_perceptron, train_rf
from devicelens.plans.training import prepare_training
from devicelens.session import scratch_path
from devicelens.sources.sensor import VOCABULARY, readings


@pytest.fixture(scope="module")
def labelled(spark):
    """Two classes that a tree can tell apart; key 'b' has the opposite sign."""
    rng = np.random.default_rng(8)
    n = 1200
    pdf = pd.DataFrame({"id": np.arange(n), "k": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])})
    pdf["u"], pdf["v"], pdf["w"] = rng.normal(0, 1, n), rng.normal(5, 2, n), rng.normal(0, 1, n)
    sign = np.where(pdf["k"] == "b", -1, 1)
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(-(2 * sign * pdf["u"] + 0.5 * (pdf["v"] - 5))))).astype("int32")
    return pdf, spark.createDataFrame(pdf).repartition(4)


def accuracy(df, prediction, label="y"):
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double"))).first()[0]


def test_forest_and_logistic(spark, labelled):
    _, df = labelled
    easy = df.withColumn("y", (F.col("u") > 0.3).cast("int"))
    rf = train_rf(easy, "y", ["u", "v", "w"], trees=20)
    again = train_rf(easy, "y", ["u", "v", "w"], trees=20)
    top = importances(spark, rf, ["u", "v", "w"]).collect()
    assert top[0].feature == "u" and top == importances(spark, again, ["u", "v", "w"]).collect()
    majority = max(easy.agg(F.avg("y")).first()[0], 0.5)
    for model in (rf, train_lr(easy, "y", ["u", "v", "w"]), train_perceptron(easy, "y", ["u", "v", "w"], [6])):
        assert accuracy(score(easy, model), "predictions") > majority + 0.2
    row = evaluate(rf, easy, "y").first()
    assert row.recall > 0.9 and row.f1 > 0.9
    assert score(easy, rf).columns == [*easy.columns, "predictions"]


def test_logistic_per_key(spark, labelled):
    pdf, df = labelled
    columns = ["u", "v"]
    got = perkey.train_per_key(df, "k", "y", columns, ridge=1e-6, max_iter=25, tolerance=1e-9)
    models = {r.k: r for r in got.collect()}
    assert {k: r.n_used for k, r in models.items()} == pdf["k"].value_counts().to_dict()
    for k, part in pdf.groupby("k"):
        x = np.column_stack([np.ones(len(part)), part[columns]])
        b = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ b))
            b += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (part["y"] - p))
        np.testing.assert_allclose([models[k].bias, *models[k].weights], b, rtol=2e-2, atol=2e-3)
    routed = perkey.apply_per_key(df.withColumn("k", F.when(F.col("id") == 0, "other").otherwise(F.col("k"))), got, "k", columns)
    assert routed.where("probability is null").select("id").collect() == [(0,)]
    assert accuracy(routed.withColumn("p", (F.col("probability") > 0.5).cast("int")), "p") > 0.75


def trees_of(forest):
    return {r.key: (r.n_used, r.n_positive, r.trees) for r in forest.models.collect()}


def test_forest_per_key_routes_each_row(spark, labelled):
    _, df = labelled
    flipped = df.withColumn("y", ((F.col("u") > 0) != (F.col("k") == "b")).cast("int"))
    made = forest.train_forest_per_key(flipped, "k", "y", ["u", "v"], trees=8)
    scored = made.score(flipped)
    assert scored.count() == 1200 and accuracy(scored, "predictions") > 0.95 and scored.columns == [*flipped.columns, "predictions"]
    other = flipped.withColumn("k", F.when(F.col("id") == 3, "x").when(F.col("id") == 4, None).otherwise(F.col("k")))
    assert sorted(r.id for r in made.score(other).where("predictions is null").collect()) == [3, 4]

    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    parent = perkey.log_forest_per_key(ledger, made, "per key")
    children = run_tree(ledger.runs()).collect()
    assert sorted(r.name for r in children) == ["a", "b", "c"] and set(ledger.model_map(parent, "k")) == {"a", "b", "c"}
    assert {r.name: r.metrics["n_used"] for r in children} == {r["k"]: r["count"] for r in flipped.groupBy("k").count().collect()}
    again = perkey.load_forest_per_key(ledger, parent).score(flipped)
    assert again.orderBy("id").collect() == scored.orderBy("id").collect()


def test_forest_per_key_does_not_depend_on_the_layout(spark, labelled):
    """A key over many blocks, keys that share one, and any partitioning give the same trees."""
    _, df = labelled
    want = trees_of(forest.train_forest_per_key(df, "k", "y", ["u", "v", "w"], trees=3, depth=3))
    got = trees_of(forest.train_forest_per_key(df.repartition(9), "k", "y", ["u", "v", "w"], trees=3, depth=3, block_rows=100))
    assert got == want and all(len(t[2]) == 3 for t in want.values())


def test_forest_cuts_are_the_best_ones(spark, labelled):
    """The root of a tree on all columns, against every cut of every column."""
    pdf, df = labelled
    made = forest.train_forest_per_key(df, "k", "y", ["u", "v", "w"], trees=2, depth=1, features=3)
    edges = forest._edges(df, ["u", "v", "w"], forest.BINS)
    hashes = {r.id: r.h for r in df.select("id", F.xxhash64(F.col("k"), F.col("y").cast("double"), "u", "v", "w").alias("h")).collect()}
    for key, (_, _, trees) in trees_of(made).items():
        part = pdf[pdf["k"] == key]
        for t, tree in enumerate(trees):
            w, y = forest._drawn(part["id"].map(hashes).to_numpy(), t, 42), part["y"].to_numpy(float)
            best = (-1.0, None, None)
            for j, c in enumerate("uvw"):
                for e in edges[j]:
                    left = part[c].to_numpy() <= e
                    parts = [(w[m].sum(), (w * y)[m].sum()) for m in (np.ones(len(w), bool), left, ~left)]
                    if parts[1][0] >= 1 and parts[2][0] >= 1:
                        a, b, d = (p * (n - p) / n for n, p in parts)
                        best = max(best, (round(a - b - d, 9), -j, -e))
            assert tree.feature[0] == -best[1] and tree.cut[0] == -best[2]
            left = part["uvw"[tree.feature[0]]].to_numpy() <= tree.cut[0]
            np.testing.assert_allclose(tree.p[1:3], [(w * y)[left].sum() / w[left].sum(), (w * y)[~left].sum() / w[~left].sum()])


def test_forests_for_very_many_keys(spark):
    """More keys than any list of fits could hold: one pass per level serves them all."""
    rng = np.random.default_rng(2)
    n = 24_000
    pdf = pd.DataFrame({"k": rng.integers(0, 1_500, n), "u": rng.normal(size=n), "v": rng.normal(size=n)})
    pdf.loc[:8_000, "k"] = 7
    pdf["y"] = ((pdf["u"] > 0) != (pdf["k"] % 2 == 0)).astype("int32")
    df = spark.createDataFrame(pdf).repartition(4)
    made = forest.train_forest_per_key(df, "k", "y", ["u", "v"], trees=3, depth=2, block_rows=3_000, features=2)
    assert made.models.count() == pdf["k"].nunique()
    scored = made.score(df)
    assert scored.where("predictions is null").count() == 0 and accuracy(scored, "predictions") > 0.9


def test_composite_in_the_ledger(spark, sf_dir):
    raw = readings(spark, sf_dir)
    combo = ComboModel({"model_id": VOCABULARY["model_id"]}, order=(1, 1, 0), trip_grain="week")
    features = combo.features(raw).cache()
    made = forest.train_forest_per_key(features, "factory_id", "defect", ["delay", "density", "rotation_speed", "air_pressure"], trees=3)
    fitted = replace(combo, model=made)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.set_stage("c", ledger.register("c", ledger.log_composite(fitted, raw, "c", {"recall": 0.5})), "Production")
    before = {r.event_id: r.prediction for r in fitted.predicted(features).collect()}
    after = {r.event_id: r.predictions for r in ledger.score(raw, "c").collect()}
    assert before == after and None not in before.values() and len(before) == raw.count()
    with pytest.raises(ValueError):
        ledger.score(raw.drop("delay"), "c")


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    shapes = mlp._shapes(3, (5, 4))
    flat = mlp._start(3, (5, 4), 1)
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    _, gradient = mlp._loss_gradient(flat, shapes, x, y)
    for i in range(0, len(flat), 7):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        slope = (mlp._loss_gradient(flat + step, shapes, x, y)[0] - mlp._loss_gradient(flat - step, shapes, x, y)[0]) / 2e-6
        assert abs(slope - gradient[i]) < 1e-6


def test_network_learns_and_repeats(spark, labelled):
    _, df = labelled
    easy = df.withColumn("y", (F.abs("u") > 0.7).cast("int"))
    fit = lambda: mlp.train_mlp(easy, "y", ["u", "v"], epochs=15, batch=32, workers=3)
    model = fit()
    assert model.history[-1] < 0.6 * model.history[0]
    np.testing.assert_allclose(model.history, fit().history, rtol=1e-6)
    scored = model.score(easy, prediction="p")
    assert accuracy(scored, "p") > 0.9
    assert binary_metrics(scored, "p", "y").first().f1 > 0.9


def test_training_stops_early(spark, labelled):
    _, df = labelled
    model = mlp.train_mlp(df, "y", ["u"], epochs=20, learning_rate=0.0, patience=3, workers=2)
    assert len(model.history) <= 5


def test_training_tables(spark, labelled):
    pdf, df = labelled
    paths = scratch_path(spark, "train"), scratch_path(spark, "test")
    prepare_training(df, ["id"], 0.7, ["k"], *paths)
    train, test = (spark.read.parquet(p) for p in paths)
    assert (train.count(), test.count()) == (840, 360)


def test_grouped_fit_in_parts(spark, labelled):
    pdf, df = labelled
    sums = lambda p: p.groupby("k", as_index=False)[["n", "s"]].sum()
    got = per_group(
        df.select("k", "v"), ["k"],
        lambda p: sums(p.assign(n=1.0, s=p["v"])), "k string, n double, s double", sums,
        lambda p: p.assign(mean=p["s"] / p["n"])[["k", "mean"]], "k string, mean double",
    )
    assert {r.k: pytest.approx(r.mean) for r in got.collect()} == pdf.groupby("k")["v"].mean().to_dict()


def test_batches(spark):
    frames = [pd.DataFrame({"a": range(n)}) for n in (3, 10, 1, 6)]
    assert [len(b) for b in rebatch(frames, 4)] == [4, 4, 4, 4, 4]
    sizes = numeric_batches(spark.range(50).coalesce(1), ["id"], lambda p: pd.DataFrame({"n": [len(p)]}), "n long", batch=20)
    assert [r.n for r in sizes.collect()] == [20, 20, 10]
    plus = make_udf(lambda x, by: x + by, by=2.5)
    assert spark.range(2).select(plus("id").alias("x")).collect() == [(2.5,), (3.5,)]


def test_ledger(spark, labelled):
    _, df = labelled
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    assert ledger.runs().count() == 0
    parent = ledger.log_run("parent")
    first = ledger.log_run("first", {"depth": 5}, {"test_recall": 0.4}, {"model_id": "a"}, "/m/a", parent, inputs=df.select("u"))
    second = ledger.log_run("second", metrics={"test_recall": 0.7}, tags={"model_id": "b"}, model_path="/m/b", parent_run_id=parent)
    ledger.log_run("third", metrics={"other": 9.0})
    assert ledger.best("test_recall") == second and ledger.best("test_recall", highest=False) == first
    assert ledger.model_map(parent) == {"a": "/m/a", "b": "/m/b"}
    assert ledger.runs().where("name = 'first'").first().params == {"depth": "5"}

    model = train_lr(df, "y", ["u", "v"])
    run = ledger.log_model_run(model, df, "y", ["u", "v"], "auto")
    row = ledger.runs().where(F.col("run_id") == run).first()
    assert row.metrics["training_recall"] > 0.5 and "maxIter" in row.params
    versions = [ledger.register("defects", r) for r in (first, run)]
    assert versions == [1, 2] and ledger.register("another", first) == 1
    with pytest.raises(LookupError):
        ledger.resolve("defects")
    for version, stage in ((1, "Production"), (2, "Staging"), (1, "Archived"), (2, "Production")):
        ledger.set_stage("defects", version, stage)
    assert ledger.resolve("defects") == row.model_path
    loaded = score(df, ledger.load("defects")).orderBy("id").select("predictions").collect()
    assert loaded == score(df, model).orderBy("id").select("predictions").collect()
    check_signature(df, row.signature)
    with pytest.raises(ValueError, match="u double"):
        check_signature(df.drop("u"), signature(df.select("u")))
    forest = train_rf(df, "y", ["u", "v"], trees=3)
    path = ledger.log_importances(run, forest, ["u", "v"])
    assert spark.read.parquet(path).count() == 2


def test_synchronous_training_does_not_depend_on_the_layout(spark, labelled):
    _, df = labelled
    losses = [mlp.train_mlp(df.repartition(p), "y", ["u", "v", "w"], epochs=2, batch=400, workers=p, synchronous=True).history for p in (1, 4, 8)]
    np.testing.assert_allclose(losses[1:], [losses[0]] * 2, rtol=1e-9)
    assert losses[0][1] < losses[0][0]


def test_training_reads_whole_batches(spark, labelled, monkeypatch):
    """An epoch gets batches that were packed once, not rows; the weights are those of the plain loop over the same batches."""
    pdf, df = labelled
    monkeypatch.setattr(mlp, "SLICE", 64)
    one = spark.createDataFrame(pdf).coalesce(1)
    got = mlp.train_mlp(one, "y", ["u", "v", "w"], epochs=2, batch=250, balanced=True)
    part = one.toPandas()
    x = (part[["u", "v", "w"]].to_numpy(float) - got.centre) / got.width
    y, shapes, flat = part["y"].to_numpy(float), mlp._shapes(3, mlp.HIDDEN), mlp._start(3, mlp.HIDDEN, 0)
    heavy = (0.5 / (1 - y.mean()), 0.5 / y.mean())
    m, v, t = np.zeros(len(flat)), np.zeros(len(flat)), 0
    for _ in range(2):
        for at in range(0, len(y), 250):
            t += 1
            whole = slice(at, at + 250)
            monkeypatch.setattr(mlp, "SLICE", 10_000)
            gradient = mlp._loss_gradient(flat, shapes, x[whole], y[whole], heavy)[1]
            monkeypatch.setattr(mlp, "SLICE", 64)
            np.testing.assert_allclose(mlp._loss_gradient(flat, shapes, x[whole], y[whole], heavy)[1], gradient, rtol=1e-9, atol=1e-12)
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient * gradient
            flat = flat - mlp.LEARNING_RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    np.testing.assert_allclose(got.flat, flat, rtol=1e-6, atol=1e-9)
    packs = df.repartition(3).select("u", "v", "w", F.col("y").cast("double").alias("_y")).mapInPandas(mlp._packer(["u", "v", "w"], got.centre, got.width, 250), "rows binary")
    assert sorted(len(r.rows) // 32 for r in packs.collect()) == [150] * 3 + [250] * 3
