import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.functions import vectors as V
from affinis.operators import classifier as C
from affinis.operators import metrics
from affinis.operators import vocabulary as voc
from affinis.streaming import scoring

X = ["x1", "x2"]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(0.5, -1.0, 0), (1.5, 0.25, 1), (-0.75, 2.0, 0), (2.0, 1.0, 1), (0.0, 0.5, 1), (-1.25, -0.5, 0), (1.0, -2.0, 0)]
    return spark.createDataFrame(rows, "x1 double, x2 double, y bigint")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([(1, -0.5, 0.75), (2, 1.25, 0.5)], "id int, x1 double, x2 double")


def probabilities(model, df):
    return [r["probability"] for r in model.predict_proba(df).orderBy("id").collect()]


def test_sigmoid(spark):
    z = [-800.0, -3.5, -0.25, 0.0, 0.75, 4.0, 900.0]
    df = spark.createDataFrame(list(enumerate(z)), "i int, z double")
    got = [r[0] for r in df.orderBy("i").select(V.sigmoid(F.col("z"))).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-min(max(x, -700), 700))) for x in z], abs=1e-12)
    assert all(map(math.isfinite, got))


def test_cross_entropy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (1.0, 0.0), (1.0, 0.5)], "y double, p double")
    got = [r[0] for r in df.select(V.cross_entropy(F.col("y"), F.col("p"))).collect()]
    assert got[:2] == pytest.approx([0, 0], abs=1e-12)
    assert math.isfinite(got[2]) and got[2] > 30 and got[3] == pytest.approx(math.log(2))


def descended(small, rate, steps):
    """The steps written out with whole arrays."""
    rows = np.array([tuple(map(float, r)) for r in small.collect()])
    x, y, w, b, losses = rows[:, :2], rows[:, 2], np.zeros(2), 0.0, []
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        losses.append(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
        w, b = w - rate * x.T @ (p - y) / len(y), b - rate * np.mean(p - y)
    return w, b, losses


@pytest.mark.parametrize(("rate", "steps"), [(0.01, 1), (0.01, 3), (0.3, 40)])
def test_against_numpy(small, asked, rate, steps):
    w, b, losses = descended(small, rate, steps)
    model = C.GradientDescent(learning_rate=rate, iterations=steps, tolerance=0).fit(small, X, "y")
    assert model.losses == pytest.approx(losses) and not model.converged
    assert model.weights == pytest.approx(w) and model.bias == pytest.approx(b)
    points = np.array([(r["x1"], r["x2"]) for r in asked.orderBy("id").collect()])
    assert probabilities(model, asked) == pytest.approx(1 / (1 + np.exp(-(points @ w + b))))


def test_default_thousand_steps(small, asked):
    w, b, losses = descended(small, 0.01, 1000)
    model = C.GradientDescent(tolerance=0).fit(small.coalesce(1), X, "y")
    assert model.iterations_run == 1000 and not model.converged
    assert model.weights == pytest.approx(w) and model.bias == pytest.approx(b)
    assert model.losses[-1] == pytest.approx(losses[-1])


def test_early_stop_and_history(spark, small):
    losses = descended(small, 0.05, 200)[2]
    steps = next(i for i in range(1, 200) if abs(losses[i] - losses[i - 1]) < 1e-3) + 1
    model = C.GradientDescent(learning_rate=0.05, tolerance=1e-3).fit(small, X, "y")
    assert model.iterations_run == steps and model.converged
    history = model.history(spark).orderBy("iteration").collect()
    assert [r["iteration"] for r in history] == list(range(steps))
    assert all(a["loss"] > b["loss"] for a, b in zip(history, history[1:], strict=False))


def test_repeatable(small):
    settings = C.GradientDescent(iterations=5)
    assert settings.fit(small, X, "y") == settings.fit(small, X, "y")


def test_many_partitions_add_up_the_same(small, monkeypatch):
    data = small.select(F.col("x1").alias("x0"), F.col("x2").alias("x1"), F.col("y").cast("double").alias("y")).repartition(7)
    direct = C.gradient_step(data, np.array([0.1, -0.2]), 0.3, many_partitions=False)
    monkeypatch.setattr(C, "PARTIALS_PER_STEP", 3)
    stepped = C.gradient_step(data, np.array([0.1, -0.2]), 0.3, many_partitions=True)
    assert stepped[0] == pytest.approx(direct[0]) and stepped[1] == pytest.approx(direct[1])


def test_threshold(small, asked):
    model = C.GradientDescent(iterations=3).fit(small, X, "y")
    low, high = sorted(probabilities(model, asked))
    counts = [model.predict(asked, t).agg(F.sum("prediction")).first()[0] for t in (low / 2, (low + high) / 2, high)]
    assert counts == [2, 1, 0]
    even = C.DescentModel(("x1",), (0.0,), 0.0, (), False)
    row = even.predict(asked).schema["prediction"].dataType.simpleString(), even.predict(asked).first()["prediction"]
    assert row == ("bigint", 0)  # exactly 0.5 is not above 0.5


def test_separates_two_clouds(spark):
    rng = np.random.default_rng(42)
    points = np.vstack([rng.normal((-2, -2), 0.5, (50, 2)), rng.normal((2, 2), 0.5, (50, 2))])
    rows = [(i, float(a), float(b), int(i >= 50)) for i, (a, b) in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, y int")
    model = C.GradientDescent(learning_rate=0.5, iterations=30).fit(df, X, "y")
    assert model.predict(df).filter("prediction = y").count() >= 99


@pytest.mark.parametrize("bad", [{"learning_rate": 0}, {"iterations": 0}, {"tolerance": -1}])
def test_settings(bad):
    with pytest.raises(ValueError):
        C.GradientDescent(**bad)
    assert C.GradientDescent().get_params() == {"learning_rate": 0.01, "iterations": 1000, "tolerance": 1e-6}


def test_inputs(spark, small):
    fit = C.GradientDescent(iterations=1).fit
    with pytest.raises(ValueError, match="missing feature"):
        fit(small, ["nope"], "y")
    with pytest.raises(ValueError, match="not numeric"):
        fit(small.withColumn("s", F.lit("a")), ["s"], "y")
    with pytest.raises(ValueError, match="missing values"):
        fit(small.withColumn("x1", F.when(F.col("x1") > 1, F.col("x1"))), X, "y")
    with pytest.raises(ValueError, match="no rows"):
        fit(small.limit(0), X, "y")


def test_metrics_against_every_pair(spark):
    rows = [(i, (i * 7) % 13, int((i * 5) % 11 < 4), int((i * 7) % 13 > 6)) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, score int, label int, said int")
    pos, neg = ([r[1] for r in rows if r[2] == kind] for kind in (1, 0))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    steps = sorted(set(pos + neg), reverse=True)
    precision = [sum(p >= s for p in pos) / sum(x >= s for x in pos + neg) for s in steps]
    hits = sum(pos.count(s) * q for s, q in zip(steps, precision, strict=True)) / len(pos)
    row = metrics.ranking(df, "label", "score").first()
    assert (row["roc_auc"], row["average_precision"]) == pytest.approx((wins, hits))
    cells = metrics.confusion(df, "label", "said").first()
    assert (cells["tp"], cells["fp"]) == (sum(p > 6 for p in pos), sum(n > 6 for n in neg))
    assert metrics.confusion(df.limit(0), "label", "said").first()["f1"] is None
    few = metrics.undersampled(df, "label", "id")
    assert few.filter("label = 1").count() == len(pos) and few.filter("label = 0").count() < len(neg)
    weights = {r["label"]: r["weight"] for r in metrics.class_weights(df, "label").collect()}
    assert weights[1] * len(pos) == pytest.approx(weights[0] * len(neg)) == pytest.approx(45)


# -- streams ------------------------------------------------------------------------


def test_scored_stream(spark, small, asked, tmp_path):
    model = C.GradientDescent(iterations=3).fit(small, X, "y")
    asked.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    scoring.run_to_table(scoring.scored(stream, model, sum(probabilities(model, asked)) / 2), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [r["probability"] for r in got] == pytest.approx(probabilities(model, asked))
    assert [r["prediction"] for r in got] == [0, 1]


def test_known_tokens_of_a_stream(spark, tmp_path):
    fit = spark.createDataFrame([(1, "upland ua"), (2, "lowland ub")], "id int, text string")
    vocabulary = voc.fit_vocabulary(voc.token_counts(fit, "id", "text")).cache()
    spark.createDataFrame([(7, "UB upland uc"), (8, None)], "id int, text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, text string").parquet(str(tmp_path / "in"))
    found = scoring.known_tokens(stream, vocabulary, "id", "text")
    scoring.run_to_table(found, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {(r["id"], r["token"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(7, "ub"), (7, "upland")}


def test_weighted_fit(spark, small):
    """Weights of one change nothing, and a weight of two is two rows."""
    settings = C.GradientDescent(0.3, 25, 0.0)
    rows = small.withColumn("n", (F.monotonically_increasing_id() % 3).cast("int"))
    plain = settings.fit(small, X, "y")
    assert settings.fit(small.withColumn("one", F.lit(1)), X, "y", "one") == plain
    weighted = settings.fit(rows, X, "y", "n")
    repeated = settings.fit(rows.withColumn("n", F.explode(F.expr("array_repeat(1, n)"))), X, "y")
    assert (*weighted.weights, weighted.bias, *weighted.losses) == pytest.approx((*repeated.weights, repeated.bias, *repeated.losses))
    for bad in (F.lit(0), F.lit(-1), F.lit(None).cast("double")):
        with pytest.raises(ValueError):
            settings.fit(small.withColumn("w", bad), X, "y", "w")
