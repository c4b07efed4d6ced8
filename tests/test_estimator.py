import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from affinis.operators import estimator as E
from affinis.operators import vocabulary as voc
from affinis.operators.classifier import GradientDescent
from affinis.sources import landing

X = ["x1", "x2"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, (i * 7 % 11) / 5 - 1.0, (i * 3 % 7) / 4, int((i * 7 % 11) + (i * 3 % 7) > 8), 1 + i % 3) for i in range(60)]
    return spark.createDataFrame(data, "id int, x1 double, x2 double, y int, w int")


def answers(df):
    return [(r["id"], r["probability"], r["prediction"]) for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("weight", [None, "w"])
def test_same_as_the_plain_fit_and_after_loading(spark, rows, tmp_path, weight):
    plain = GradientDescent(0.4, 12, 0.0).fit(rows, X, "y", weight)
    given = {"weightCol": weight} if weight else {}
    stage = E.DescentClassifier(inputCols=X, labelCol="y", learningRate=0.4, iterations=12, tolerance=0.0, threshold=0.45, **given)
    stage.save(str(tmp_path / "stage"))
    again = E.DescentClassifier.load(str(tmp_path / "stage"))
    assert {p.name: v for p, v in again.extractParamMap().items()} == {p.name: v for p, v in stage.extractParamMap().items()}
    fitted = Pipeline(stages=[again]).fit(rows)
    assert fitted.stages[0].fitted == plain
    fitted.save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    assert loaded.stages[0].fitted == plain
    want = answers(plain.predict(plain.predict_proba(rows), 0.45))
    assert answers(loaded.transform(rows)) == answers(fitted.transform(rows)) == want and {w[2] for w in want} == {0, 1}


def test_settings_are_checked(rows):
    for bad in ({"learningRate": 0.0}, {"iterations": 0}, {"tolerance": -1e-9}, {"threshold": 1.5}):
        with pytest.raises(ValueError):
            E.DescentClassifier(inputCols=X, **bad)
    stage = E.DescentClassifier(inputCols=X, labelCol="y", iterations=2)
    assert (stage.getOrDefault("learningRate"), stage.getOrDefault("threshold")) == (0.01, 0.5)
    assert stage.copy({stage.iterations: 5}).fit(rows).fitted.iterations_run == 5
    with pytest.raises(ValueError, match="missing feature column"):
        E.DescentClassifier(inputCols=["nowhere"], labelCol="y").fit(rows)


def test_vectoriser_counts_like_term_vectors(spark, tmp_path, monkeypatch):
    texts = spark.createDataFrame([(1, "upland ua ua"), (2, "lowland ub, upland"), (3, None), (4, "")], "id int, text string")
    counts = voc.token_counts(texts, "id", "text")
    vocabulary = voc.fit_vocabulary(counts, max_features=3).cache()
    landing.save_vectoriser(E.vectoriser(vocabulary), str(tmp_path / "model"))
    model = landing.load_vectoriser(str(tmp_path / "model"))
    got = E.ml_vectors(voc.count_vectors(counts, "id"), model).select("id", vector_to_array("counts").alias("v")).collect()
    places = {r["token"]: r["idx"] for r in vocabulary.collect()}
    want = {i: [0.0] * 3 for i in (1, 2, 3, 4)}
    for r in counts.filter(F.col("token").isin(*places)).collect():
        want[r["id"]][places[r["token"]]] = float(r["cnt"])
    assert {r["id"]: r["v"] for r in got} == want and want[1] != want[2]
    with pytest.raises(ValueError, match="empty vocabulary"):
        E.vectoriser(vocabulary.limit(0))
    monkeypatch.setattr(E, "MOST_TERMS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        E.vectoriser(vocabulary)
