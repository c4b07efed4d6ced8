import random
import zlib

import numpy as np
import pytest
from helpers import docs_of, prose
from pyspark.sql import functions as F

from affinis.llm import toxicity as tox


@pytest.mark.parametrize(
    ("letters", "marks"),
    [
        ([tox.INSULT], [tox.PLAIN]),
        ([tox.TARGET, tox.OTHER, tox.INSULT], ["other", "other", tox.AIMED]),
        ([tox.NEGATION, tox.OTHER, tox.INSULT], ["other", "other", tox.NEGATED]),
        ([tox.NEGATION, *[tox.OTHER] * 4, tox.INSULT], ["other"] * 5 + [tox.PLAIN]),
        ([tox.REPORT, *[tox.OTHER] * 9, tox.NEGATION, tox.INSULT], ["other"] * 11 + [tox.REPORTED]),
        ([tox.THREAT], ["other"]),
        ([tox.TARGET, tox.THREAT], ["other", tox.THREAT]),
        ([], []),
    ],
)
def test_grammar(letters, marks):
    assert [m for m, _ in tox.GRAMMAR.run(letters)] == marks


def test_composition_equals_running_one_after_another():
    letters = list(tox.CLASSES)
    first = tox.marking(tox.REPORT, tox.INSULT, tox.REPORTED, None, letters)
    second = tox.marking(tox.NEGATION, tox.INSULT, tox.NEGATED, 2, [*letters, tox.REPORTED])
    both = tox.compose(first, second)
    rng = random.Random(1)
    for _ in range(200):
        word = [rng.choice(letters) for _ in range(rng.randrange(9))]
        assert [m for m, _ in both.run(word)] == [m for m, _ in second.run([m for m, _ in first.run(word)])]


def planted(spark, n=1_500):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        words = prose(rng, 40).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpfish", "zorgblat", f"quax{rng.choice('aeiou')}{rng.choice('bdfgk')}"]))
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    return docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = planted(spark)
    model = tox.fit(docs, labels)
    rows = tox.scored(docs, model).join(labels, "doc_id").withColumn("held_out", tox.held_out()).filter("held_out").withColumn("predicted", tox.predicted()).collect()
    assert len(rows) > 300
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97
    assert {r.doc_id for r in rows} == {i for i in range(1_500) if zlib.crc32(str(i).encode()) % 3 == 1}


def test_held_out_labels_are_not_learned(spark):
    docs, labels = planted(spark, 600)
    flipped = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tox.fit(docs, labels) == tox.fit(docs, flipped)


def test_without_labels_or_rows(spark):
    docs, labels = planted(spark, 30)
    model = tox.fit(docs, labels.limit(0))
    assert model.lexicon == {} and {round(r.score, 3) for r in tox.scored(docs, model).collect()} == {0.0}
    assert tox.scored(docs.limit(0), model).count() == 0
    assert tox.without_toxic(docs.limit(0), labels.limit(0)).count() == 0
    nothing = tox.fit(docs, spark.createDataFrame([(None, 1, None), (3, None, None)], labels.schema))
    assert nothing.lexicon == {}


def test_nulls_empty_and_extra_columns(spark):
    docs, labels = planted(spark)
    model = tox.fit(docs, labels)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "zorgblat " * 40_000, 3), (1, "zorgblat " * 40_000, 3)], "doc_id long, text string, score int")
    got = sorted((r.doc_id or 0, round(r.score, 3), r.score >= 0.7) for r in tox.scored(odd, model).collect())
    assert got[0][1] == got[1][1] < 0.2 and got[2] == got[3] and got[2][2]
    left = tox.without_toxic(docs, labels)
    assert left.columns == docs.columns and 1_000 < left.count() < 1_250


def test_beginnings_that_harmless_texts_hold_by_chance(spark):
    """A beginning that stands often in short toxic texts is learned although long harmless ones have it now and then."""
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(900):
        toxic = int(i % 6 == 0)
        words = prose(rng, 30 if toxic else 300).split()
        for _ in range(5 if toxic else int(rng.random() < 0.3)):
            words.insert(rng.randrange(len(words)), "zorgb" + prose(rng, 1))
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    docs, labels = docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tox.fit(docs, labels)
    assert "zorgb*" in model.lexicon
    rows = tox.scored(docs, model).join(labels, "doc_id").filter(tox.held_out()).withColumn("predicted", tox.predicted()).collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.97


def test_copies_of_one_text_teach_no_words(spark):
    rng = random.Random(5)
    odd = prose(rng, 30) + " plimwick " + prose(rng, 30)
    texts = [odd] * 60 + [prose(rng, 60) for _ in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i < 60)) for i in range(360)], "doc_id long, quality int, toxic int")
    assert tox.fit(docs_of(spark, texts), labels).lexicon == {}


def test_rising_weights():
    rng = np.random.default_rng(3)
    x = rng.random((400, 3))
    y = (x[:, 0] - x[:, 1] - x[:, 2] + rng.normal(0, 0.2, 400) > 0).astype(float)
    weights = tox.rising(x, y, 2)
    assert weights[0] > 0 and weights[1] == 0 and weights[2] < 0


def test_aimed_weighs_no_less_than_plain_and_negated():
    lexicon, weights = {"zorgblat": 4.0}, [1.0, 0.5, 0.25, 0.5, 0.5, -0.5, -3.0]
    scores = [tox.Model(lexicon, weights).score(tox.Lexicon(lexicon).marks(t)) for t in ("so not zorgblat", "so so zorgblat", "so you zorgblat")]
    assert scores == sorted(scores) and len(set(scores)) == 3
