"""Queries on the binary classifier: was a line item returned?"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from affinis.functions.vectors import cross_entropy, sigmoid
from affinis.operators import metrics
from affinis.operators.classifier import GradientDescent, gradient_step
from affinis.operators.estimator import DescentClassifier
from affinis.plans.registry import query, table
from affinis.session import scratch_path
from affinis.streaming import scoring

FEATURES = ["quantity", "discount", "tax"]
STEPS, RATE = 3, 0.5


def items(spark, sf, lines=None):
    """Line items as scaled features and a 0/1 label."""
    return (table(spark, sf, "lineitem") if lines is None else lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_quantity") / 50).alias("quantity"), (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_tax") * 10).alias("tax"), (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def fitted(spark, sf, **settings):
    return GradientDescent(**{"learning_rate": RATE, "iterations": STEPS, "tolerance": 0.0} | settings).fit(
        items(spark, sf), FEATURES, "label"
    )


def _sql_fit(steps: int, weight: str = "1") -> str:
    """The descent written out: one pair of tables per step; ``weight`` is an expression on y."""
    parts = [
        f"""x AS MATERIALIZED (SELECT *, CAST({weight} AS DOUBLE) AS w FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50 AS quantity,
        l_discount * 10 AS discount, l_tax * 10 AS tax, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem))""",
        "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, 0.0::DOUBLE AS d)",
    ]
    for i in range(steps):
        parts.append(
            f"""g{i} AS MATERIALIZED (SELECT sum(w * (p - y) * quantity) / sum(w) AS ga, sum(w * (p - y) * discount) / sum(w) AS gb,
            sum(w * (p - y) * tax) / sum(w) AS gc, sum(w * (p - y)) / sum(w) AS gd, sum(-w * (y * ln(p) + (1 - y) * ln(1 - p))) / sum(w) AS loss
            FROM (SELECT x.*, 1 / (1 + exp(-(d + a * quantity + b * discount + c * tax))) AS p FROM x CROSS JOIN w{i}))"""
        )
        parts.append(
            f"""w{i + 1} AS MATERIALIZED (SELECT a - {RATE} * ga AS a, b - {RATE} * gb AS b, c - {RATE} * gc AS c,
            d - {RATE} * gd AS d FROM w{i} CROSS JOIN g{i})"""
        )
    return ", ".join(parts)


@query(
    "sigmoid_values",
    """SELECT o_orderkey, round(1 / (1 + exp(-(o_totalprice - 250000) / 50000)), 9) AS p FROM orders""",
)
def sigmoid_values(spark, sf):
    z = (F.col("o_totalprice") - 250000) / 50000
    return table(spark, sf, "orders").select("o_orderkey", F.round(sigmoid(z), 9).alias("p"))


@query(
    "mean_cross_entropy",
    """SELECT l_linestatus, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS loss FROM (SELECT l_linestatus,
    CAST(l_returnflag = 'R' AS INT) AS y, least(greatest(l_discount * 10, 1e-15), 1 - 1e-15) AS p FROM lineitem)
    GROUP BY l_linestatus""",
)
def mean_cross_entropy(spark, sf):
    loss = cross_entropy((F.col("l_returnflag") == "R").cast("int"), F.col("l_discount") * 10)
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.round(F.avg(loss), 6).alias("loss"))


@query(
    "gradient_step",
    f"""WITH {_sql_fit(1)} SELECT round(ga, 9) AS quantity, round(gb, 9) AS discount, round(gc, 9) AS tax,
    round(gd, 9) AS bias, round(loss, 9) AS loss FROM g0""",
)
def gradient_step_query(spark, sf):
    inputs = [F.col(c).alias(f"x{j}") for j, c in enumerate(FEATURES)]
    data = items(spark, sf).select(*inputs, F.col("label").cast("double").alias("y"))
    gradient, loss = gradient_step(data, np.zeros(len(FEATURES)), 0.0)
    row = [round(float(v), 9) for v in [*gradient, loss]]
    return spark.createDataFrame([row], "quantity double, discount double, tax double, bias double, loss double")


@query(
    "training_history",
    f"WITH {_sql_fit(STEPS)} "
    + " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS iteration, round(loss, 9) AS loss FROM g{i}" for i in range(STEPS)),
)
def training_history(spark, sf):
    return fitted(spark, sf).history(spark).withColumn("loss", F.round("loss", 9))


@query(
    "fitted_weights",
    f"""WITH {_sql_fit(STEPS)} SELECT round(a, 9) AS quantity, round(b, 9) AS discount, round(c, 9) AS tax,
    round(d, 9) AS bias FROM w{STEPS}""",
)
def fitted_weights(spark, sf):
    model = fitted(spark, sf)
    row = [round(v, 9) for v in (*model.weights, model.bias)]
    return spark.createDataFrame([row], "quantity double, discount double, tax double, bias double")


SQL_BALANCE = "CASE y WHEN 1 THEN (SELECT count(*) / (2.0 * count(*) FILTER (l_returnflag = 'R')) FROM lineitem) ELSE (SELECT count(*) / (2.0 * count(*) FILTER (l_returnflag <> 'R')) FROM lineitem) END"


@query(
    "weighted_fit",
    f"""WITH {_sql_fit(STEPS, SQL_BALANCE)} SELECT round(a, 9) AS quantity, round(b, 9) AS discount, round(c, 9) AS tax,
    round(d, 9) AS bias, round((SELECT loss FROM g{STEPS - 1}), 9) AS loss FROM w{STEPS}""",
)
def weighted_fit(spark, sf):
    """A fit on uneven classes: each class has the same sum of weights."""
    rows = items(spark, sf)
    weights = metrics.class_weights(rows, "label").select("label", "weight")
    settings = GradientDescent(learning_rate=RATE, iterations=STEPS, tolerance=0.0)
    model = settings.fit(rows.join(F.broadcast(weights), "label"), FEATURES, "label", "weight")  # two rows
    row = [round(v, 9) for v in (*model.weights, model.bias, model.losses[-1])]
    return spark.createDataFrame([row], "quantity double, discount double, tax double, bias double, loss double")


SQL_SCORED = f"""{_sql_fit(STEPS)}, scored AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  1 / (1 + exp(-(d + a * quantity + b * discount + c * tax))) AS p FROM x CROSS JOIN w{STEPS})"""
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "class_probabilities",
    f"WITH {SQL_SCORED} SELECT {', '.join(KEYS)}, round(p, 6) AS probability FROM scored",
)
def class_probabilities(spark, sf):
    return fitted(spark, sf).predict_proba(items(spark, sf)).select(*KEYS, F.round("probability", 6).alias("probability"))


@query(
    "predicted_classes",
    f"WITH {SQL_SCORED} SELECT {', '.join(KEYS)}, CAST(p > 0.35 AS BIGINT) AS prediction FROM scored",
)
def predicted_classes(spark, sf):
    return fitted(spark, sf).predict(items(spark, sf), 0.35).select(*KEYS, "prediction")


@query(
    "pipeline_saved",
    f"WITH {SQL_SCORED} SELECT {', '.join(KEYS)}, round(p, 6) AS probability, CAST(p > 0.35 AS BIGINT) AS prediction FROM scored",
)
def pipeline_saved(spark, sf):
    """The classifier as a stage of an ML pipeline, fitted, saved, loaded and asked."""
    rows, path = items(spark, sf), scratch_path(spark, "pipeline")
    stage = DescentClassifier(inputCols=FEATURES, learningRate=RATE, iterations=STEPS, tolerance=0.0, threshold=0.35)
    Pipeline(stages=[stage]).fit(rows).write().overwrite().save(path)
    return PipelineModel.load(path).transform(rows).select(*KEYS, F.round("probability", 6).alias("probability"), "prediction")


@query(
    "streamed_scores",
    f"WITH {SQL_SCORED} SELECT {', '.join(KEYS)}, round(p, 6) AS probability, CAST(p > 0.35 AS BIGINT) AS prediction FROM scored",
)
def streamed_scores(spark, sf):
    """Line items as a stream, scored by the fitted model, run twice from one checkpoint."""
    stream = items(spark, sf, scoring.stream_of(spark, f"{sf}/lineitem.parquet"))
    found = scoring.landed(scoring.scored(stream, fitted(spark, sf), 0.35), "streamed-scores")
    return found.select(*KEYS, F.round("probability", 6).alias("probability"), "prediction")


@query("converged_fit")
def converged_fit(spark, sf):
    """A fit that stops early (the number of steps depends on the data, so no fixed SQL)."""
    model = fitted(spark, sf, iterations=200, tolerance=1e-4)
    row = (model.iterations_run, model.converged, round(model.losses[-1], 6))
    return spark.createDataFrame([row], "iterations_run bigint, converged boolean, loss double")


SQL_LABELLED = """labelled AS (SELECT doc_id, n_chars % 997 AS score, toxic AS label, CAST(n_chars % 997 > 500 AS INTEGER) AS said
  FROM documents JOIN labels USING (doc_id))"""


def labelled(spark, sf):
    """Labelled documents with a score and a prediction made from their length."""
    score = F.col("n_chars") % 997
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return both.select("doc_id", score.alias("score"), F.col("toxic").alias("label"), (score > 500).cast("int").alias("said"))


@query(
    "confusion_matrix",
    f"""WITH {SQL_LABELLED}, c AS (SELECT count(*) FILTER (label = 1 AND said = 1) AS tp, count(*) FILTER (label = 0 AND said = 1) AS fp,
    count(*) FILTER (label = 0 AND said = 0) AS tn, count(*) FILTER (label = 1 AND said = 0) AS fn FROM labelled)
    SELECT *, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
    round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round((tp + tn) / (tp + fp + tn + fn), 9) AS accuracy FROM c""",
)
def confusion_matrix(spark, sf):
    return metrics.confusion(labelled(spark, sf), "label", "said").withColumns(
        {c: F.round(c, 9) for c in ("precision", "recall", "f1", "accuracy")}
    )


@query(
    "ranking_metrics",
    f"""WITH {SQL_LABELLED}, s AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM labelled GROUP BY score),
    b AS (SELECT *, coalesce(sum(pos) OVER before, 0) AS pos_below, coalesce(sum(neg) OVER before, 0) AS neg_below,
      sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM s WINDOW before AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT CAST(max(p) AS BIGINT) AS n_positive, CAST(max(n) AS BIGINT) AS n_negative,
      round(CAST(sum(pos * (neg_below + neg / 2)) / (max(p) * max(n)) AS DOUBLE), 9) AS roc_auc,
      round(CAST(sum(pos * (p - pos_below) / (p - pos_below + n - neg_below)) / max(p) AS DOUBLE), 9) AS average_precision FROM b""",
)
def ranking_metrics(spark, sf):
    return metrics.ranking(labelled(spark, sf), "label", "score").withColumns(
        {c: F.round(c, 9) for c in ("roc_auc", "average_precision")}
    )


@query(
    "class_weights",
    f"""WITH {SQL_LABELLED} SELECT label, count(*) AS n,
    round((SELECT count(*) FROM labelled) / (2.0 * count(*)), 9) AS weight FROM labelled GROUP BY label""",
)
def class_weights(spark, sf):
    return metrics.class_weights(labelled(spark, sf), "label").withColumn("weight", F.round("weight", 9))


@query(
    "undersampled_classes",
    f"""WITH {SQL_LABELLED}, c AS (SELECT label, count(*) AS n, min(count(*)) OVER () AS least FROM labelled GROUP BY label)
    SELECT doc_id, label FROM labelled JOIN c USING (label)
    WHERE n = least OR CAST('0x' || left(md5(doc_id || ':42'), 8) AS BIGINT) / 4294967296.0 < least::DOUBLE / n""",
)
def undersampled_classes(spark, sf):
    return metrics.undersampled(labelled(spark, sf), "label", "doc_id").select("doc_id", "label")
