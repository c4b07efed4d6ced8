"""Measures of a classifier's scores, and tables for uneven classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.ordering import running_total
from affinis.session import written


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: true and false positives and negatives, precision, recall, F1 and accuracy (NULL where undefined)."""

    def cell(actual: int, said: int):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == said))

    counts = df.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns(
        {
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
            "accuracy": F.try_divide(tp + tn, tp + fp + tn + fn),
        }
    )


def ranking(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: area under the ROC curve and average precision; equal scores count as one step.

    Rows are added up by score first; running totals over the scores are made in
    ranges, so no task sees all of them. NULL labels and scores take no part.
    """
    by_score = written(
        df.dropna(subset=[label, score])
        .groupBy(score)
        .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(1 - F.col(label).cast("bigint")).alias("neg")),
        "scores",
    )
    below = running_total(running_total(by_score, [score], "pos", "pos_below"), [score], "neg", "neg_below")
    totals = by_score.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    above_pos, above_neg = F.col("all_pos") - F.col("pos_below"), F.col("all_neg") - F.col("neg_below")
    return (
        below.join(F.broadcast(totals))  # one row
        .agg(
            F.max("all_pos").alias("n_positive"),
            F.max("all_neg").alias("n_negative"),
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("__wins"),
            F.sum(F.col("pos") * above_pos / (above_pos + above_neg)).alias("__hits"),
        )
        .select(
            "n_positive",
            "n_negative",
            F.try_divide(F.col("__wins"), F.col("n_positive").cast("double") * F.col("n_negative")).alias("roc_auc"),
            F.try_divide(F.col("__hits"), F.col("n_positive").cast("double")).alias("average_precision"),
        )
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): weights that give every class the same sum, with mean 1 over the rows."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    weight = F.col("rows") / (F.col("classes") * F.col("n"))
    return counts.join(F.broadcast(sizes)).select(label, "n", weight.alias("weight"))  # one row


def undersampled(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Rows of the smallest class, and of every other about as many, chosen by a hash of key and seed."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    least = counts.agg(F.min("__n").alias("__least"))
    share = F.col("__least") / F.col("__n")
    kept = counts.join(F.broadcast(least)).select(label, share.alias("__share"))  # one row; one for each class
    place = F.conv(F.left(F.md5(F.concat_ws(":", F.col(key), F.lit(seed))), F.lit(8)), 16, 10).cast("double") / float(1 << 32)
    return df.join(kept, label).filter((F.col("__share") == 1) | (place < F.col("__share"))).select(*df.columns)
