"""Top-k with exclusions and declared tie order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.session import shuffle_partitions

DEFAULT_K = 5


def check_k(k: int) -> None:
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")


def top_k(
    scores: DataFrame,
    k: int,
    score: str,
    ties: Sequence[str],
    by: Sequence[str] = (),
    largest: bool = True,
    exclude: Column | None = None,
) -> DataFrame:
    """The k best rows of each ``by`` group with their ``rank`` from 1.

    Equal scores go in the order of ``ties``. With groups Spark keeps only k
    rows per group and task before the shuffle (window group limit); without,
    it is a top-k scan. Beyond the k up to which Spark does so, each part of a group
    is ranked first and its k best go on. Either way no task sees a whole group.
    """
    check_k(k)
    if exclude is not None:
        scores = scores.filter(~exclude)
    order = [F.desc(score) if largest else F.asc(score), *ties]
    if not by:
        scores = scores.orderBy(*order).limit(k)
    elif k > int(scores.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = shuffle_partitions(scores.sparkSession)
        dealt = scores.withColumn("__part", F.pmod(F.xxhash64(*ties), F.lit(parts)))
        own = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
        scores = dealt.withColumn("__own", own).filter(F.col("__own") <= k).drop("__own", "__part")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scores.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= k)


def top_k_largest(scores: DataFrame, k: int = DEFAULT_K, score: str = "score", ties=("id",), by=(), exclude=None):
    return top_k(scores, k, score, ties, by, True, exclude)


def top_k_smallest(scores: DataFrame, k: int = DEFAULT_K, score: str = "distance", ties=("id",), by=(), exclude=None):
    return top_k(scores, k, score, ties, by, False, exclude)


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a hash of key and seed: the same rows for any partitioning."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key), F.lit(seed))), key).limit(n)
