"""Checks that report as DataFrames; strict variants raise."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shares of missing keys above which a load is bad, and keys shown.
ERROR_SHARE = 0.5
WARNING_SHARE = 0.02
SHOWN_KEYS = 10


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ``ValueError`` naming the missing and the found columns. Runs no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def missing_keys(requested: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Distinct requested keys that were not received."""
    return requested.select(key).distinct().join(received.select(key).distinct(), key, "left_anti")


def coverage(
    requested: DataFrame,
    received: DataFrame,
    key: str,
    warning_share: float = WARNING_SHARE,
    strict: bool = False,
) -> DataFrame:
    """One row: how many requested keys came, the status, and the smallest missing keys.

    A received table without the key column cannot be checked: status 'unchecked'.
    """
    if key not in received.columns:
        return requested.agg(
            F.countDistinct(key).alias("n_requested"),
            F.lit(None).cast("bigint").alias("n_received"),
            F.lit(None).cast("bigint").alias("n_missing"),
            F.lit(None).cast("double").alias("missing_fraction"),
            F.lit("unchecked").alias("status"),
            F.lit(None).cast("array<string>").alias("sample"),
        )
    # Both sides are reduced to distinct keys before the shuffle, so neither a
    # repeated key nor a large table can weigh on one task.
    sides = (
        requested.select(key).distinct().withColumn("__want", F.lit(1))
        .join(received.select(key).distinct().withColumn("__got", F.lit(1)), key, "full_outer")
    )
    lost = missing_keys(requested, received, key).orderBy(key).limit(SHOWN_KEYS)
    sample = lost.agg(F.array_sort(F.collect_list(key)).alias("s"))
    report = sides.agg(
        F.count("__want").alias("n_requested"),
        F.count("__got").alias("n_received"),
        F.count_if(F.col("__want").isNotNull() & F.col("__got").isNull()).alias("n_missing"),
    ).withColumn(
        "missing_fraction", F.col("n_missing") / F.greatest(F.col("n_requested"), F.lit(1))
    )
    report = report.withColumn(
        "status",
        F.when(F.col("missing_fraction") > ERROR_SHARE, "error")
        .when(F.col("missing_fraction") > warning_share, "warning")
        .otherwise("ok"),
    ).withColumn("sample", sample.scalar())
    if strict:
        row = report.first()
        if row["status"] == "error":
            raise RuntimeError(
                f"only {row['n_requested'] - row['n_missing']} of {row['n_requested']} keys were received"
            )
    return report


def consistency(features: DataFrame, vectors: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """One row: keys on either side, and keys that only one side has."""
    sides = (
        features.select(key).distinct().withColumn("__f", F.lit(1))
        .join(vectors.select(key).distinct().withColumn("__v", F.lit(1)), key, "full_outer")
    )
    report = sides.agg(
        F.count("__f").alias("n_features"),
        F.count("__v").alias("n_vectors"),
        F.count_if(F.col("__v").isNull()).alias("only_features"),
        F.count_if(F.col("__f").isNull()).alias("only_vectors"),
    )
    if strict:
        row = report.first()
        if row["only_features"] or row["only_vectors"]:
            raise ValueError(f"feature table and term vectors do not match: {row.asDict()}")
    return report


def unmapped_categories(df: DataFrame, category: str, mapped: Sequence[str], ignored: Sequence[str]) -> DataFrame:
    """Distinct categories that neither the mapping nor the ignore list names."""
    return df.select(category).filter(~F.col(category).isin(*mapped, *ignored)).distinct()
