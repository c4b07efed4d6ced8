"""Request batches of a fixed size, and ordered key lists by parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.ordering import positions

# Fixed value: keys per batch.
BATCH_SIZE = 500
LIST_SIZE = 10_000


def assign_batches(df: DataFrame, key: str, size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch`` from 0: ``size`` keys each in key order, the last one smaller."""
    if size <= 0:
        raise ValueError(f"batch size must be positive, got {size}")
    return positions(df, [key]).withColumn("batch", F.floor(F.col("position") / size)).drop("position")


def key_lists(df: DataFrame, parent: str, key: str, list_size: int = LIST_SIZE) -> DataFrame:
    """Ordered keys of each parent: (parent, part, n_keys, keys); rows with a NULL are left out.

    A parent with up to ``list_size`` keys has one list; a larger one continues
    in further parts, so that no row or task holds an unbounded list.
    """
    numbered = positions(df.select(parent, key).dropna(), [key], [parent])
    return (
        numbered.withColumn("part", F.floor(F.col("position") / list_size))
        .groupBy(parent, "part")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.array_sort(F.collect_list(key)).alias("keys"))
    )
