"""Summaries of a feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.features import lengthen
from affinis.spec import LIVESTOCK, ProfileSpec


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n, pct) of each value; the total comes from the counts, not the rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", 100.0 * F.col("n") / total)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column.

    The exact form reads the table once: every (column, value) is made distinct
    before the shuffle, then counted by column.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    cells = [F.struct(F.lit(i).alias("at"), F.to_json(F.struct(F.col(c).alias("v"))).alias("v"), F.col(c).isNotNull().alias("some")) for i, c in enumerate(columns)]
    values = df.select(F.inline(F.array(*cells))).filter("some").select("at", "v").distinct()
    return values.agg(*[F.count_if(F.col("at") == i).alias(c) for i, c in enumerate(columns)])


def activity_totals(wide: DataFrame, activities: Sequence[str], spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """(activity, n_positive, total) over all entities."""
    return (
        lengthen(wide, activities, spec)
        .groupBy(spec.activity)
        .agg(F.count_if(F.col(spec.value) > 0).alias("n_positive"), F.sum(spec.value).alias("total"))
    )
