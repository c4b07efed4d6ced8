"""From raw survey text rows to typed measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.text import marked_number, normalise_text
from affinis.operators.quality import require_columns, unmapped_categories
from affinis.spec import LIVESTOCK, ProfileSpec


def renamed(raw: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Keep the columns the profile needs, under readable names."""
    require_columns(raw, spec.raw_columns)
    return raw.select([F.col(old).alias(new) for old, new in spec.raw_columns.items()])


def _categorised(raw: DataFrame, spec: ProfileSpec) -> DataFrame:
    entity, label, period, _, category, value = spec.raw_columns.values()
    return renamed(raw, spec).select(
        F.col(entity).alias("__entity"),
        F.col(period).alias("__period"),
        normalise_text(F.col(category)).alias("__category"),
        normalise_text(F.col(value)).alias("__value"),
    )


def clean(raw: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Typed long rows (entity, period, activity, value): one pass, no shuffle.

    Ignored and unmapped categories are dropped; a key or period that is no
    whole number is an error; value marks become 0 or NULL.
    """
    activity = F.lit(None).cast("string")
    for category, name in spec.category_map.items():
        activity = F.when(F.col("__category") == category, name).otherwise(activity)
    return (
        _categorised(raw, spec)
        .filter(F.col("__category").isin(*(c for c in spec.category_map if c not in spec.ignored_categories)))
        .select(
            F.col("__entity").cast("bigint").alias(spec.entity),
            F.col("__period").cast("bigint").alias(spec.period),
            activity.alias(spec.activity),
            marked_number(F.col("__value"), spec.zero_marks, spec.null_marks).alias(spec.value),
        )
    )


def unmapped(raw: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Distinct raw categories that :func:`clean` drops because nothing maps them."""
    rows = _categorised(raw, spec).select(F.col("__category").alias("category"))
    return unmapped_categories(rows, "category", list(spec.category_map), list(spec.ignored_categories))
