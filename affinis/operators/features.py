"""Profile features: wide measurements, bands, specialty, diversity, profile text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.text import join_words, snake_token
from affinis.operators.cleaning import clean
from affinis.operators.ordering import cumulative_share, quantiles
from affinis.session import written
from affinis.spec import LIVESTOCK, ProfileSpec

Thresholds = Mapping[str, tuple[float, float] | None]


def observed_activities(measurements: DataFrame, spec: ProfileSpec = LIVESTOCK) -> list[str]:
    """Declared activities that occur in the measurements, in declared order."""
    found = measurements.select(spec.activity).filter(F.col(spec.activity).isin(*spec.activities)).distinct()
    return spec.observed({row[0] for row in found.collect()})


def widen(measurements: DataFrame, activities: Sequence[str] | None = None, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """One row per entity, one summed column per activity (sorted), missing as 0.

    Conditional sums rather than ``pivot``: one shuffle on the entity, with
    partial sums made before it.
    """
    if activities is None:
        activities = observed_activities(measurements, spec)
    return measurements.groupBy(spec.entity).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(spec.activity) == a, F.col(spec.value))), F.lit(0.0)).alias(a)
            for a in sorted(activities)
        ]
    )


def enrich(dimension: DataFrame, wide: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Every dimension row with its measurements; entities without any get 0."""
    added = [c for c in wide.columns if c != spec.entity]
    return dimension.join(wide, spec.entity, "left").na.fill(0.0, added).select(*dimension.columns, *added)


def lengthen(wide: DataFrame, activities: Sequence[str], spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Back to (entity, activity, value) rows."""
    pairs = F.array(*[F.struct(F.lit(a).alias(spec.activity), F.col(a).alias(spec.value)) for a in activities])
    return wide.select(spec.entity, F.inline(pairs))


def positive_quantiles(wide: DataFrame, activities: Sequence[str], spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Quantiles of the positive values per activity: (activity, share, quantile, n_rows)."""
    positive = lengthen(wide, activities, spec).filter(F.col(spec.value) > 0)
    return quantiles(positive, spec.activity, spec.value, spec.quantiles, [spec.entity])


def band_thresholds(wide: DataFrame, activities: Sequence[str], spec: ProfileSpec = LIVESTOCK) -> Thresholds:
    """The fitted band limits, two numbers per activity; None with too few positives."""
    limits: dict[str, tuple[float, float] | None] = dict.fromkeys(activities)
    found: dict[str, list[float]] = {}
    for row in positive_quantiles(wide, activities, spec).orderBy("share").collect():
        if row["n_rows"] >= spec.min_positives:
            found.setdefault(row[spec.activity], []).append(row["quantile"])
    for activity, pair in found.items():
        limits[activity] = (pair[0], pair[-1])
    return limits


def band(activity: str, limits: tuple[float, float] | None, spec: ProfileSpec = LIVESTOCK) -> Column:
    """The band word of one activity column."""
    value = F.col(activity)
    if limits is None:
        return F.when(value > 0, spec.present_word + activity).otherwise(spec.none_word + activity)
    return (
        F.when(value == 0, spec.none_word + activity)
        .when(value <= limits[0], spec.low_word + activity)
        .when(value <= limits[1], spec.mid_word + activity)
        .otherwise(spec.high_word + activity)
    )


def add_bands(wide: DataFrame, thresholds: Thresholds, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Band columns in declared order. The limits are literals, so this shuffles nothing."""
    return wide.select(
        "*", *[band(a, thresholds[a], spec).alias(spec.band_prefix + a) for a in spec.observed(thresholds)]
    )


def value_shares(wide: DataFrame, activities: Sequence[str], spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Percent rank of every value other than 0 within its activity, ties at their largest."""
    counted = lengthen(wide, activities, spec).filter(F.col(spec.value) != 0)
    return cumulative_share(counted, spec.activity, spec.value, [spec.entity])


def dominant(wide: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """(entity, activity) with the largest percent rank; ties go to the first declared."""
    main = [a for a in spec.main_activities if a in wide.columns]
    order = F.array_position(F.array(*[F.lit(a) for a in main]), F.col(spec.activity))
    best = F.max(F.struct(F.col("share"), (-order).alias("order"), F.col(spec.activity)))
    return (
        value_shares(wide, main, spec)
        .groupBy(spec.entity)
        .agg(best.alias("__best"))
        .select(spec.entity, F.col(f"__best.{spec.activity}").alias(spec.activity))
    )


def add_specialty(df: DataFrame, spec: ProfileSpec = LIVESTOCK, ranked: DataFrame | None = None) -> DataFrame:
    """Add the specialty word.

    The ranks are read several times from ``ranked``, the written wide table
    that ``df`` extends; by default from ``df`` itself.
    """
    main = [a for a in spec.main_activities if a in df.columns]
    if not main:
        return df.withColumn(spec.specialty, F.lit(spec.nothing_word))
    total = sum((F.col(a) for a in main), F.lit(0.0))
    named = F.concat(F.lit(spec.specialty_word), F.col(spec.activity))
    return (
        df.join(dominant(ranked or df, spec), spec.entity, "left")
        .withColumn(spec.specialty, F.when(total > 0, named).otherwise(F.lit(spec.nothing_word)))
        .select(*df.columns, spec.specialty)
    )


def add_diversity(wide: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Add the number and the list of activities with a positive value."""
    found = spec.observed(wide.columns)
    if not found:
        return wide.select("*", F.lit(0).cast("bigint").alias(spec.count), F.lit("").alias(spec.present))
    number = sum((F.when(F.col(a) > 0, 1).otherwise(0) for a in found), F.lit(0))
    names = F.concat_ws(" ", *[F.when(F.col(a) > 0, F.lit(a)) for a in found])
    return wide.select("*", number.cast("bigint").alias(spec.count), names.alias(spec.present))


def add_profile_text(df: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Add the profile text: context tokens, bands by column name, specialty, activities."""
    parts = [snake_token(F.col(c)) for c in spec.context if c in df.columns]
    parts += [F.col(c) for c in sorted(df.columns) if c.startswith(spec.band_prefix)]
    parts += [F.col(c) for c in (spec.specialty, spec.present) if c in df.columns]
    if not parts:
        raise ValueError("no column to build the profile text from: derive the features first")
    return df.withColumn(spec.text, join_words(*parts))


def build_features(
    raw: DataFrame,
    dimension: DataFrame,
    spec: ProfileSpec = LIVESTOCK,
    activities: Sequence[str] | None = None,
) -> DataFrame:
    """The feature table from raw measurements and the dimension.

    The joined wide table is written once: limits, ranks and the result all read
    it, and its sums must be the same numbers each time.
    """
    measured = clean(raw, spec)
    if activities is None:
        activities = observed_activities(measured, spec)
    wide = written(enrich(dimension, widen(measured, activities, spec), spec), "wide")
    banded = add_bands(wide, band_thresholds(wide, activities, spec), spec)
    described = add_diversity(add_specialty(banded, spec, ranked=wide), spec)
    return add_profile_text(described, spec)
