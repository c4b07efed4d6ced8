"""Exact positions, shares and quantiles without putting a group into one task.

A plain window orders each group in one task, and a group may hold most rows.
Here the key (group, value) is cut into ranges by split points taken from a
sample of rows. Every split value is a range of its own, so a value that fills a
third of the rows sits alone in a range that needs no sorting; the open ranges
between are of about equal size. Only counts per range are added up across
ranges. The sample decides how even the ranges are, never the result.

``df`` is read several times by these functions: pass a written table when it is
dear to compute.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.session import shuffle_partitions

SAMPLE_PER_RANGE = 20
RANGE, SALT = "__range", "__salt"


def split_points(df: DataFrame, key: Sequence[str], spread: Sequence[str], ranges: int | None = None) -> list:
    """At most ``ranges`` - 1 increasing keys from a sample of rows drawn by hash.

    ``spread`` are the columns to hash, best a unique key. A count tells which share
    of the hashes gives about the sample wanted, so what the tasks send to the driver
    depends on ``ranges`` alone, not on the number of partitions. No rows are returned
    for an input smaller than the sample: one range will do.
    """
    ranges = ranges or shuffle_partitions(df.sparkSession)
    want = ranges * SAMPLE_PER_RANGE
    whole = df.dropna(subset=list(key))
    total = whole.count()
    if total < want:
        return []
    drawn = whole.filter(F.pmod(F.xxhash64(*spread), F.lit(total // want)) == 0).select(*key).collect()
    if not drawn:  # equal hashes throughout: one value fills the table
        return []
    drawn.sort()
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)})


def in_ranges(df: DataFrame, key: Sequence[str], splits: list) -> DataFrame:
    """Add the range number: odd for a row equal to a split, even between splits."""
    if not splits:
        return df.withColumn(RANGE, F.lit(0))
    schema = T.ArrayType(df.select(*key).schema)
    as_text = json.dumps([row.asDict() for row in splits], default=str)
    points = F.from_json(F.lit(as_text), schema)  # folded to one literal
    steps = [1 << b for b in range(len(splits).bit_length() - 1, -1, -1)]
    row_key = F.struct(*key)
    at_or_above = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(points, at + step - 1) < row_key, at + step).otherwise(at),
        lambda at: 2 * at + F.coalesce((F.get(points, at) == row_key).cast("int"), F.lit(0)),
    )
    return df.withColumn(RANGE, F.coalesce(at_or_above, F.lit(0)))


def _range_counts(ranged: DataFrame, groups: Sequence[str], weight: Column | None = None) -> DataFrame:
    """Rows per (group, range), rows of the group before the range, rows of the group.

    At most (number of groups + number of ranges) rows, as a range covers one
    stretch of the ordered groups.
    """
    counts = ranged.groupBy(*groups, RANGE).agg(F.sum(F.lit(1) if weight is None else weight).alias("__n"))
    if not groups:
        counts = counts.withColumn("__all", F.lit(0))
    within = Window.partitionBy(*(groups or ["__all"]))
    ordered = within.orderBy(RANGE)
    return counts.select(
        *groups,
        RANGE,
        F.col("__n"),
        (F.sum("__n").over(ordered) - F.col("__n")).alias("__before"),
        F.sum("__n").over(within).alias("__total"),
    )


def positions(
    df: DataFrame,
    order: Sequence[str],
    groups: Sequence[str] = (),
    name: str = "position",
    ranges: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 0 in the order of a unique key. Groups are not NULL."""
    groups, order = list(groups), list(order)
    key = groups + order
    splits = split_points(df, key, key, ranges)
    ranged = in_ranges(df, key, splits)
    if splits:
        return positions_in_ranges(ranged, order, groups, name)
    local = Window.partitionBy(*groups, RANGE).orderBy(*order)
    return ranged.withColumn(name, F.row_number().over(local).cast("bigint") - 1).drop(RANGE)


def positions_in_ranges(ranged: DataFrame, order: Sequence[str], groups: Sequence[str] = (), name: str = "position") -> DataFrame:
    """:func:`positions` of rows whose ``RANGE`` is known; within a group it never falls along the order."""
    local = Window.partitionBy(*groups, RANGE).orderBy(*order)
    numbered = ranged.withColumn(name, F.row_number().over(local).cast("bigint") - 1)
    before = _range_counts(ranged, groups).select(*groups, RANGE, "__before")
    if not groups:
        before = F.broadcast(before)  # one row per range
    return (
        numbered.join(before, [*groups, RANGE])
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop(RANGE, "__before")
    )


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows that come before in the order of a unique key."""
    order = list(order)
    ranged = in_ranges(df, order, split_points(df, order, order, ranges))
    local = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(_range_counts(ranged, [], F.col(value)).select(RANGE, "__before"))  # one row per range
    summed = F.coalesce(F.sum(value).over(local), F.lit(0))
    return (
        ranged.withColumn(name, summed)
        .join(before, RANGE)
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop(RANGE, "__before")
    )


def cumulative_share(
    df: DataFrame,
    group: str,
    value: str,
    spread: Sequence[str],
    name: str = "share",
    ranges: int | None = None,
) -> DataFrame:
    """Share of the group's rows with a value up to the row's own (ties: the largest).

    ``group`` takes a declared, small set of values; ``value`` is never NULL.
    """
    splits = split_points(df, [group, value], [group, *spread], ranges)
    ranged = in_ranges(df, [group, value], splits)
    counts = F.broadcast(_range_counts(ranged, [group]))  # groups + ranges rows at most
    alone = F.col(RANGE) % 2 == 1
    salted = ranged.withColumn(
        SALT, F.when(alone, F.pmod(F.xxhash64(*spread), F.lit(shuffle_partitions(df.sparkSession)))).otherwise(0)
    )
    up_to = Window.partitionBy(group, RANGE, SALT).orderBy(value)
    return (
        salted.withColumn("__local", F.count(F.lit(1)).over(up_to))
        .join(counts, [group, RANGE])
        .withColumn(
            name,
            (F.col("__before") + F.when(alone, F.col("__n")).otherwise(F.col("__local"))) / F.col("__total"),
        )
        .drop(RANGE, SALT, "__local", "__n", "__before", "__total")
    )


def quantiles(
    df: DataFrame,
    group: str,
    value: str,
    shares: Sequence[float],
    spread: Sequence[str],
    ranges: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles: (group, share, quantile, n_rows).

    Only the ranges that hold a wanted position are sorted, after equal values
    have been counted together.
    """
    splits = split_points(df, [group, value], [group, *spread], ranges)
    ranged = in_ranges(df, [group, value], splits)
    counts = _range_counts(ranged, [group])
    wanted = (
        counts.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("__at", F.col("share") * (F.col("__total") - 1))
        .withColumn("__rank", F.explode(F.array(F.floor("__at"), F.ceil("__at"))))
        .filter((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n")))
        .distinct()
    )
    upper = Window.partitionBy(group, RANGE).orderBy(value)
    counted = (
        ranged.join(F.broadcast(wanted.select(group, RANGE).distinct()), [group, RANGE], "left_semi")
        .groupBy(group, RANGE, value)
        .agg(F.count(F.lit(1)).alias("__m"))
        .withColumn("__upto", F.sum("__m").over(upper))
    )
    found = counted.join(F.broadcast(wanted), [group, RANGE]).filter(
        (F.col("__rank") - F.col("__before") < F.col("__upto"))
        & (F.col("__rank") - F.col("__before") >= F.col("__upto") - F.col("__m"))
    )
    low, high = F.min(value), F.max(value)
    part = F.max("__at") - F.floor(F.max("__at"))
    return found.groupBy(group, "share").agg(
        (low + (high - low) * part).alias("quantile"), F.max("__total").alias("n_rows")
    )
