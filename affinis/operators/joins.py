"""Joins of many rows with a table of unique keys, safe for keys that most rows share.

A key held by a third of the rows would send them all to one task. Adaptive
execution splits such a task only when both sides come straight from a shuffle,
which a table made by ``groupBy`` does not. So the rows of a heavy key are spread
over salts here, and the key's one table row is repeated for each salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import fits_broadcast, shuffle_partitions, written

ROWS_PER_SALT = 100_000
LOOKUP_ROWS = 2_000_000  # rows that one task sorts for a lookup
#: A key is heavy from the larger of ROWS_PER_SALT and this share of all rows, so there are at most as many heavy keys.
MOST_HEAVY = 100_000
SALT, SALTS = "__lookup_salt", "__lookup_salts"


def weighted_lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str, spread: str, how: str = "inner"
) -> DataFrame:
    """Join with a table that knows how many rows each key has (column ``weight``).

    Every heavy key gets as many salts as its counted rows need. The list of heavy
    keys is bounded at any size, as each holds a share of all rows, and is sent to
    every task. There are more tasks than the session's setting says where the counted
    rows need them.
    """
    on = list(on)
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("t")).first().t
    share = max(ROWS_PER_SALT, total // MOST_HEAVY)
    heavy = table.filter(F.col(weight) > share).select(*on, F.ceil(F.col(weight) / share).cast("int").alias(SALTS))
    count = F.coalesce(F.col(SALTS), F.lit(1))
    many = rows.join(F.broadcast(heavy), on, "left").withColumn(SALT, F.pmod(F.xxhash64(spread), count).cast("int"))
    unique = table.join(F.broadcast(heavy), on, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), count - 1)))
    many, unique, tasks = many.drop(SALTS), unique.drop(SALTS), -(-total // LOOKUP_ROWS)
    if tasks > shuffle_partitions(rows.sparkSession):
        many, unique = many.repartition(tasks, *on, SALT), unique.repartition(tasks, *on, SALT)
    return many.join(unique, [*on, SALT], how).drop(SALT)


def salted_lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], spread: str, how: str = "inner", narrow: bool = False
) -> DataFrame:
    """Join with a table that knows nothing about the rows, which may have heavy keys it lacks.

    The table is broadcast when its measured size is small; otherwise the rows' keys
    are counted and the heavy ones are spread (see :func:`weighted_lookup`). ``narrow`` is for a
    table that may hold far more than the rows ask for: where their counted keys are few, only the
    table's rows with these keys go on, so that the table is read but neither moved nor sorted.
    """
    on = list(on)
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), on, how)
    sizes = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    if narrow:
        sizes = written(sizes, "sizes")
        if fits_broadcast(sizes):
            asked = written(table.join(F.broadcast(sizes.select(*on)), on, "left_semi"), "asked")
            if fits_broadcast(asked):
                return rows.join(F.broadcast(asked), on, how)
            table = asked
    known = sizes.join(table, on, "left" if how == "left" else "inner")  # a heavy key the table lacks is spread too
    return weighted_lookup(rows, known, on, "__n", spread, how).drop("__n")


def attached(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """Add a table's columns by its unique ``key``, which may be heavy among the rows.

    ``rows`` is read twice: its keys are counted first, which also leaves out the
    table rows that nobody asks for.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return weighted_lookup(rows, table.join(sizes, key), [key], "__n", spread).drop("__n")


def spread_join(rows: DataFrame, others: DataFrame, on: Sequence[str], spread: str) -> DataFrame:
    """Join two tables whose keys both repeat; the rows of a heavy key are spread, and its others repeated for each salt.

    ``rows`` is the larger table; it is read twice, as its keys are counted first. The list of
    heavy keys is bounded as in :func:`weighted_lookup`.
    """
    on = list(on)
    sizes = written(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("t")).first().t
    share = max(ROWS_PER_SALT, total // MOST_HEAVY)
    heavy = F.broadcast(sizes.filter(F.col("__n") > share).select(*on, F.ceil(F.col("__n") / share).cast("int").alias(SALTS)))
    count = F.coalesce(F.col(SALTS), F.lit(1))
    many = rows.join(heavy, on, "left").withColumn(SALT, F.pmod(F.xxhash64(spread), count).cast("int"))
    few = others.join(heavy, on, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), count - 1)))
    return many.drop(SALTS).join(few.drop(SALTS), [*on, SALT]).drop(SALT)
