"""Audit of how quality filters interact, by relations of failing rows.

Every filter has a table of the rows that fail it. What a prefix of filters does depends
only on which filters are in it, so a small table lists all such sets: a failing row is
put before each set without its own filter, and a set is hit by the rows that one of its
filters fails. A left-anti join of the two is what the filter removes after that prefix, a
left-semi join what it finds removed already; counts of both are all that leaves the
joins. Orders of filters then only add these counts up.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.columns import row_numbered, trimmed, words
from affinis.llm.scratch import Scratch
from affinis.operators.joins import salted_lookup, weighted_lookup

FEW_WORDS, LOW_VARIETY, MANY_CAPITALS = 100, 80, 10
MARKS = "[#$%&*|]"
COUNTS = ["removed", "redundant", "good_lost", "toxic_lost"]


def text_filters() -> dict[str, Column]:
    """Failure conditions on the columns n_words, n_distinct and text."""
    return {
        "A": F.col("n_words") < FEW_WORDS,
        "B": 100 * F.col("n_distinct") < LOW_VARIETY * F.col("n_words"),
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > MANY_CAPITALS * F.char_length("text"),
        "D": F.col("text").rlike(MARKS),
    }


def measured(docs: DataFrame, labels: DataFrame, part: str, scratch: Scratch) -> DataFrame:
    """(row_at, doc_id, part, digest, good, toxic, A, B, C, D) of each row of ``docs``, written once."""
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    counted = (
        rows.withColumn("t", trimmed("text"))
        .withColumn("w", words("t"))
        .withColumn("n_words", F.size("w"))
        .withColumn("n_distinct", F.size(F.array_distinct("w")))
    )
    flags = [condition.alias(name) for name, condition in text_filters().items()]
    whole = scratch.written(row_numbered(counted).select("row_at", "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *flags), "rows")
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    marked = salted_lookup(whole.filter("doc_id is not null"), scratch.written(marks, "marks"), ["doc_id"], "row_at", "left")
    both = marked.unionByName(whole.filter("doc_id is null"), allowMissingColumns=True)
    return scratch.written(both.withColumn("good", F.coalesce("good", F.lit(False))).withColumn("toxic", F.coalesce("toxic", F.lit(False))), "marked")


def later_copies(whole: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows whose text a smaller ``doc_id`` has too; a null id is neither smaller nor larger than another."""
    groups = whole.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return weighted_lookup(whole, scratch.written(groups, "copies"), ["digest"], "n", "row_at").filter("doc_id > least").drop("least", "n")


def _sets(names: list[str]) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
    """For each filter the sets (as bits of ``names``) without it, and those with it."""
    every = range(1 << len(names))
    return (
        {name: [s for s in every if not s >> bit & 1] for bit, name in enumerate(names)},
        {name: [s for s in every if s >> bit & 1] for bit, name in enumerate(names)},
    )


def interactions(failing: dict[str, DataFrame]) -> DataFrame:
    """(part, filter, prefix, removed, redundant, good_lost, toxic_lost) for each filter and each set of others before it.

    ``failing`` has one table (row_at, part, good, toxic) for each filter.
    """
    before, holding = _sets(list(failing))

    def spread(sets: dict[str, list[int]]) -> DataFrame:
        """Each failing row once for each of its filter's sets: as many as there are sets of filters, at most."""
        tables = [table.withColumn("filter", F.lit(name)) for name, table in failing.items()]
        out = tables[0]
        for table in tables[1:]:
            out = out.unionAll(table)
        own = F.create_map(*[x for name in failing for x in (F.lit(name), F.array(*[F.lit(s).cast("tinyint") for s in sets[name]]))])
        return out.withColumn("prefix", F.explode(F.element_at(own, F.col("filter"))))  # after the union, else a join would go below it, once for each filter

    asked = spread(before)
    # Spark goes by the size of the tables' files, which says little about these rows, and would send them to every task.
    hit = spread(holding).select("row_at", "prefix").hint("merge")
    removed = asked.join(hit, ["row_at", "prefix"], "left_anti").groupBy("part", "filter", "prefix").agg(
        F.count(F.lit(1)).alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost")
    )
    redundant = asked.join(hit, ["row_at", "prefix"], "left_semi").groupBy("part", "filter", "prefix").agg(F.count(F.lit(1)).alias("redundant"))
    return removed.join(redundant, ["part", "filter", "prefix"], "full").na.fill(0, COUNTS)


def _steps(names: list[str]) -> list[tuple[str, int, str, int]]:
    """(order, step, filter, prefix) of all orders."""
    out = []
    for order in permutations(names):
        prefix = 0
        for step, name in enumerate(order, 1):
            out.append(("".join(order), step, name, prefix))
            prefix |= 1 << names.index(name)
    return out


def audited(totals: DataFrame, counted: DataFrame, names: list[str]) -> DataFrame:
    """One row for each part, order of filters and step, zeros included.

    ``totals`` has the number of rows of each part, ``counted`` is :func:`interactions`.
    """
    n, spark = len(names), totals.sparkSession
    orders = F.broadcast(spark.createDataFrame(_steps(names), "filter_order string, step int, filter string, prefix int"))
    others = F.lit((1 << n) - 1) - F.element_at(F.create_map(*[F.lit(x) for bit, name in enumerate(names) for x in (name, 1 << bit)]), F.col("filter"))
    # A filter's removals over all orders: a set of m others comes before it in m! (n - 1 - m)! of them.
    weight = F.element_at(F.array(*[F.lit(factorial(m) * factorial(n - 1 - m)) for m in range(n)]), F.bit_count("prefix") + 1)
    by_filter = counted.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == others, F.col("removed")).otherwise(0)).alias("unique_fails"), F.sum(F.col("removed") * weight).alias("shapley")
    )
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    grid = totals.withColumn("filter", F.explode(F.array(*[F.lit(x) for x in names]))).join(orders, "filter")
    return (
        grid.join(counted, ["part", "filter", "prefix"], "left")
        .join(by_filter, ["part", "filter"], "left")
        .na.fill(0, [*COUNTS, "unique_fails", "shapley"])
        .withColumn("kept", F.col("total") - F.sum("removed").over(so_far))
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", scratch: Scratch | None = None) -> DataFrame:
    """What each of five filters removes from ``docs`` in each order, for each value of ``part``.

    Filters: A few words, B few distinct words, C many capitals, D marks, E the text of a
    smaller ``doc_id``. Columns: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. Rows count: a repeated row counts
    again, a row without ``doc_id`` has no label and is no copy, a null text is empty, a
    null part is the empty string. Of several labels of a document any good or toxic
    one counts. An empty table has no parts and gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "audit")
    whole = measured(docs, labels, part, scratch)
    failing = {name: whole.filter(name) for name in text_filters()} | {"E": later_copies(whole, scratch)}
    stored = {name: scratch.written(rows.select("row_at", "part", "good", "toxic"), f"failing-{name}") for name, rows in failing.items()}
    counted = scratch.written(interactions(stored), "counted")
    totals = whole.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    return audited(totals, counted, list(stored))
