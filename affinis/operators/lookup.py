"""Finding entities for a table of references: by name, by code, by part of a name."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.text import name_key
from affinis.operators.joins import salted_lookup, spread_join
from affinis.session import fits_broadcast, written
from affinis.spec import LIVESTOCK, ProfileSpec

# Smallest similarity of a fuzzy match, results of a search, suggestions shown.
FUZZY_CUTOFF = 0.7
MAX_RESULTS = 10
SUGGESTIONS = 5

FOUND, NOT_FOUND, AMBIGUOUS, INVALID = "found", "not_found", "ambiguous", "invalid"


def small(queries: DataFrame) -> DataFrame:
    """Mark a query table for broadcast when a count shows that it is small."""
    return F.broadcast(queries) if fits_broadcast(queries) else queries


def resolve_names(
    queries: DataFrame,
    entities: DataFrame,
    spec: ProfileSpec = LIVESTOCK,
    suggest: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Resolve (query_id, name, group) to one entity each.

    Gives query_id, status, entity id and the groups that hold the name (an entity
    without group: empty). A NULL group in a query means any. ``suggest`` adds up to five ``suggestions`` (name, group)
    for names not found.
    """
    wanted = queries.select("query_id", name_key(F.col("name")).alias("__key"), F.upper("group").alias("__group"))
    # A name that very many entities share is counted before it meets a query.
    known = entities.groupBy(F.lower(spec.name).alias("__key"), F.col(spec.group).alias("__in")).agg(
        F.count(F.lit(1)).alias("n"), F.min(spec.entity).alias("first")
    )
    hits = (
        salted_lookup(known, wanted, ["__key"], "__in")
        .filter(F.col("__group").isNull() | (F.col("__group") == F.col("__in")))
        .groupBy("query_id")
        .agg(
            F.sum("n").alias("n_matches"),
            F.min("first").alias("__id"),
            F.array_sort(F.collect_list(F.coalesce("__in", F.lit("")))).alias("groups"),
        )
    )
    status = (
        F.when(F.col("n_matches").isNull(), NOT_FOUND).when(F.col("n_matches") == 1, FOUND).otherwise(AMBIGUOUS)
    )
    result = queries.join(hits, "query_id", "left").select(
        *queries.columns,
        status.alias("status"),
        F.when(F.col("n_matches") == 1, F.col("__id")).alias(spec.entity),
        F.when(F.col("n_matches") > 1, F.col("groups")).alias("groups"),
    )
    if suggest:
        lost = result.filter(F.col("status") == NOT_FOUND).select("query_id", F.col("name").alias("part"))
        shown = (
            search(lost, entities, SUGGESTIONS, spec)
            .groupBy("query_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", spec.name, spec.group))).alias("__s"))
            .select(
                "query_id",
                F.transform(
                    "__s", lambda s: F.concat(s[spec.name], F.lit(" ("), s[spec.group], F.lit(")"))
                ).alias("suggestions"),
            )
        )
        result = result.join(shown, "query_id", "left")
    return raised(result) if strict else result


def resolve_codes(
    queries: DataFrame, entities: DataFrame, spec: ProfileSpec = LIVESTOCK, strict: bool = False
) -> DataFrame:
    """Resolve (query_id, code): status found, not_found, or invalid for a code that is no number."""
    number = F.when(F.trim(F.col("code").cast("string")).rlike(r"^[+-]?\d+$"), F.col("code").try_cast("bigint"))
    wanted = queries.withColumn("__code", number)
    known = entities.select(spec.entity)
    hits = known.join(small(wanted), known[spec.entity] == F.col("__code")).select("query_id", spec.entity)
    result = wanted.join(hits, "query_id", "left").select(
        *queries.columns,
        F.when(F.col("__code").isNull(), INVALID)
        .when(F.col(spec.entity).isNull(), NOT_FOUND)
        .otherwise(FOUND)
        .alias("status"),
        spec.entity,
    )
    return raised(result) if strict else result


def resolve_references(
    queries: DataFrame, entities: DataFrame, spec: ProfileSpec = LIVESTOCK, strict: bool = False
) -> DataFrame:
    """Resolve (query_id, ref, group): digits are a code, anything else a name, NULL is invalid."""
    is_code = F.col("ref").isNull() | F.col("ref").rlike("^[0-9]+$")
    kept = ["query_id", "ref", "status", spec.entity]
    codes = resolve_codes(queries.filter(is_code).withColumn("code", F.col("ref")), entities, spec)
    names = resolve_names(queries.filter(~is_code).withColumn("name", F.col("ref")), entities, spec)
    result = codes.select(kept).unionByName(names.select(kept))
    return raised(result) if strict else result


def raised(result: DataFrame) -> DataFrame:
    """The result of a resolution, or an error that names the first reference without an entity."""
    bad = result.filter(F.col("status") != FOUND).orderBy("query_id").first()
    if bad is not None:
        raise LookupError(f"no single entity for {bad.asDict()}")
    return result


def substring_hits(queries: DataFrame, entities: DataFrame, limit: int, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """The first ``limit`` entities by id whose name holds the part, per (query_id, part).

    Names are indexed by their runs of one, two, four, ... letters, as hashes, and a part is looked up
    by its last run of the largest such length that fits in it. So it is an equi-join that few
    other names pass; the whole part is then tested in the join. Of the entities that share a name
    only the first ``limit`` can be results, and equal questions are asked once. An empty part finds nothing.
    """
    part = name_key(F.col("part"))
    asked = queries.filter(F.length(part) > 0).groupBy("query_id", "part").agg(F.count(F.lit(1)).alias("__asked"))
    asked = written(asked.withColumn("__key", name_key(F.col("part"))), "asked")
    longest = asked.agg(F.coalesce(F.max(F.length("__key")), F.lit(1))).first()[0]
    fit = F.coalesce(*[F.when(F.length("__key") >= 1 << b, F.lit(1 << b)) for b in reversed(range(longest.bit_length()))])
    lengths = [row[0] for row in asked.select(fit).distinct().collect()]  # powers of two
    wanted = asked.withColumn("__run", F.xxhash64(F.right("__key", fit)))

    by_name = Window.partitionBy(spec.name).orderBy(spec.entity)
    few = entities.filter(F.length(spec.name) > 0).withColumn("__at", F.row_number().over(by_name)).filter(F.col("__at") <= limit)
    named = written(few.groupBy(spec.name).agg(F.collect_list(F.struct(spec.entity, spec.group)).alias("__in")), "names")
    low = F.lower(F.col(spec.name))
    runs = F.array_distinct(F.flatten(F.array(*[_runs(low, n) for n in lengths]))) if lengths else F.array().cast("array<bigint>")
    held = named.withColumn("__run", F.explode(runs))
    met = spread_join(held, wanted, ["__run"], spec.name).filter(F.lower(spec.name).contains(F.col("__key")))
    once = _first(met.select("query_id", "__asked", spec.name, F.inline("__in")), limit, [spec.entity]).drop("rank")
    every = once.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.least("__asked", F.lit(limit)))))
    return _first(every, limit, [spec.entity]).select("query_id", spec.entity, spec.name, spec.group)


def _runs(text: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` letters."""
    starts = F.when(F.length(text) >= length, F.sequence(F.lit(1), F.length(text) - (length - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.xxhash64(F.substr(text, i, F.lit(length)))), F.array().cast("array<bigint>"))


def _first(df: DataFrame, limit: int, order: list) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return df.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= limit)


def _letters(text: Column) -> Column:
    """Letters as 'letter + occurrence', so that a set overlap is a multiset overlap."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(
        letters,
        lambda c, i: F.concat(
            F.lpad(F.size(F.filter(F.slice(letters, 1, i + 1), lambda d: d == c)).cast("string"), 5, "0"), c
        ),
    )


def _sharing_letters(queries: DataFrame, entities: DataFrame, share: float, spec: ProfileSpec) -> DataFrame:
    """(query_id, part, name, n_common) of all texts and names that may hold ``share`` of each other's letters in common.

    Such a pair's lengths are near each other, and it shares a letter in the head of both
    sorted letter lists. Names are joined by such a letter and their length; nothing is lost.
    """

    def heads(df: DataFrame, text: str, prefix: str) -> DataFrame:
        # Repeated letters first: they are rarer than single ones.
        size = F.size(f"{prefix}_letters")
        kept = size - F.ceil(size * share - 1e-9) + 1
        return (
            df.filter(F.length(text) > 0)
            .withColumn(f"{prefix}_letters", F.sort_array(_letters(F.col(text)), asc=False))
            .withColumn(f"{prefix}_head", F.slice(f"{prefix}_letters", 1, kept.cast("int")))
            .withColumn("letter", F.explode(f"{prefix}_head"))
        )

    # Written, as Spark would else test the letters of every row before it makes names distinct.
    names = written(entities.select(spec.name).distinct(), "names")
    held = heads(names, spec.name, "n").withColumn("length", F.length(spec.name))
    texts = written(queries.filter(F.length(name_key(F.col("part"))) > 0).select("query_id", "part"), "parts")
    asked = heads(texts, "part", "q")
    own = F.length("part")
    lengths = F.sequence(F.ceil(own * share - 1e-9).cast("int"), F.floor(own / share + 1e-9).cast("int"))
    wanted = asked.withColumn("length", F.explode(lengths))
    return (
        salted_lookup(held, wanted, ["letter", "length"], spec.name)
        # The pair meets once, at the first letter both heads hold.
        .filter(F.array_intersect("n_head", "q_head")[0] == F.col("letter"))
        .select("query_id", "part", spec.name, F.size(F.array_intersect("n_letters", "q_letters")).alias("n_common"))
    )


def fuzzy_hits(
    queries: DataFrame,
    entities: DataFrame,
    limit: int,
    spec: ProfileSpec = LIVESTOCK,
    cutoff: float = FUZZY_CUTOFF,
) -> DataFrame:
    """Per (query_id, part) the ``limit`` distinct names closest in edit distance.

    The ratio is one less the edit distance over the longer length, at least
    ``cutoff``. An edit takes one letter from the longer text at most, so texts that
    reach the cutoff share that part of the longer one's letters.
    """
    longer = F.greatest(F.length(spec.name), F.length("part"))
    rated = (
        _sharing_letters(queries, entities, cutoff, spec)
        .filter(F.col("n_common") >= cutoff * longer - 1e-9)
        .select("query_id", spec.name, (1 - F.levenshtein(spec.name, "part") / longer).alias("ratio"))
        .filter(F.col("ratio") >= cutoff - 1e-9)
    )
    return _first(rated, limit, [F.desc("ratio"), F.desc(spec.name)]).select("query_id", spec.name, "ratio")


def _block_ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ratio of matching blocks of each (part, name)."""
    matcher = SequenceMatcher()
    for batch in batches:
        ratios, last = [], None
        for part, name in zip(batch.column("part").to_pylist(), batch.column("name").to_pylist(), strict=True):
            if part != last:  # what is found out about a query serves all its names
                matcher.set_seq2(part)
                last = part
            matcher.set_seq1(name)
            ratios.append(matcher.ratio())
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("name"), pa.array(ratios, pa.float64())], names=["query_id", "name", "ratio"])


def ratio_hits(
    queries: DataFrame,
    entities: DataFrame,
    limit: int,
    spec: ProfileSpec = LIVESTOCK,
    cutoff: float = FUZZY_CUTOFF,
) -> DataFrame:
    """Per (query_id, part) the ``limit`` distinct names of the largest ratio of matching blocks.

    The ratio is twice the letters in the longest matching blocks, found left and right of each
    other in turn, over both lengths, at least ``cutoff``; ties go to the later name. The
    matched letters are in both texts, so the letters in common bound the ratio from above,
    and only pairs within the bound are rated.
    """
    both = F.length(spec.name) + F.length("part")
    pairs = (
        # Of lengths a <= b the ratio is 2a / (a + b) at most.
        _sharing_letters(queries, entities, cutoff / (2 - cutoff), spec)
        .filter(2 * F.col("n_common") >= cutoff * both - 1e-9)
        .select("query_id", "part", F.col(spec.name).alias("name"))
    )
    id_type = queries.schema["query_id"].dataType.simpleString()
    rated = pairs.mapInArrow(_block_ratios, f"query_id {id_type}, name string, ratio double").filter(F.col("ratio") >= cutoff)
    named = rated.withColumnRenamed("name", spec.name)
    return _first(named, limit, [F.desc("ratio"), F.desc(spec.name)]).select("query_id", spec.name, "ratio")


def search(
    queries: DataFrame,
    entities: DataFrame,
    max_results: int = MAX_RESULTS,
    spec: ProfileSpec = LIVESTOCK,
    cutoff: float = FUZZY_CUTOFF,
    fuzzy: Callable[..., DataFrame] = fuzzy_hits,
) -> DataFrame:
    """(query_id, rank, stage, name, group) for each (query_id, part).

    Substring hits in id order come first; a query with fewer than
    ``max_results`` is filled up with fuzzy hits, best first, each (name, group)
    once. ``fuzzy`` is :func:`fuzzy_hits` or :func:`ratio_hits`.
    """
    exact = written(substring_hits(queries, entities, max_results, spec), "substring")
    counts = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("__n"))
    short = (
        queries.join(counts, "query_id", "left")
        .filter(F.coalesce(F.col("__n"), F.lit(0)) < max_results)
        .select("query_id", "part")
    )
    hits = written(fuzzy(short, entities, max_results, spec, cutoff), "fuzzy")
    # Entities that share name and group are one before they meet the queries that found the name.
    known = entities.groupBy(spec.name, spec.group).agg(F.min(spec.entity).alias(spec.entity))
    met = known.join(F.broadcast(hits), spec.name) if fits_broadcast(hits) else spread_join(known, hits, [spec.name], spec.group)
    close = met.groupBy("query_id", spec.name, spec.group).agg(F.min(spec.entity).alias(spec.entity), F.max("ratio").alias("ratio"))
    told = exact.select(*[F.col(c).alias(f"__{c}") for c in ("query_id", spec.name, spec.group)]).distinct()
    same = (F.col("query_id") == F.col("__query_id")) & (F.col(spec.name) == F.col(f"__{spec.name}"))
    close = close.join(told, same & F.col(spec.group).eqNullSafe(F.col(f"__{spec.group}")), "left_anti")
    both = exact.select("query_id", spec.entity, spec.name, spec.group).withColumns(
        {"stage": F.lit("substring"), "ratio": F.lit(None).cast("double")}
    ).unionByName(close.withColumn("stage", F.lit("fuzzy")))
    order = [F.desc("stage"), F.desc("ratio"), F.when(F.col("stage") == "fuzzy", F.col(spec.name)).desc(), F.col(spec.entity)]
    return _first(both, max_results, order).select("query_id", "rank", "stage", spec.name, spec.group)

