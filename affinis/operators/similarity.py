"""Cosine, Euclidean and Manhattan comparison of term vectors and dense vectors.

Scores are long rows, never a matrix. A pair of term vectors without a common
token has no row in :func:`scored_pairs`: its dot product is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions import vectors as V
from affinis.operators.joins import attached, spread_join, weighted_lookup
from affinis.operators.topk import check_k, top_k
from affinis.session import fits_broadcast, salts, written

SQUARE_BLOCK = 1_000  # entities of one side of a piece of a square matrix
HOT_TOKEN_ROWS = 100_000
TASK_PAIRS = 250_000  # pairs of a query and an entity that one task sums up, where queries are broadcast
DENSE_QUERY_BLOCK = 1_000
DENSE_SLICE = 50_000

# For each metric: score of a scored pair, whether large is near, and the
# column that orders vectors sharing no token with a query (None: by id alone).
COSINE, EUCLIDEAN, MANHATTAN = "cosine", "euclidean", "manhattan"
METRICS = (COSINE, EUCLIDEAN, MANHATTAN)


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {METRICS}")


def norm_product(left_sq: str, right_sq: str) -> Column:
    """Product of two Euclidean norms; one root, so that whole results stay whole."""
    return F.sqrt(F.col(left_sq).cast("double") * F.col(right_sq).cast("double"))


def cosine_score() -> Column:
    norms = norm_product("q_sq", "sq")
    return F.when(norms > 0, F.col("dot") / norms).otherwise(F.lit(0.0))


def metric_score(metric: str) -> Column:
    """The metric from the columns of :func:`scored_pairs`."""
    check_metric(metric)
    if metric == COSINE:
        return cosine_score()
    if metric == EUCLIDEAN:
        return F.sqrt((F.col("q_sq") + F.col("sq") - 2 * F.col("dot")).cast("double"))
    return (F.col("q_l1") + F.col("l1") - 2 * F.col("overlap")).cast("double")


def pair_dot(left: Column, right: Column) -> Column:
    """Dot product of two ``terms`` arrays in one row, linear in their length."""
    products = F.map_zip_with(
        F.map_from_entries(left), F.map_from_entries(right), lambda _, a, b: F.coalesce(a * b, F.lit(0))
    )
    return F.aggregate(F.map_values(products), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def pair_overlap(left: Column, right: Column) -> Column:
    """Sum of the smaller counts of two ``terms`` arrays in one row."""
    smaller = F.map_zip_with(
        F.map_from_entries(left),
        F.map_from_entries(right),
        lambda _, a, b: F.least(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))),
    )
    return F.aggregate(F.map_values(smaller), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def scored_pairs(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    entity: str,
    exclude_self: bool = False,
    group: str | None = None,
    few: bool | None = None,
    rows: int | None = None,
) -> DataFrame:
    """(query_id, entity, dot, overlap, q_sq, q_l1, sq, l1) of pairs that share a token.

    The corpus is laid out by entity once. Queries whose terms are few enough
    (counted, not guessed) are broadcast, so the join and the sums per pair stay
    in the entity's partition and a token held by most entities weighs on no
    task; there are as many partitions as keep TASK_PAIRS pairs in each. With more queries both sides are joined by token, a heavy token over as many
    salts as its counted rows need, and only the sums per pair move again. Exclusions are part of the join. ``few`` and ``rows`` (of the corpus) are
    what the counts say, where the caller has made them.
    """
    c_group = [F.col(group).alias("__c_group")] if group else []
    asked = _asked(queries, query_id, group, F.inline("terms")).withColumnRenamed("cnt", "q_cnt")
    if fits_broadcast(asked) if few is None else few:
        pairs = queries.count() * (corpus.count() if rows is None else rows)
        held = corpus.repartition(max(1, -(-pairs // TASK_PAIRS)), entity).select(entity, "sq", "l1", *c_group, F.inline("terms"))
        joined = held.join(F.broadcast(asked), "token")
    else:
        held = corpus.select(entity, "sq", "l1", *c_group, F.inline("terms"))
        joined = spread_join(held, asked, ["token"], entity)
    return (
        _allowed(joined, query_id, entity, exclude_self, group)
        .groupBy(query_id, entity)
        .agg(
            F.sum(F.col("cnt") * F.col("q_cnt")).alias("dot"),
            F.sum(F.least("cnt", "q_cnt")).alias("overlap"),
            *[F.max(c).alias(c) for c in ("q_sq", "q_l1", "sq", "l1")],
        )
    )


def _asked(queries: DataFrame, query_id: str, group: str | None, generated: Column) -> DataFrame:
    q_group = [F.col(group).alias("__q_group")] if group else []
    return queries.select(
        F.col(query_id), F.col("sq").alias("q_sq"), F.col("l1").alias("q_l1"), *q_group, generated
    )


def _allowed(pairs: DataFrame, query_id: str, entity: str, exclude_self: bool, group: str | None) -> DataFrame:
    if exclude_self:
        pairs = pairs.filter(F.col(query_id) != F.col(entity))
    if group:
        pairs = pairs.filter(~F.coalesce(F.col("__q_group") == F.col("__c_group"), F.lit(False)))
    return pairs


def cosine_scores(queries: DataFrame, corpus: DataFrame, query_id: str, entity: str) -> DataFrame:
    """(query_id, entity, score); an absent pair has score 0, as has a zero vector."""
    return scored_pairs(queries, corpus, query_id, entity).select(query_id, entity, cosine_score().alias("score"))


def _fillers(corpus: DataFrame, entity: str, k: int, metric: str, group: str | None) -> DataFrame:
    """Vectors that complete a top-k when too few share a token with a query.

    Among vectors that share nothing, the order is fixed by their own size and
    id. So the first k (k + 1 for the query itself) are enough; and where a
    query's own group is left out, the first k of each of the k + 1 groups that
    come first. At most (k + 1) * (k + 1) rows.
    """
    size = {COSINE: [], EUCLIDEAN: ["sq"], MANHATTAN: ["l1"]}[metric]
    columns = list(dict.fromkeys([entity, "terms", "sq", "l1", *([group] if group else [])]))
    rows = corpus.select(*columns)
    first = [*size, entity]
    if group is None:
        return rows.orderBy(*first).limit(k + 1)
    leading = rows.groupBy(group).agg(F.min(F.struct(*first)).alias("__first")).orderBy("__first").limit(k + 1)
    keys = F.broadcast(leading.select(F.col(group).alias("__g")))  # k + 1 rows
    ranked = rows.join(keys, F.col(group).eqNullSafe(F.col("__g")), "left_semi").withColumn(
        "__r", F.row_number().over(Window.partitionBy(group).orderBy(*first))
    )
    return ranked.filter(F.col("__r") <= k + 1).drop("__r")


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    entity: str,
    metric: str = COSINE,
    exclude_self: bool = False,
    group: str | None = None,
) -> DataFrame:
    """The k nearest vectors of each query: (query_id, entity, score, rank).

    ``exclude_self`` leaves out the entity whose id is the query id. ``group``
    names a column of both tables: entities of the query's own group are left
    out. Both inputs are read several times: pass written tables.
    """
    check_k(k)
    check_metric(metric)
    few = fits_broadcast(queries.select(F.inline("terms")))
    scored = scored_pairs(queries, corpus, query_id, entity, exclude_self, group, few).select(
        query_id, entity, metric_score(metric).alias("score")
    )
    filler = _fillers(corpus, entity, k, metric, group)
    c_group = [F.col(group).alias("__c_group")] if group else []
    packed = filler.agg(F.collect_list(F.struct(entity, "sq", "l1", *c_group))).scalar()
    offered = _asked(queries, query_id, group, F.inline(packed))
    sharing = scored_pairs(queries, filler, query_id, entity, few=few, rows=(k + 1) ** 2).select(query_id, entity)
    apart = (
        _allowed(offered, query_id, entity, exclude_self, group)
        .join(sharing, [query_id, entity], "left_anti")
        .withColumns({"dot": F.lit(0), "overlap": F.lit(0)})
        .select(query_id, entity, metric_score(metric).alias("score"))
    )
    best = top_k(scored, k, "score", [entity], [query_id], largest=metric == COSINE).drop("rank")
    return top_k(best.unionByName(apart), k, "score", [entity], [query_id], largest=metric == COSINE)


def square_scores(vectors: DataFrame, ids: DataFrame, entity: str) -> DataFrame:
    """Cosine of every ordered pair of the listed entities, zeros included.

    The caller answers for the list: its square is the result. Both sides are dealt to
    blocks, and each pair of blocks is a piece of work of its own.
    """
    chosen = written(vectors.join(ids.select(entity).distinct(), entity), "chosen")
    left, right = "left_id", "right_id"
    scores = cosine_scores(
        chosen.withColumnRenamed(entity, left), chosen.withColumnRenamed(entity, right), left, right
    )
    blocks = max(1, -(-chosen.count() // SQUARE_BLOCK))

    def dealt(name: str, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(entity), F.lit(blocks)).cast("int")
        return chosen.select(F.col(entity).alias(name), place.alias(own), F.explode(salts(blocks)).alias(other))

    cells = dealt(left, "__i", "__j").join(dealt(right, "__j", "__i"), ["__i", "__j"]).select(left, right)
    return cells.join(scores, [left, right], "left").na.fill(0.0, ["score"])


def distinct_profiles(vectors: DataFrame, entity: str) -> DataFrame:
    """One row per distinct term vector: its smallest entity as ``profile``, and ``n_members``.

    Any number of equal vectors becomes one row before anything is compared.
    """
    return vectors.groupBy("terms").agg(
        F.min(entity).alias("profile"),
        F.count(F.lit(1)).alias("n_members"),
        F.max("sq").alias("sq"),
    )


def profile_members(vectors: DataFrame, profiles: DataFrame, entity: str) -> DataFrame:
    """(profile, entity): which entities share each distinct vector."""
    # The hash stands for the vector where heavy keys are listed; the vector itself decides.
    rows = vectors.select(entity, "terms", F.xxhash64("terms").alias("mark"))
    marked = profiles.select("terms", "profile", "n_members", F.xxhash64("terms").alias("mark"))
    sized = marked.groupBy("mark").agg(
        F.sum("n_members").alias("n"), F.collect_list(F.struct("terms", "profile")).alias("same_mark")
    )
    found = weighted_lookup(rows, sized, ["mark"], "n", entity).withColumn("p", F.explode("same_mark"))
    return found.filter(F.col("p.terms") == F.col("terms")).select(F.col("p.profile").alias("profile"), entity)


def _marks(terms: Column) -> Column:
    """One bit of 64 for each token, by its hash."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        F.transform(terms, lambda t: F.call_function("shiftleft", one, F.pmod(F.xxhash64(t["token"]), F.lit(64)).cast("int"))),
        F.lit(0).cast("bigint"),
        lambda acc, bit: acc.bitwiseOR(bit),
    )


def _kept_share(side: str, other: str) -> Column:
    """At most this share of a vector's squared length lies in tokens the other vector has."""
    lacking = F.bit_count(F.col(f"{side}_marks").bitwiseAND(F.bitwise_not(F.col(f"{other}_marks"))))
    return 1 - lacking / F.col(f"{side}_sq")


def similar_profiles(profiles: DataFrame, min_score: float) -> DataFrame:
    """All pairs of distinct profiles with cosine >= ``min_score`` > 0, left < right.

    Exact, without comparing all pairs. Tokens are put in one order, rarest
    first, and each token of a vector knows the share of the squared length that
    lies in it and behind it, its tail. At the first common token of a similar
    pair the two tails multiply to at least the squared score. So both are at
    least the squared score, which leaves a short head of each vector, and one of
    them is at least the score, which leaves an even shorter one on that side. Heads
    rarely hold a token that most profiles share; a frequent token is spread
    over salts in proportion to its rows. The join itself tests the product of
    the tails, and a bound from 64-bit marks of the token sets: a bit that only
    one side has is a token the other lacks.

    Entities with the same vector are one profile: join ``profile_members`` to
    list pairs of entities. ``profiles`` is read several times.
    """
    if not 0 < min_score <= 1:
        raise ValueError("min_score must be in (0, 1]")
    terms = profiles.select("profile", "sq", _marks(F.col("terms")).alias("marks"), F.inline("terms"))
    frequency = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rest = Window.partitionBy("profile").orderBy("df", "token").rowsBetween(0, Window.unboundedFollowing)
    slack = 1 - 1e-9
    heads = (
        weighted_lookup(terms, frequency, ["token"], "df", "profile")
        .withColumn("tail", F.sum(F.col("cnt") * F.col("cnt")).over(rest) / F.col("sq"))
        .filter(F.col("tail") >= min_score * min_score * slack)
        .withColumn("n_salts", F.ceil(F.col("df") / HOT_TOKEN_ROWS).cast("int"))
    )
    needed = min_score * min_score * slack
    left = heads.filter(F.col("tail") >= min_score * slack).select(
        F.col("profile").alias("l"),
        "token",
        *[F.col(c).alias(f"l_{c}") for c in ("tail", "marks", "sq")],
        F.pmod(F.xxhash64("profile"), F.col("n_salts")).cast("int").alias("salt"),
    )
    right = heads.select(
        F.col("profile").alias("r"),
        "token",
        *[F.col(c).alias(f"r_{c}") for c in ("tail", "marks", "sq")],
        F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("salt"),
    )
    candidates = written(
        left.join(right, ["token", "salt"])
        .filter(
            (F.col("l") != F.col("r"))
            & (F.col("l_tail") * F.col("r_tail") >= needed)
            & (_kept_share("l", "r") * _kept_share("r", "l") >= needed)
        )
        .select(F.least("l", "r").alias("left_id"), F.greatest("l", "r").alias("right_id"))
        .distinct(),
        "candidates",
    )

    def side(prefix: str) -> DataFrame:
        return profiles.select(
            F.col("profile").alias(f"{prefix}_id"),
            F.col("terms").alias(f"{prefix}_terms"),
            F.col("sq").alias(f"{prefix}_sq"),
            F.col("terms.token").alias(f"{prefix}_tokens"),
        )

    plain = (F.col("left_sq") == F.size("left_terms")) & (F.col("right_sq") == F.size("right_terms"))
    # Counts that are all 1 (the usual profile) need only the number of common tokens.
    dot = F.when(
        plain, F.size(F.array_intersect("left_tokens", "right_tokens")).cast("bigint")
    ).otherwise(pair_dot(F.col("left_terms"), F.col("right_terms")))
    score = F.col("dot") / norm_product("left_sq", "right_sq")
    with_left = attached(candidates, side("left"), "left_id", "right_id")
    right_ids = candidates.groupBy("right_id").agg(F.count(F.lit(1)).alias("n"))
    rights = side("right").join(right_ids, "right_id")
    return (
        weighted_lookup(with_left, rights, ["right_id"], "n", "left_id")
        .select("left_id", "right_id", "left_sq", "right_sq", dot.alias("dot"))
        .select("left_id", "right_id", score.alias("score"))
        .filter(F.col("score") >= min_score)
    )


def pair_metrics(pairs: DataFrame, left: str, right: str, strict: bool = False) -> DataFrame:
    """Add cosine, euclidean and manhattan of two number arrays per row."""
    a, b = F.col(left), F.col(right)
    return pairs.select(
        "*",
        V.cosine(a, b, strict).alias(COSINE),
        V.euclidean(a, b, strict).alias(EUCLIDEAN),
        V.manhattan(a, b, strict).alias(MANHATTAN),
    )


def _dense_scores(rows: np.ndarray, asked: np.ndarray, metric: str) -> np.ndarray:
    if metric == COSINE:
        norms = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(asked, axis=1)[None, :]
        return np.divide(rows @ asked.T, norms, out=np.zeros(norms.shape), where=norms > 0)
    gaps = (rows[:, None, :] - q[None, None, :] for q in asked)
    if metric == EUCLIDEAN:
        return np.concatenate([np.sqrt((g * g).sum(axis=2)) for g in gaps], axis=1)
    return np.concatenate([np.abs(g).sum(axis=2) for g in gaps], axis=1)


def dense_nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    entity: str,
    vector: str,
    metric: str = COSINE,
    digits: int = 9,
) -> DataFrame:
    """The k nearest dense vectors of each query: (query_id, entity, score, rank).

    Each task multiplies its batches of the corpus with a block of queries and
    passes on k rows per query and batch; pairs are never rows. One block is sent
    along with the task. More queries are cut into blocks, and every block meets
    every slice of the corpus in a task of its own. Scores are rounded to
    ``digits`` before ranking, so that equal vectors tie.
    """
    check_k(k)
    check_metric(metric)
    types = {f.name: f.dataType.simpleString() for f in [*queries.schema, *corpus.schema]}
    out = f"{query_id} {types[query_id]}, {entity} {types[entity]}, score double"
    sign = -1.0 if metric == COSINE else 1.0

    def best_of(names: np.ndarray, rows: np.ndarray, ids: np.ndarray, asked: np.ndarray) -> pd.DataFrame:
        scores = np.round(_dense_scores(rows, asked, metric), digits)
        best = [np.lexsort((names, sign * scores[:, j]))[:k] for j in range(len(ids))]
        return pd.DataFrame(
            {
                query_id: np.repeat(ids, [len(b) for b in best]),
                entity: np.concatenate([names[b] for b in best]),
                "score": np.concatenate([scores[b, j] for j, b in enumerate(best)]),
            }
        )

    def stacked(column: pd.Series) -> np.ndarray:
        return np.array(column.tolist(), dtype=np.float64)

    held, asked = corpus.select(entity, vector), queries.select(query_id, vector)
    if fits_broadcast(asked, DENSE_QUERY_BLOCK):
        block = asked.toPandas()
        ids, matrix = block[query_id].to_numpy(), stacked(block[vector])

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch) and len(ids):
                    yield best_of(batch[entity].to_numpy(), stacked(batch[vector]), ids, matrix)

        result = held.mapInPandas(whole, out)
    else:
        n_blocks = -(-asked.count() // DENSE_QUERY_BLOCK)
        n_slices = -(-held.count() // DENSE_SLICE)

        def part(column: str, parts: int) -> Column:
            return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")

        def met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({query_id: [], entity: [], "score": []})
            return best_of(
                left[entity].to_numpy(), stacked(left[vector]), right[query_id].to_numpy(), stacked(right[vector])
            )

        slices = held.withColumn("slice", part(entity, n_slices)).withColumn("block", F.explode(salts(n_blocks)))
        blocks = asked.withColumn("block", part(query_id, n_blocks)).withColumn("slice", F.explode(salts(n_slices)))
        result = (
            slices.groupBy("block", "slice").cogroup(blocks.groupBy("block", "slice")).applyInPandas(met, out)
        )
    return top_k(result, k, "score", [entity], [query_id], largest=metric == COSINE)
