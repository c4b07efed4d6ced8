"""Text to term counts: tokens, stems, a fitted vocabulary, one vector row per entity.

A vector row holds ``terms`` (array of (token, cnt), sorted by token), ``sq`` (the
sum of squared counts) and ``l1`` (the sum of counts). Entities without a known token keep a
row with no terms. ``term_vectors`` leaves rows partitioned by entity, so later
sums per (query, entity) need no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.stem import add_stem
from affinis.functions.text import tokens
from affinis.operators.joins import salted_lookup, weighted_lookup
from affinis.operators.ordering import positions
from affinis.session import written

TOP_TOKENS = 20
TASK_LETTERS = 4 << 20  # letters of text whose counted tokens one task holds


def token_counts(df: DataFrame, entity: str, text: str) -> DataFrame:
    """(entity, token, cnt); an entity without tokens gives one row with a NULL token.

    The one shuffle moves each text to its entity's partition, which costs fewer bytes
    than its counted tokens would; counts, and vectors of them, are then made in place.
    There are as many partitions as the measured letters need, since counted tokens take
    many times the room of their text. ``df`` is read twice: pass a loaded or written table.
    """
    letters = df.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    laid_out = df.select(entity, text).repartition(max(1, -(-letters // TASK_LETTERS)), entity)
    rows = laid_out.select(entity, F.explode_outer(tokens(F.col(text))).alias("token"))
    return rows.groupBy(entity, "token").agg(F.count("token").alias("cnt"))


def stemmed_counts(counts: DataFrame, entity: str) -> DataFrame:
    """Counts of stems. Every distinct token is stemmed once, then looked up by its rows."""
    words = (
        counts.filter(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    )
    stems = add_stem(words, "token", "stem")
    known = weighted_lookup(counts.filter(F.col("token").isNotNull()), stems, ["token"], "df", entity)
    empty = counts.filter(F.col("token").isNull())  # texts without a token
    return (
        known.select(entity, F.col("stem").alias("token"), "cnt")
        .unionByName(empty)
        .groupBy(entity, "token")
        .agg(F.sum("cnt").alias("cnt"))
    )


def text_counts(df: DataFrame, entity: str, text: str, stemming: bool = True) -> DataFrame:
    counts = token_counts(df, entity, text)
    return stemmed_counts(counts, entity) if stemming else counts


def token_statistics(counts: DataFrame) -> DataFrame:
    """(token, tf, df): total and document frequency, from one row per (entity, token)."""
    return (
        counts.filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.sum("cnt").alias("tf"), F.count(F.lit(1)).alias("df"))
    )


def fit_vocabulary(
    counts: DataFrame,
    n_entities: int | None = None,
    max_features: int | None = None,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
) -> DataFrame:
    """(token, idx, tf, df) with indexes in token order.

    ``min_df`` and ``max_df`` are numbers of entities when whole, shares when
    fractional; ``max_features`` keeps the most frequent tokens, ties by token.
    ``n_entities`` is needed for a share other than 1.0; it is counted if absent.
    """
    entity = next(c for c in counts.columns if c not in ("token", "cnt"))

    def as_count(limit: int | float) -> float:
        nonlocal n_entities
        if isinstance(limit, int):
            return limit
        if n_entities is None:
            n_entities = counts.select(entity).distinct().count()
        return limit * n_entities

    kept = token_statistics(counts)
    if min_df != 1 or isinstance(min_df, float):
        kept = kept.filter(F.col("df") >= as_count(min_df))
    if not (isinstance(max_df, float) and max_df == 1.0):
        kept = kept.filter(F.col("df") <= as_count(max_df))
    if max_features is not None:
        kept = kept.orderBy(F.desc("tf"), "token").limit(max_features)
    kept = written(kept, "vocabulary")  # numbering reads it several times
    return positions(kept, ["token"], name="idx").select("token", "idx", "tf", "df")


def known_counts(counts: DataFrame, vocabulary: DataFrame, entity: str) -> DataFrame:
    """Counts restricted to a frozen vocabulary; entities stay, with a NULL token if need be."""
    words = vocabulary.select("token", F.lit(True).alias("__known"))
    return salted_lookup(counts, words, ["token"], entity, "left", narrow=True).select(
        entity,
        F.when(F.col("__known"), F.col("token")).alias("token"),
        F.when(F.col("__known"), F.col("cnt")).otherwise(F.lit(0)).alias("cnt"),
    )


def count_vectors(counts: DataFrame, entity: str) -> DataFrame:
    """One row per entity from its counts."""
    term = F.when(F.col("token").isNotNull(), F.struct("token", "cnt"))
    return counts.groupBy(entity).agg(
        F.sort_array(F.collect_list(term)).alias("terms"),
        F.sum(F.col("cnt") * F.col("cnt")).alias("sq"),
        F.sum("cnt").alias("l1"),
    )


def term_vectors(
    df: DataFrame,
    entity: str,
    text: str,
    stemming: bool = True,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """(entity, terms, sq, l1) of each text, restricted to ``vocabulary`` if given."""
    counts = text_counts(df, entity, text, stemming)
    if vocabulary is not None:
        counts = known_counts(counts, vocabulary, entity)
    return count_vectors(counts, entity)


def require_tokens(vocabulary: DataFrame) -> None:
    if vocabulary.isEmpty():
        raise ValueError("empty vocabulary: no text holds a token within the limits")


def indexed_terms(vectors: DataFrame, vocabulary: DataFrame, entity: str) -> DataFrame:
    """Long sparse matrix (entity, idx, token, cnt)."""
    terms = vectors.select(entity, F.inline("terms"))
    known = vocabulary.select("token", "idx")
    return salted_lookup(terms, known, ["token"], entity, narrow=True).select(entity, "idx", "token", "cnt")


def density(counts: DataFrame, entity: str) -> DataFrame:
    """One row: n_entities, n_tokens, n_nonzero and the share of nonzero cells."""
    per_entity = counts.groupBy(entity).agg(F.count("token").alias("n"))
    sizes = per_entity.agg(F.count(F.lit(1)).alias("n_entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_nonzero"))
    n_tokens = token_statistics(counts).agg(F.count(F.lit(1))).scalar()
    return sizes.withColumn("n_tokens", n_tokens).select(
        "n_entities",
        "n_tokens",
        "n_nonzero",
        F.try_divide(F.col("n_nonzero"), F.col("n_entities").cast("double") * F.col("n_tokens")).alias("density"),
    )


def tf_idf(counts: DataFrame, entity: str) -> DataFrame:
    """(entity, token, cnt, weight): counts times ln((1 + n) / (1 + df)) + 1, over the n entities of the counts.

    ``counts`` is read several times: pass a written table when it is dear to compute.
    """
    n = counts.select(entity).distinct().count()
    idf = F.log((1.0 + n) / (1 + F.col("df"))) + 1
    weighted = token_statistics(counts).select("token", "df", idf.alias("idf"))
    known = weighted_lookup(counts.filter(F.col("token").isNotNull()), weighted, ["token"], "df", entity)
    return known.select(entity, "token", "cnt", (F.col("cnt") * F.col("idf")).alias("weight"))


def top_tokens(statistics: DataFrame, n: int = TOP_TOKENS) -> DataFrame:
    """The ``n`` most frequent tokens, ties by token."""
    return statistics.orderBy(F.desc("tf"), "token").limit(n)
