"""Recommendations for tables of queries, over a profile index loaded once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.text import shown_specialty, words
from affinis.operators import lookup
from affinis.operators.joins import attached, weighted_lookup
from affinis.operators.quality import consistency, require_columns
from affinis.operators.similarity import nearest, norm_product, pair_dot, pair_overlap
from affinis.operators.topk import DEFAULT_K, check_k
from affinis.operators.vocabulary import count_vectors, fit_vocabulary, known_counts, term_vectors, text_counts
from affinis.session import written
from affinis.spec import LIVESTOCK, ProfileSpec

# Fixed value: letters of a name that a listing shows.
SHOWN_LETTERS = 33
NO_KNOWN_TOKEN = "no_known_token"


@dataclass(frozen=True)
class ProfileIndex:
    """Feature table and term vectors that belong together.

    Both are read by every query: pass loaded or written tables.
    """

    features: DataFrame
    vectors: DataFrame
    spec: ProfileSpec = LIVESTOCK
    stemming: bool = True
    fitted: DataFrame | None = None  # the vocabulary, where it was saved with the vectors

    @classmethod
    def build(cls, features: DataFrame, spec: ProfileSpec = LIVESTOCK, stemming: bool = True) -> ProfileIndex:
        """Fit on a feature table; the vectors are written once."""
        require_columns(features, [spec.entity, spec.text])
        vectors = written(term_vectors(features, spec.entity, spec.text, stemming), "vectors")
        if vectors.filter(F.col("l1") > 0).isEmpty():
            raise ValueError("empty vocabulary: no profile text holds a token")
        return cls(features, vectors, spec, stemming)

    @property
    def vocabulary(self) -> DataFrame:
        """(token, idx, tf, df) of the vectors."""
        if self.fitted is not None:
            return self.fitted
        return fit_vocabulary(self.vectors.select(self.spec.entity, F.inline("terms")))

    def check(self) -> None:
        """Raise when features and vectors do not hold the same entities."""
        consistency(self.features, self.vectors, self.spec.entity, strict=True)

    # -- recommendations ---------------------------------------------------

    def by_entity(self, queries: DataFrame, k: int = DEFAULT_K, other_groups_only: bool = False) -> DataFrame:
        """The k most similar entities of each distinct entity in ``queries``, itself left out.

        ``other_groups_only`` also leaves out the entity's own group.
        """
        check_k(k)
        spec = self.spec
        group = spec.group if other_groups_only else None
        vectors = self._grouped(self.vectors) if group else self.vectors
        asked = written(
            vectors.join(lookup.small(queries.select(spec.entity).distinct()), spec.entity).withColumnRenamed(
                spec.entity, "query_id"
            ),
            "queries",
        )
        best = nearest(asked, vectors, k, "query_id", spec.entity, exclude_self=True, group=group)
        return self._described(best)

    def by_name(
        self, queries: DataFrame, k: int = DEFAULT_K, other_groups_only: bool = False, strict: bool = False
    ) -> DataFrame:
        """As :meth:`by_entity` for (query_id, name, group).

        Unresolved names give no rows (``lookup.resolve_names`` tells their status), or
        an error in strict mode.
        """
        return self._by_resolved(lookup.resolve_names(queries, self.features, self.spec, strict=strict), k, other_groups_only)

    def by_code(
        self, queries: DataFrame, k: int = DEFAULT_K, other_groups_only: bool = False, strict: bool = False
    ) -> DataFrame:
        """As :meth:`by_entity` for (query_id, code); unresolved codes as in :meth:`by_name`."""
        return self._by_resolved(lookup.resolve_codes(queries, self.features, self.spec, strict=strict), k, other_groups_only)

    def by_text(self, queries: DataFrame, k: int = DEFAULT_K, strict: bool = False) -> DataFrame:
        """The k most similar entities of a free profile text (query_id, text).

        A query without a known token gives no rows (see :meth:`text_status`),
        or an error in strict mode.
        """
        check_k(k)
        asked = written(self._transformed(queries), "queries")
        if strict:
            lost = asked.filter(F.col("l1") == 0).first()
            if lost is not None:
                raise ValueError(f"query {lost['query_id']} holds no token of the vocabulary")
        best = nearest(asked.filter(F.col("l1") > 0), self.vectors, k, "query_id", self.spec.entity)
        return self._described(best)

    def text_status(self, queries: DataFrame) -> DataFrame:
        """(query_id, status, n_tokens) of free profile texts against the vocabulary."""
        status = F.when(F.col("l1") > 0, lookup.FOUND).otherwise(NO_KNOWN_TOKEN)
        return self._transformed(queries).select("query_id", status.alias("status"), F.col("l1").alias("n_tokens"))

    def explain(self, pairs: DataFrame) -> DataFrame:
        """Metrics on the vectors, and tokens of the raw texts, for (left_id, right_id) pairs.

        ``pairs`` is read several times: pass a loaded or written table.
        """
        left, right = self._side("left"), self._side("right")
        wanted = pairs.select("left_id", "right_id")
        asked = wanted.groupBy("right_id").agg(F.count(F.lit(1)).alias("n"))
        both = weighted_lookup(
            attached(wanted, left, "left_id", "right_id"), right.join(asked, "right_id"), ["right_id"], "n", "left_id"
        )
        dot = pair_dot(F.col("left_terms"), F.col("right_terms"))
        overlap = pair_overlap(F.col("left_terms"), F.col("right_terms"))
        norms = norm_product("left_sq", "right_sq")
        return (
            both.withColumns({"__dot": dot, "__overlap": overlap})
            .select(
                "left_id",
                "left_name",
                "left_group",
                "right_id",
                "right_name",
                "right_group",
                F.when(norms > 0, F.col("__dot") / norms).alias("cosine"),
                F.sqrt((F.col("left_sq") + F.col("right_sq") - 2 * F.col("__dot")).cast("double")).alias("euclidean"),
                (F.col("left_l1") + F.col("right_l1") - 2 * F.col("__overlap")).cast("double").alias("manhattan"),
                F.array_sort(F.array_intersect("left_tokens", "right_tokens")).alias("common"),
                F.array_sort(F.array_except("left_tokens", "right_tokens")).alias("left_only"),
                F.array_sort(F.array_except("right_tokens", "left_tokens")).alias("right_only"),
            )
        )

    def explain_references(self, pairs: DataFrame, strict: bool = True) -> DataFrame:
        """As :meth:`explain` for (query_id, left_ref, left_group, right_ref, right_group): names or codes.

        A reference without a single entity is an error, or its pair gives no row.
        """
        found = None
        for side in ("left", "right"):
            asked = pairs.select("query_id", F.col(f"{side}_ref").alias("ref"), F.col(f"{side}_group").alias("group"))
            one = lookup.resolve_references(asked, self.features, self.spec, strict).filter(F.col("status") == lookup.FOUND)
            one = one.select("query_id", F.col(self.spec.entity).alias(f"{side}_id"))
            found = one if found is None else found.join(one, "query_id")
        return self.explain(written(found.select("left_id", "right_id").distinct(), "pairs"))

    # -- parts -------------------------------------------------------------

    def _grouped(self, vectors: DataFrame) -> DataFrame:
        return vectors.join(self.features.select(self.spec.entity, self.spec.group), self.spec.entity)

    def _transformed(self, queries: DataFrame) -> DataFrame:
        """Vectors of free texts. Which of their tokens are known takes one scan of the index."""
        counts = text_counts(queries, "query_id", "text", self.stemming)
        asked = lookup.small(counts.select("token").distinct())
        held = self.vectors.select(F.explode("terms.token").alias("token")) if self.fitted is None else self.fitted.select("token")
        known = written(held.join(asked, "token", "left_semi").distinct(), "known")
        return count_vectors(known_counts(counts, known, "query_id"), "query_id")

    def _by_resolved(self, resolved: DataFrame, k: int, other_groups_only: bool) -> DataFrame:
        found = written(
            resolved.filter(F.col("status") == lookup.FOUND).select(
                F.col("query_id").alias("ref_id"), F.col(self.spec.entity)
            ),
            "resolved",
        )
        best = self.by_entity(found, k, other_groups_only)
        asked = found.withColumnRenamed(self.spec.entity, "query_id")
        return best.join(asked, "query_id").drop("query_id").withColumnRenamed("ref_id", "query_id")

    def _side(self, prefix: str) -> DataFrame:
        spec = self.spec
        return self.features.join(self.vectors, spec.entity).select(
            F.col(spec.entity).alias(f"{prefix}_id"),
            F.col(spec.name).alias(f"{prefix}_name"),
            F.col(spec.group).alias(f"{prefix}_group"),
            words(F.col(spec.text)).alias(f"{prefix}_tokens"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("terms", "sq", "l1")],
        )

    def _described(self, best: DataFrame) -> DataFrame:
        """Attributes for the rows kept, k per query; they are written so that the search runs once."""
        spec = self.spec
        best = written(best, "best")
        shown = [c for c in (spec.name, *spec.context, spec.specialty, spec.text) if c in self.features.columns]
        return self.features.select(spec.entity, *dict.fromkeys(shown)).join(lookup.small(best), spec.entity)


def shown(recommendations: DataFrame, spec: ProfileSpec = LIVESTOCK) -> DataFrame:
    """Columns of a listing: shortened names, readable specialty."""

    def short(column: str) -> Column:
        return F.substring(F.col(column), 1, SHOWN_LETTERS).alias(column)

    return recommendations.select(
        "query_id",
        "rank",
        "score",
        spec.entity,
        spec.group,
        short(spec.name),
        short(spec.context[-1]),
        shown_specialty(F.col(spec.specialty), spec.specialty_word).alias(spec.specialty),
    )
