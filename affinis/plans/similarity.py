"""Queries on similarity, distance and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions import vectors as V
from affinis.operators import approximate, topk
from affinis.operators import similarity as sim
from affinis.operators import vocabulary as voc
from affinis.operators.ordering import positions
from affinis.plans import orders_profile as op
from affinis.plans.registry import query, table
from affinis.plans.text import SQL_DOC_TERMS
from affinis.session import written

ENTITY = op.SPEC.entity

SQL_LEADING = """leaders AS (SELECT c_custkey AS id FROM customer
  QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1)"""


def leading_customers(spark, sf):
    """The customer with the largest balance in each nation."""
    best = topk.top_k(table(spark, sf, "customer"), 1, "c_acctbal", ["c_custkey"], ["c_nationkey"])
    return best.select(F.col("c_custkey").alias(ENTITY))


def profile_vectors(spark, sf):
    features = written(op.features(spark, sf).select(ENTITY, op.SPEC.text), "features")
    return written(voc.term_vectors(features, ENTITY, op.SPEC.text, stemming=False), "vectors")


def leading_vectors(spark, sf, vectors):
    leading = vectors.join(F.broadcast(leading_customers(spark, sf)), ENTITY)  # one row per nation
    return written(leading.withColumnRenamed(ENTITY, "query_id"), "leading")


@query(
    "cosine_to_references",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING}
    SELECT q.id AS query_id, c.id AS id_municipio,
      round(sum(a.cnt * b.cnt) / sqrt(max(q.sq)::DOUBLE * max(c.sq)::DOUBLE), 6) AS score
    FROM leaders l JOIN terms a ON l.id = a.id JOIN vectors q ON q.id = l.id
    JOIN terms b ON a.token = b.token JOIN vectors c ON c.id = b.id GROUP BY q.id, c.id""",
)
def cosine_to_references(spark, sf):
    vectors = profile_vectors(spark, sf)
    scores = sim.cosine_scores(leading_vectors(spark, sf, vectors), vectors, "query_id", ENTITY)
    return scores.withColumn("score", F.round("score", 6))


def _sql_nearest(metric: str, order: str) -> str:
    return f"""WITH {SQL_DOC_TERMS},
    ask AS (SELECT item_id, token, count(*) AS cnt FROM
      (SELECT item_id, unnest({op.sql_tokens('text')}) AS token FROM benchmark) GROUP BY ALL),
    q AS (SELECT item_id, coalesce(sum(cnt * cnt), 0) AS q_sq, coalesce(sum(cnt), 0) AS q_l1
      FROM benchmark LEFT JOIN ask USING (item_id) GROUP BY item_id),
    d AS (SELECT doc_id, coalesce(sum(cnt * cnt), 0) AS sq, coalesce(sum(cnt), 0) AS l1
      FROM documents LEFT JOIN doc_terms USING (doc_id) GROUP BY doc_id),
    s AS (SELECT item_id, doc_id, sum(a.cnt * b.cnt) AS dot, sum(least(a.cnt, b.cnt)) AS ov
      FROM ask a JOIN doc_terms b USING (token) GROUP BY item_id, doc_id),
    m AS (SELECT item_id AS query_id, doc_id, {metric} AS x FROM q CROSS JOIN d LEFT JOIN s USING (item_id, doc_id))
    SELECT query_id, doc_id, round(x, 6) AS score, rank FROM (SELECT *, row_number() OVER
      (PARTITION BY query_id ORDER BY x {order}, doc_id) AS rank FROM m) WHERE rank <= 5"""


def _nearest(spark, sf, metric):
    corpus = written(voc.term_vectors(table(spark, sf, "documents"), "doc_id", "text", stemming=False), "corpus")
    asked = voc.term_vectors(table(spark, sf, "benchmark"), "item_id", "text", stemming=False)
    asked = written(asked.withColumnRenamed("item_id", "query_id"), "asked")
    return sim.nearest(asked, corpus, 5, "query_id", "doc_id", metric).withColumn("score", F.round("score", 6))


@query(
    "nearest_cosine",
    _sql_nearest("CASE WHEN q_sq * sq > 0 THEN coalesce(dot, 0) / sqrt(q_sq::DOUBLE * sq::DOUBLE) ELSE 0.0 END", "DESC"),
)
def nearest_cosine(spark, sf):
    return _nearest(spark, sf, sim.COSINE)


@query("nearest_euclidean", _sql_nearest("sqrt((q_sq + sq - 2 * coalesce(dot, 0))::DOUBLE)", ""))
def nearest_euclidean(spark, sf):
    return _nearest(spark, sf, sim.EUCLIDEAN)


@query("nearest_manhattan", _sql_nearest("(q_l1 + l1 - 2 * coalesce(ov, 0))::DOUBLE", ""))
def nearest_manhattan(spark, sf):
    return _nearest(spark, sf, sim.MANHATTAN)


@query("approximate_cosine")
def approximate_cosine(spark, sf):
    """Every hundredth document against all (tests measure what is missing; SQL has no such bands)."""
    corpus = written(voc.term_vectors(table(spark, sf, "documents"), "doc_id", "text", stemming=False), "corpus")
    asked = written(corpus.filter("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"), "asked")
    found = approximate.approximate_nearest(asked, corpus, 5, "query_id", "doc_id", exclude_self=True)
    return found.withColumn("score", F.round("score", 6))


SQL_PROFILES = op.SQL_TERMS + """,
keyed AS (SELECT id, string_agg(token || ' ' || cnt, ' ' ORDER BY token) AS k FROM terms GROUP BY id),
grouped AS MATERIALIZED (SELECT min(id) AS profile, count(*) AS n_members, k FROM keyed GROUP BY k)"""


@query("distinct_profiles", f"WITH {SQL_PROFILES} SELECT profile, n_members FROM grouped")
def distinct_profiles(spark, sf):
    return sim.distinct_profiles(profile_vectors(spark, sf), ENTITY).select("profile", "n_members")


@query(
    "profile_members",
    f"WITH {SQL_PROFILES} SELECT profile, id AS id_municipio FROM keyed JOIN grouped USING (k)",
)
def profile_members(spark, sf):
    vectors = profile_vectors(spark, sf)
    return sim.profile_members(vectors, sim.distinct_profiles(vectors, ENTITY), ENTITY)


@query(
    "similar_profiles",
    f"""WITH {SQL_PROFILES}, pt AS (SELECT profile, token, cnt FROM grouped JOIN terms ON id = profile)
    SELECT a.profile AS left_id, b.profile AS right_id,
      round(sum(a.cnt * b.cnt) / sqrt(max(x.sq)::DOUBLE * max(y.sq)::DOUBLE), 6) AS score
    FROM pt a JOIN pt b ON a.token = b.token AND a.profile < b.profile
    JOIN vectors x ON x.id = a.profile JOIN vectors y ON y.id = b.profile
    GROUP BY a.profile, b.profile
    HAVING sum(a.cnt * b.cnt) / sqrt(max(x.sq)::DOUBLE * max(y.sq)::DOUBLE) >= 0.85""",
)
def similar_profiles(spark, sf):
    profiles = written(sim.distinct_profiles(profile_vectors(spark, sf), ENTITY), "profiles")
    return sim.similar_profiles(profiles, 0.85).withColumn("score", F.round("score", 6))


@query(
    "similarity_submatrix",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING},
    dots AS (SELECT a.id AS left_id, b.id AS right_id, sum(a.cnt * b.cnt) AS dot
      FROM terms a JOIN terms b USING (token) WHERE a.id IN (FROM leaders) AND b.id IN (FROM leaders) GROUP BY ALL)
    SELECT l.id AS left_id, r.id AS right_id,
      round(coalesce(dot / sqrt(x.sq::DOUBLE * y.sq::DOUBLE), 0), 6) AS score
    FROM leaders l CROSS JOIN leaders r JOIN vectors x ON x.id = l.id JOIN vectors y ON y.id = r.id
    LEFT JOIN dots ON left_id = l.id AND right_id = r.id""",
)
def similarity_submatrix(spark, sf):
    vectors = profile_vectors(spark, sf)
    scores = sim.square_scores(vectors, leading_customers(spark, sf), ENTITY)
    return scores.withColumn("score", F.round("score", 6))


# -- dense vectors ------------------------------------------------------------

SQL_PAIRS = """pairs AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id,
  a.embedding::DOUBLE[] AS u, b.embedding::DOUBLE[] AS v FROM
  (SELECT *, lead(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS nxt FROM embeddings) a
  JOIN embeddings b ON b.vec_id = a.nxt)"""


def _pairs(spark, sf):
    """Each vector with the next one of its label."""
    dense = table(spark, sf, "embeddings")
    placed = written(positions(dense.select("label", "vec_id"), ["vec_id"], ["label"]), "placed")
    after = placed.select("label", (F.col("position") - 1).alias("position"), F.col("vec_id").alias("right_id"))
    ids = placed.withColumnRenamed("vec_id", "left_id").join(after, ["label", "position"]).select("left_id", "right_id")
    left = dense.select(F.col("vec_id").alias("left_id"), F.col("embedding").alias("u"))
    right = dense.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("v"))
    return ids.join(left, "left_id").join(right, "right_id")


@query(
    "vector_pair_metrics",
    f"""WITH {SQL_PAIRS} SELECT left_id, right_id, round(list_cosine_similarity(u, v), 6) AS cosine,
    round(list_distance(u, v), 6) AS euclidean,
    round(list_sum(list_transform(list_zip(u, v), lambda p: abs(p[1] - p[2]))), 6) AS manhattan FROM pairs""",
)
def vector_pair_metrics(spark, sf):
    scored = sim.pair_metrics(_pairs(spark, sf), "u", "v", strict=True)
    return scored.select("left_id", "right_id", *[F.round(m, 6).alias(m) for m in sim.METRICS])


@query(
    "normalised_distance_identity",
    f"""WITH {SQL_PAIRS} SELECT left_id, right_id, round(2 - 2 * list_cosine_similarity(u, v), 6) AS squared FROM pairs""",
)
def normalised_distance_identity(spark, sf):
    """Squared distance of the normalised vectors, which equals 2 - 2 cosine."""

    def unit(name):
        norm = V.norm_l2(F.col(name))
        return F.transform(F.col(name), lambda x: x.cast("double") / norm)

    gap = V.euclidean(unit("u"), unit("v"))
    return _pairs(spark, sf).select("left_id", "right_id", F.round(gap * gap, 6).alias("squared"))


@query(
    "vector_norms",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(e, lambda x: x * x))), 6) AS l2,
    round(list_sum(list_transform(e, lambda x: abs(x))), 6) AS l1,
    CAST(len(e) AS BIGINT) AS n FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)""",
)
def vector_norms(spark, sf):
    """Norms of the vectors after a round trip through the ML vector type."""
    dense = table(spark, sf, "embeddings").withColumn("e", V.vector_to_array(V.array_to_vector(F.col("embedding"))))
    e = F.col("e")
    return dense.select(
        "vec_id", F.round(V.norm_l2(e), 6).alias("l2"), F.round(V.norm_l1(e), 6).alias("l1"),
        F.size(e).cast("bigint").alias("n"),
    )


SQL_CENTROIDS = """parts AS (SELECT label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(v) AS m FROM parts GROUP BY label, i),
centroids AS MATERIALIZED (SELECT label AS query_id, list(m ORDER BY i) AS c FROM means GROUP BY label)"""


def _centroids(spark, sf):
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda p: p["m"]).alias("embedding"))


def _sql_dense(score: str, order: str) -> str:
    return f"""WITH {SQL_CENTROIDS}, s AS (SELECT query_id, vec_id, round({score}, 9) AS x
      FROM centroids CROSS JOIN (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))
    SELECT query_id, vec_id, round(x, 6) AS score, rank FROM (SELECT *, row_number() OVER
      (PARTITION BY query_id ORDER BY x {order}, vec_id) AS rank FROM s) WHERE rank <= 5"""


def _dense(spark, sf, metric):
    found = sim.dense_nearest(
        _centroids(spark, sf), table(spark, sf, "embeddings").select("vec_id", "embedding"), 5, "query_id", "vec_id",
        "embedding", metric,
    )
    return found.withColumn("score", F.round("score", 6))


@query("dense_nearest_cosine", _sql_dense("list_cosine_similarity(c, e)", "DESC"))
def dense_nearest_cosine(spark, sf):
    return _dense(spark, sf, sim.COSINE)


@query("dense_nearest_euclidean", _sql_dense("list_distance(c, e)", ""))
def dense_nearest_euclidean(spark, sf):
    return _dense(spark, sf, sim.EUCLIDEAN)


@query(
    "dense_nearest_manhattan",
    _sql_dense("list_sum(list_transform(list_zip(c, e), lambda p: abs(p[1] - p[2])))", ""),
)
def dense_nearest_manhattan(spark, sf):
    return _dense(spark, sf, sim.MANHATTAN)


# -- top-k --------------------------------------------------------------------


@query(
    "top_k_largest",
    """SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank
    FROM orders WHERE o_orderpriority <> '1-URGENT' QUALIFY rank <= 10""",
)
def top_k_largest(spark, sf):
    best = topk.top_k_largest(
        table(spark, sf, "orders"), 10, "o_totalprice", ["o_orderkey"], exclude=F.col("o_orderpriority") == "1-URGENT"
    )
    return best.select("o_orderkey", "o_custkey", "o_totalprice", "rank")


@query(
    "top_k_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
    FROM orders QUALIFY rank <= 5""",
)
def top_k_per_group(spark, sf):
    best = topk.top_k_largest(table(spark, sf, "orders"), 5, "o_totalprice", ["o_orderkey"], ["o_orderpriority"])
    return best.select("o_orderpriority", "o_orderkey", "o_totalprice", "rank")


@query(
    "top_k_smallest",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag
      ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank
    FROM lineitem QUALIFY rank <= 5""",
)
def top_k_smallest(spark, sf):
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    best = topk.top_k_smallest(table(spark, sf, "lineitem"), 5, "l_extendedprice", ties, ["l_returnflag"])
    return best.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "rank")
