"""Queries on spatial statistics: the first two components of a vector are its place, the third is its value."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.operators import spatial
from affinis.plans.registry import query, table
from affinis.session import written

NEIGHBOURS = 6

SQL_POINTS = """pt AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
  CAST(embedding[3] AS DOUBLE) AS v, embedding::DOUBLE[] AS e FROM embeddings)"""
SQL_EDGES = f"""{SQL_POINTS}, edge AS MATERIALIZED (SELECT *, 1.0::DOUBLE / {NEIGHBOURS} AS w FROM (
  SELECT a.id AS i, b.id AS j, row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS rank,
  sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM pt a JOIN pt b ON a.id <> b.id) WHERE rank <= {NEIGHBOURS})"""
SQL_SHUFFLED = f"""{SQL_EDGES}, node AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) AS pos, v - avg(v) OVER () AS z FROM pt),
drawn AS MATERIALIZED (SELECT id, 0 AS perm, id AS source, z FROM node UNION ALL
  SELECT s.id, s.perm, n.id, n.z FROM (SELECT id, perm, row_number() OVER (PARTITION BY perm ORDER BY md5('{spatial.SEED}:' || perm || ':' || id), id) AS pos
    FROM node CROSS JOIN range(1, {spatial.PERMUTATIONS + 1}) AS t(perm)) s JOIN node n USING (pos))"""


def points(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), e[2].cast("double").alias("value"), e.alias("vector"))


def edges(spark, sf):
    return written(spatial.nearest_neighbours(points(spark, sf), NEIGHBOURS), "edges")


@query("spatial_neighbours", f"WITH {SQL_EDGES} SELECT i, j, CAST(rank AS INTEGER) AS rank, round(distance, 9) AS distance, round(w, 9) AS w FROM edge")
def spatial_neighbours(spark, sf):
    found = spatial.nearest_neighbours(points(spark, sf), NEIGHBOURS)
    return found.withColumns({c: F.round(c, 9) for c in ("distance", "w")})


@query(
    "global_moran",
    f"""WITH {SQL_SHUFFLED}, m AS (SELECT a.perm, round((SELECT count(*) FROM node) * sum(w * a.z * b.z) / (sum(w) * (SELECT sum(z * z) FROM node)), {spatial.DIGITS}) AS idx
      FROM edge JOIN drawn a ON a.id = edge.i JOIN drawn b ON b.id = edge.j AND b.perm = a.perm GROUP BY a.perm),
    c AS (SELECT (SELECT idx FROM m WHERE perm = 0) AS moran_i, count(*) FILTER (perm > 0 AND idx >= (SELECT idx FROM m WHERE perm = 0)) AS above FROM m)
    SELECT (SELECT count(*) FROM node) AS n, round(moran_i, 6) AS moran_i, round(-1.0 / ((SELECT count(*) FROM node) - 1), 9)::DOUBLE AS expected,
    round((least(above, {spatial.PERMUTATIONS} - above) + 1) / {spatial.PERMUTATIONS + 1}, 9)::DOUBLE AS p_value FROM c""",
)
def global_moran(spark, sf):
    found = spatial.global_moran(edges(spark, sf), points(spark, sf))
    return found.withColumns({"moran_i": F.round("moran_i", 6), "expected": F.round("expected", 9), "p_value": F.round("p_value", 9)})


@query(
    "local_moran",
    f"""WITH {SQL_SHUFFLED}, lag AS MATERIALIZED (SELECT i, a.perm, sum(w * CASE WHEN b.source = edge.i AND b.perm > 0 THEN a.z ELSE b.z END) AS lag
      FROM edge JOIN drawn a ON a.id = edge.i JOIN drawn b ON b.id = edge.j AND b.perm = a.perm GROUP BY i, a.perm),
    s AS MATERIALIZED (SELECT id, perm, z, lag, round(z * lag / (SELECT avg(z * z) FROM node), {spatial.DIGITS}) AS score FROM lag JOIN node ON node.id = lag.i),
    o AS (SELECT * FROM s WHERE perm = 0), c AS (SELECT s.id, count(*) FILTER (s.score >= o.score) AS above FROM s JOIN o USING (id) WHERE s.perm > 0 GROUP BY s.id),
    p AS (SELECT o.*, (least(above, {spatial.PERMUTATIONS} - above) + 1) / {spatial.PERMUTATIONS + 1}::DOUBLE AS p_value FROM o JOIN c USING (id)),
    r AS (SELECT *, p_value * count(*) OVER () / count(*) OVER (ORDER BY p_value) AS raw FROM p)
    SELECT id, round(lag, 6) AS lag, round(score, 6) AS local_i, CASE WHEN z > 0 AND lag > 0 THEN 1 WHEN lag > 0 THEN 2 WHEN z <= 0 THEN 3 ELSE 4 END AS quadrant,
    round(p_value, 9) AS p_value, round(least(1.0, min(raw) OVER (ORDER BY p_value DESC)), 9)::DOUBLE AS p_adjusted FROM r""",
)
def local_moran(spark, sf):
    found = spatial.local_moran(edges(spark, sf), points(spark, sf)).drop("z")
    return found.withColumns({"lag": F.round("lag", 6), "local_i": F.round("local_i", 6), "p_value": F.round("p_value", 9), "p_adjusted": F.round("p_adjusted", 9)})


@query(
    "neighbour_similarity",
    f"""WITH {SQL_EDGES}, u AS (SELECT unnest(e) / sqrt(list_sum(list_transform(e, lambda x: x * x))) AS x, unnest(range(len(e))) AS k FROM pt),
    l AS (SELECT sum(s * s) AS length FROM (SELECT k, sum(x) AS s FROM u GROUP BY k)), n AS (SELECT count(*) AS n FROM pt)
    SELECT (SELECT count(*) FROM edge) AS n_edges, round((SELECT avg(list_cosine_similarity(a.e, b.e)) FROM edge JOIN pt a ON a.id = i JOIN pt b ON b.id = j), 6) AS neighbour_mean,
    CAST(n * (n - 1) // 2 AS BIGINT) AS n_pairs, round((length - n) / (n * (n - 1.0::DOUBLE)), 6) AS global_mean FROM l CROSS JOIN n""",
)
def neighbour_similarity(spark, sf):
    found = spatial.neighbour_similarity(edges(spark, sf), points(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("neighbour_mean", "global_mean")})
