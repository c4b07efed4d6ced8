"""Queries that look up, recommend and explain."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions.text import snake_token
from affinis.operators import lookup, recommend
from affinis.operators.topk import top_k
from affinis.plans import orders_profile as op
from affinis.plans.registry import query, table
from affinis.plans.similarity import ENTITY, SQL_LEADING, leading_customers
from affinis.session import written

SPEC = op.SPEC


def index(spark, sf, stemming=False):
    return recommend.ProfileIndex.build(written(op.features(spark, sf), "features"), SPEC, stemming)


# -- tables of queries, all derived from the given tables ----------------------


def name_queries(spark, sf):
    """Leading customers by padded upper-case name, some with a group; suppliers are never found."""
    customers = (
        op.dimension(spark, sf)
        .join(leading_customers(spark, sf), ENTITY, "left_semi")
        .select(
            F.col(ENTITY).alias("query_id"),
            F.concat(F.lit(" "), F.upper(SPEC.name), F.lit("  ")).alias("name"),
            F.when(F.col("nome_regiao") != "ASIA", F.lower(SPEC.group)).alias("group"),
        )
    )
    leaders = top_k(table(spark, sf, "supplier"), 1, "s_acctbal", ["s_suppkey"], ["s_nationkey"])
    suppliers = leaders.select(
        (-1 - F.col("s_suppkey")).alias("query_id"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("group")
    )
    return customers.unionByName(suppliers)


SQL_NAME_QUERIES = SQL_LEADING + """,
asked AS (SELECT id_municipio AS query_id, ' ' || upper(nome_municipio) || '  ' AS name,
    CASE WHEN nome_regiao <> 'ASIA' THEN lower(sigla_uf) END AS "group" FROM dim WHERE id_municipio IN (FROM leaders)
  UNION ALL SELECT -1 - s_suppkey, s_name, NULL FROM (SELECT * FROM supplier
    QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) = 1)),
hits AS (SELECT query_id, count(*) AS n, min(id_municipio) AS first, string_agg(DISTINCT sigla_uf, ',' ORDER BY sigla_uf) AS groups
  FROM asked JOIN dim ON lower(trim(name)) = lower(nome_municipio) AND ("group" IS NULL OR upper("group") = sigla_uf)
  GROUP BY query_id),
resolved AS (SELECT query_id, name, "group",
    CASE WHEN n IS NULL THEN 'not_found' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status,
    CASE WHEN n = 1 THEN first END AS id_municipio, CASE WHEN n > 1 THEN groups END AS groups
  FROM asked LEFT JOIN hits USING (query_id))"""


@query("resolve_names", f"WITH {op.SQL_DIM}, {SQL_NAME_QUERIES} SELECT * FROM resolved")
def resolve_names(spark, sf):
    got = lookup.resolve_names(name_queries(spark, sf), op.dimension(spark, sf), SPEC)
    return got.withColumn("groups", F.array_join("groups", ","))


@query(
    "resolve_ambiguous_names",
    """WITH asked AS (SELECT DISTINCT p_name AS name FROM part)
    SELECT name, count(*) AS n, CASE WHEN count(*) = 1 THEN 'found' ELSE 'ambiguous' END AS status,
      CASE WHEN count(*) = 1 THEN min(p_partkey) END AS id_municipio,
      CASE WHEN count(*) > 1 THEN count(DISTINCT p_brand) END AS n_groups
    FROM asked JOIN part ON lower(p_name) = lower(name) GROUP BY name""",
)
def resolve_ambiguous_names(spark, sf):
    parts = _parts(spark, sf)
    sizes = parts.groupBy(F.col(SPEC.name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    asked = sizes.select(F.col("name").alias("query_id"), "name", F.lit(None).cast("string").alias("group"))
    got = lookup.resolve_names(asked, parts, SPEC)
    return got.join(sizes, "name").select(
        "name", "n", "status", ENTITY, F.when(F.col("groups").isNotNull(), F.size("groups")).cast("bigint").alias("n_groups")
    )


def code_queries(spark, sf):
    """Known codes as padded text, unknown ones, and texts that are no code."""
    leading = leading_customers(spark, sf)
    code = F.col(ENTITY).cast("string")
    return leading.select(
        F.explode(
            F.array(
                F.struct(code.alias("query_id"), F.concat(F.lit(" "), code).alias("code")),
                F.struct(F.concat(F.lit("far "), code).alias("query_id"), F.concat(code, F.lit("000000000")).alias("code")),
                F.struct(F.concat(F.lit("bad "), code).alias("query_id"), F.concat(code, F.lit("d")).alias("code")),
            )
        ).alias("q")
    ).select("q.*").filter("query_id <> 'far 0'")


@query(
    "resolve_codes",
    f"""WITH {SQL_LEADING}, asked AS (SELECT CAST(id AS VARCHAR) AS query_id, ' ' || id AS code FROM leaders
      UNION ALL SELECT 'far ' || id, id || '000000000' FROM leaders WHERE id <> 0 UNION ALL SELECT 'bad ' || id, id || 'd' FROM leaders)
    SELECT query_id, code, CASE WHEN TRY_CAST(code AS BIGINT) IS NULL THEN 'invalid'
      WHEN c_custkey IS NULL THEN 'not_found' ELSE 'found' END AS status, c_custkey AS id_municipio
    FROM asked LEFT JOIN customer ON TRY_CAST(code AS BIGINT) = c_custkey""",
)
def resolve_codes(spark, sf):
    return lookup.resolve_codes(code_queries(spark, sf), op.dimension(spark, sf), SPEC)


@query(
    "resolve_references",
    f"""WITH {SQL_LEADING}, asked AS (SELECT 'code ' || id AS query_id, CAST(id AS VARCHAR) AS ref FROM leaders
      UNION ALL SELECT 'name ' || id, lower(c_name) FROM leaders JOIN customer ON id = c_custkey)
    SELECT query_id, ref, 'found' AS status, CAST(split_part(query_id, ' ', 2) AS BIGINT) AS id_municipio FROM asked""",
)
def resolve_references(spark, sf):
    people = op.dimension(spark, sf)
    chosen = people.join(leading_customers(spark, sf), ENTITY, "left_semi")
    nobody = F.lit(None).cast("string").alias("group")
    codes = chosen.select(F.concat(F.lit("code "), ENTITY).alias("query_id"), F.col(ENTITY).cast("string").alias("ref"), nobody)
    names = chosen.select(F.concat(F.lit("name "), ENTITY).alias("query_id"), F.lower(SPEC.name).alias("ref"), nobody)
    return lookup.resolve_references(codes.unionByName(names), people, SPEC)


def _parts(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias(ENTITY), F.col("p_name").alias(SPEC.name), F.col("p_brand").alias(SPEC.group)
    )


SQL_WORDS = """asked AS (SELECT DISTINCT unnest(string_split(upper(p_name), ' ')) AS query_id FROM part)"""


def word_queries(spark, sf):
    """Every word of a part name, in upper case."""
    words = table(spark, sf, "part").select(F.explode(F.split(F.upper("p_name"), " ")).alias("query_id")).distinct()
    return words.withColumn("part", F.col("query_id"))


@query(
    "search_substring",
    f"""WITH {SQL_WORDS} SELECT query_id, p_partkey AS id_municipio, p_name AS nome_municipio, p_brand AS sigla_uf
    FROM asked JOIN part ON contains(lower(p_name), lower(query_id))
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY p_partkey) <= 10""",
)
def search_substring(spark, sf):
    return lookup.substring_hits(word_queries(spark, sf), _parts(spark, sf), 10, SPEC)


def misspelt_queries(spark, sf):
    """Every part name without its first vowel."""
    names = table(spark, sf, "part").select("p_name").distinct()
    return names.select(F.col("p_name").alias("query_id"), F.regexp_replace("p_name", "^([^aeiou]*)[aeiou]", "$1").alias("part"))


SQL_FUZZY = """asked AS (SELECT DISTINCT p_name AS query_id, regexp_replace(p_name, '^([^aeiou]*)[aeiou]', '\\1') AS part FROM part),
rated AS (SELECT query_id, part, n.p_name AS name, 1 - levenshtein(n.p_name, part) / greatest(length(n.p_name), length(part))::DOUBLE AS ratio
  FROM asked JOIN (SELECT DISTINCT p_name FROM part) n ON true)"""


@query(
    "search_fuzzy",
    f"""WITH {SQL_FUZZY} SELECT query_id, name AS nome_municipio, round(ratio, 6) AS ratio FROM rated WHERE ratio >= 0.7 - 1e-9
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ratio DESC, name DESC) <= 10""",
)
def search_fuzzy(spark, sf):
    """Names closest in edit distance."""
    hits = lookup.fuzzy_hits(misspelt_queries(spark, sf), _parts(spark, sf), 10, SPEC)
    return hits.withColumn("ratio", F.round("ratio", 6))


@query("search_ratio")
def search_ratio(spark, sf):
    """Names of the largest ratio of matching blocks (SQL has no such function; tests hold it against the standard library)."""
    hits = lookup.ratio_hits(misspelt_queries(spark, sf), _parts(spark, sf), 10, SPEC)
    return hits.withColumn("ratio", F.round("ratio", 6))


def misspelt_customers(spark, sf):
    """Every customer's name with its last digit lost."""
    return op.dimension(spark, sf).select(F.col(SPEC.name).alias("query_id"), F.expr(f"left({SPEC.name}, length({SPEC.name}) - 1)").alias("part"))


@query(
    "search_customers",
    """WITH c AS (SELECT c_custkey AS id, c_name AS name, left(c_name, length(c_name) - 1) AS part FROM customer)
    SELECT q.name AS query_id, c.id AS id_municipio, c.name AS nome_municipio FROM c q JOIN c ON contains(lower(c.name), lower(q.part))
    QUALIFY row_number() OVER (PARTITION BY q.name ORDER BY c.id) <= 3""",
)
def search_customers(spark, sf):
    """Substring search over names that are nearly all distinct."""
    hits = lookup.substring_hits(misspelt_customers(spark, sf), op.dimension(spark, sf), 3, SPEC)
    return hits.select("query_id", ENTITY, SPEC.name)


@query(
    "search_names",
    f"""WITH {SQL_FUZZY},
    exact AS (SELECT query_id, p_partkey AS id, p_name AS name, p_brand AS grp, 'substring' AS stage, NULL::DOUBLE AS ratio
      FROM asked JOIN part ON contains(lower(p_name), lower(trim(part)))
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY p_partkey) <= 10),
    short AS (SELECT query_id FROM asked LEFT JOIN exact USING (query_id) GROUP BY query_id HAVING count(id) < 10),
    hits AS (SELECT r.* FROM rated r JOIN short USING (query_id) WHERE ratio >= 0.7 - 1e-9
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ratio DESC, name DESC) <= 10),
    close AS (SELECT h.query_id, min(p_partkey) AS id, h.name, p_brand AS grp, 'fuzzy' AS stage, max(ratio) AS ratio
      FROM hits h JOIN part p ON p.p_name = h.name GROUP BY h.query_id, h.name, p_brand),
    both_ AS (SELECT * FROM exact UNION ALL SELECT * FROM close c
      WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.query_id = c.query_id AND e.name = c.name AND e.grp IS NOT DISTINCT FROM c.grp))
    SELECT query_id, rank, stage, name AS nome_municipio, grp AS sigla_uf FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY stage DESC, ratio DESC NULLS LAST,
        CASE WHEN stage = 'fuzzy' THEN name END DESC NULLS LAST, id) AS rank FROM both_) WHERE rank <= 10""",
)
def search_names(spark, sf):
    """Substring hits filled up with names closest in edit distance."""
    return lookup.search(misspelt_queries(spark, sf), _parts(spark, sf), 10, SPEC)


# -- recommendations ----------------------------------------------------------


def _sql_recommended(exclusion: str, asked: str = "SELECT id AS query_id, id FROM leaders", k: int = 5) -> str:
    return f"""dots AS (SELECT q.query_id, b.id, sum(a.cnt * b.cnt) AS dot
      FROM ({asked}) q JOIN terms a ON a.id = q.id JOIN terms b USING (token) GROUP BY ALL),
    scored AS (SELECT q.query_id, c.id_municipio, coalesce(dot / sqrt(x.sq::DOUBLE * y.sq::DOUBLE), 0.0) AS score
      FROM ({asked}) q JOIN features f ON f.id_municipio = q.id CROSS JOIN features c
      JOIN vectors x ON x.id = q.id JOIN vectors y ON y.id = c.id_municipio
      LEFT JOIN dots ON dots.query_id = q.query_id AND dots.id = c.id_municipio
      WHERE c.id_municipio <> q.id {exclusion}),
    recommended AS (SELECT query_id, id_municipio, round(score, 6) AS score,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id_municipio) AS rank FROM scored QUALIFY rank <= {k})"""


SHOWN = "nome_municipio, sigla_uf, nome_mesorregiao, nome_regiao, especializacao, tags"
OTHER_GROUPS = "AND (f.sigla_uf = c.sigla_uf) IS NOT TRUE"


def _shown(df):
    return df.select("query_id", "rank", ENTITY, F.round("score", 6).alias("score"), *SHOWN.split(", "))


@query(
    "recommend_by_entity",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING}, {_sql_recommended('')}
    SELECT query_id, rank, id_municipio, score, {SHOWN} FROM recommended JOIN features USING (id_municipio)""",
)
def recommend_by_entity(spark, sf):
    return _shown(index(spark, sf).by_entity(leading_customers(spark, sf)))


@query(
    "recommend_other_groups",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING}, {_sql_recommended(OTHER_GROUPS)}
    SELECT query_id, rank, id_municipio, score, {SHOWN} FROM recommended JOIN features USING (id_municipio)""",
)
def recommend_other_groups(spark, sf):
    return _shown(index(spark, sf).by_entity(leading_customers(spark, sf), other_groups_only=True))


@query(
    "recommend_by_name",
    f"""WITH {op.SQL_TERMS}, {SQL_NAME_QUERIES},
    {_sql_recommended('', "SELECT query_id, id_municipio AS id FROM resolved WHERE status = 'found'", 3)}
    SELECT query_id, rank, id_municipio, score, {SHOWN} FROM recommended JOIN features USING (id_municipio)""",
)
def recommend_by_name(spark, sf):
    return _shown(index(spark, sf).by_name(name_queries(spark, sf), 3))


@query(
    "recommend_by_code",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING},
    {_sql_recommended('', "SELECT CAST(id AS VARCHAR) AS query_id, id FROM leaders", 3)}
    SELECT query_id, rank, id_municipio, score, {SHOWN} FROM recommended JOIN features USING (id_municipio)""",
)
def recommend_by_code(spark, sf):
    return _shown(index(spark, sf).by_code(code_queries(spark, sf), 3))


def text_queries(spark, sf):
    """A wished-for profile for each nation, and one of unknown tokens for each region."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    wished = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("query_id"),
        F.concat_ws(" ", snake_token(F.col("r_name")), snake_token(F.col("n_name")), F.lit("alta_urgent baixa_low")).alias("text"),
    )
    unknown = regions.select(F.col("r_name").alias("query_id"), F.concat(F.lit("nowhere_"), snake_token(F.col("r_name"))).alias("text"))
    return wished.unionByName(unknown)


SQL_TEXT_QUERIES = f"""asked AS (SELECT n_name AS query_id,
    {op.sql_snake('r_name')} || ' ' || {op.sql_snake('n_name')} || ' alta_urgent baixa_low' AS text
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_name, 'nowhere_' || {op.sql_snake('r_name')} FROM region),
q_terms AS (SELECT query_id, token, count(*) AS cnt FROM
  (SELECT query_id, unnest(string_split(text, ' ')) AS token FROM asked) WHERE token IN (SELECT token FROM terms) GROUP BY ALL),
q_vectors AS (SELECT query_id, sum(cnt * cnt) AS sq, CAST(sum(cnt) AS BIGINT) AS l1 FROM q_terms GROUP BY query_id)"""


@query(
    "recommend_by_text",
    f"""WITH {op.SQL_TERMS}, {SQL_TEXT_QUERIES},
    dots AS (SELECT query_id, b.id, sum(a.cnt * b.cnt) AS dot FROM q_terms a JOIN terms b USING (token) GROUP BY ALL),
    scored AS (SELECT q.query_id, v.id AS id_municipio, coalesce(dot / sqrt(q.sq::DOUBLE * v.sq::DOUBLE), 0.0) AS score
      FROM q_vectors q CROSS JOIN vectors v LEFT JOIN dots ON dots.query_id = q.query_id AND dots.id = v.id),
    recommended AS (SELECT query_id, id_municipio, round(score, 6) AS score,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id_municipio) AS rank FROM scored QUALIFY rank <= 5)
    SELECT query_id, rank, id_municipio, score, {SHOWN} FROM recommended JOIN features USING (id_municipio)""",
)
def recommend_by_text(spark, sf):
    return _shown(index(spark, sf).by_text(text_queries(spark, sf)))


@query(
    "text_query_status",
    f"""WITH {op.SQL_TERMS}, {SQL_TEXT_QUERIES} SELECT query_id, coalesce(l1, 0) AS n_tokens,
    CASE WHEN l1 > 0 THEN 'found' ELSE 'no_known_token' END AS status FROM asked LEFT JOIN q_vectors USING (query_id)""",
)
def text_query_status(spark, sf):
    return index(spark, sf).text_status(text_queries(spark, sf))


@query(
    "explain_best_match",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING}, {_sql_recommended('', k=1)},
    sides AS (SELECT query_id AS left_id, id_municipio AS right_id FROM recommended),
    aligned AS (SELECT left_id, right_id, token, coalesce(a.cnt, 0) AS u, coalesce(b.cnt, 0) AS v FROM
      (SELECT left_id, right_id, token, cnt FROM sides JOIN terms ON id = left_id) a
      FULL JOIN (SELECT left_id, right_id, token, cnt FROM sides JOIN terms ON id = right_id) b
      USING (left_id, right_id, token))
    SELECT left_id, l.nome_municipio AS left_name, l.sigla_uf AS left_group,
      right_id, r.nome_municipio AS right_name, r.sigla_uf AS right_group,
      round(sum(u * v) / sqrt(sum(u * u)::DOUBLE * sum(v * v)::DOUBLE), 6) AS cosine,
      round(sqrt(sum((u - v) * (u - v))::DOUBLE), 6) AS euclidean, sum(abs(u - v))::DOUBLE AS manhattan,
      coalesce(string_agg(token, ' ' ORDER BY token) FILTER (WHERE u > 0 AND v > 0), '') AS common,
      coalesce(string_agg(token, ' ' ORDER BY token) FILTER (WHERE v = 0), '') AS left_only,
      coalesce(string_agg(token, ' ' ORDER BY token) FILTER (WHERE u = 0), '') AS right_only
    FROM aligned JOIN features l ON l.id_municipio = left_id JOIN features r ON r.id_municipio = right_id
    GROUP BY ALL""",
)
def explain_best_match(spark, sf):
    built = index(spark, sf)
    best = written(built.by_entity(leading_customers(spark, sf), 1), "pairs")
    pairs = best.select(F.col("query_id").alias("left_id"), F.col(ENTITY).alias("right_id"))
    return built.explain(pairs).withColumns(
        {c: F.round(c, 6) for c in ("cosine", "euclidean")}
        | {c: F.array_join(c, " ") for c in ("common", "left_only", "right_only")}
    )


@query(
    "recommendation_listing",
    f"""WITH {op.SQL_TERMS}, {SQL_LEADING}, {_sql_recommended('', k=3)}
    SELECT query_id, rank, score, id_municipio, sigla_uf, left(nome_municipio, 33) AS nome_municipio,
      left(nome_mesorregiao, 33) AS nome_mesorregiao,
      replace(replace(especializacao, 'especializado_em_', ''), '_', ' ') AS especializacao
    FROM recommended JOIN features USING (id_municipio)""",
)
def recommendation_listing(spark, sf):
    listed = recommend.shown(index(spark, sf).by_entity(leading_customers(spark, sf), 3), SPEC)
    return listed.withColumn("score", F.round("score", 6))


@query("recommend_with_stemming")
def recommend_with_stemming(spark, sf):
    """As recommend_by_entity on stemmed vectors, the default of the index."""
    return _shown(index(spark, sf, stemming=True).by_entity(leading_customers(spark, sf)))
