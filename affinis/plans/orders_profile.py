"""The profile contract on the order tables: customers as entities, orders as measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.cleaning import clean
from affinis.operators.features import build_features, enrich, widen
from affinis.plans.registry import table
from affinis.session import written
from affinis.sources.hierarchy import flatten, typed
from affinis.spec import LIVESTOCK, ProfileSpec

SPEC = ProfileSpec(
    raw_columns=LIVESTOCK.raw_columns,
    category_map={
        "1-URGENT": "urgent",
        "2-HIGH": "high",
        "3-MEDIUM": "medium",
        "4-NOT SPECIFIED": "unspecified",
        "5-LOW": "low",
    },
    ignored_categories=("3-MEDIUM - part",),
    main_activities=("urgent", "high", "medium", "low"),
    context=LIVESTOCK.context,
    nothing_word="sem_producao",
)
ACTIVITIES = list(SPEC.activities)


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as thirteen text columns, with padded categories and value marks."""
    orders = table(spark, sf_dir, "orders")
    priority, status, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice").cast("string")
    category = (
        F.when((status == "P") & (priority == "3-MEDIUM"), F.lit("3-MEDIUM  - part"))
        .when((status == "P") & (priority == "4-NOT SPECIFIED"), F.lit("OTHER"))
        .otherwise(F.concat(F.lit("  "), priority, F.lit(" ")))
    )
    day = F.dayofmonth("o_orderdate")
    value = (
        F.when(day == 1, "-").when(day == 2, "...").when(day == 3, "..").when(day == 4, " X ")
        .when(day == 5, F.concat(price, F.lit("d")))
        .otherwise(price)
    )
    key, year = F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string")
    return orders.select(
        F.lit("6").alias("NC"), F.lit("Customer").alias("NN"), F.lit("1").alias("MC"), F.lit("Price").alias("MN"),
        value.alias("V"), key.alias("D1C"), F.concat(F.lit("Customer "), key).alias("D1N"),
        year.alias("D2C"), year.alias("D2N"), F.lit("105").alias("D3C"), F.lit("Total").alias("D3N"),
        F.left(priority, F.lit(1)).alias("D4C"), category.alias("D4N"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as nested territory records; some lack every level above their own."""
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    nation, segment = F.col("n_nationkey").cast("bigint"), F.col("c_mktsegment")
    region = F.struct(
        F.col("r_regionkey").cast("bigint").alias("id"), F.left("r_name", F.lit(2)).alias("sigla"), F.col("r_name").alias("nome")
    )
    uf = F.struct(nation.alias("id"), F.col("n_name").alias("sigla"), F.col("n_name").alias("nome"), region.alias("regiao"))
    meso = F.struct(
        (nation * 100 + F.length(segment)).alias("id"),
        F.concat("n_name", F.lit("/"), segment).alias("nome"),
        uf.alias("UF"),
    )
    micro = F.struct((nation * 1000 + F.length(segment)).alias("id"), segment.alias("nome"), meso.alias("mesorregiao"))
    return joined.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.when(F.col("c_acctbal") >= 0, micro).alias("microrregiao"),
    )


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(records(spark, sf_dir))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_measurements(spark, sf_dir), SPEC)


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension and wide measurements, written once."""
    wide = widen(measurements(spark, sf_dir), ACTIVITIES, SPEC)
    return written(enrich(dimension(spark, sf_dir), wide, SPEC), "wide")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of all customers."""
    return build_features(raw_measurements(spark, sf_dir), typed(dimension(spark, sf_dir)), SPEC, ACTIVITIES)


# ---------------------------------------------------------------------------
# The same in SQL, as chained common table expressions.

SPACES = r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def sql_normalised(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), '{SPACES}', ' ', 'g'))"


def sql_snake(text: str) -> str:
    kept = f"regexp_replace(lower(coalesce({text}, '')), '[^a-z0-9áéíóúâêîôûãõçñü\\s/_-]', ' ', 'g')"
    return f"regexp_replace(regexp_replace({kept}, '[\\s/-]+', '_', 'g'), '^_+|_+$', '', 'g')"


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '{SPACES}'), lambda w: w <> '')"


SQL_RAW = """
raw AS (
  SELECT CAST(o_custkey AS VARCHAR) AS D1C, CAST(year(o_orderdate) AS VARCHAR) AS D2C, left(o_orderpriority, 1) AS D4C,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN '3-MEDIUM  - part'
         WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'OTHER'
         ELSE '  ' || o_orderpriority || ' ' END AS D4N,
    CASE day(o_orderdate) WHEN 1 THEN '-' WHEN 2 THEN '...' WHEN 3 THEN '..' WHEN 4 THEN ' X '
         WHEN 5 THEN CAST(o_totalprice AS VARCHAR) || 'd' ELSE CAST(o_totalprice AS VARCHAR) END AS V
  FROM orders)"""

SQL_CLEAN = SQL_RAW + f""",
trimmed AS (SELECT D1C, D2C, {sql_normalised('D4N')} AS cat, {sql_normalised('V')} AS v FROM raw),
clean AS (
  SELECT CAST(D1C AS BIGINT) AS id_municipio, CAST(D2C AS BIGINT) AS ano,
    CASE cat WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
             WHEN '4-NOT SPECIFIED' THEN 'unspecified' ELSE 'low' END AS atividade,
    CASE WHEN v = '-' THEN 0.0 WHEN v IN ('...', '..', 'X') THEN NULL ELSE TRY_CAST(v AS DOUBLE) END AS valor
  FROM trimmed
  WHERE cat IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'))"""

_LEVELS = {
    "id_microrregiao": "CAST(n_nationkey AS BIGINT) * 1000 + length(c_mktsegment)",
    "nome_microrregiao": "c_mktsegment",
    "id_mesorregiao": "CAST(n_nationkey AS BIGINT) * 100 + length(c_mktsegment)",
    "nome_mesorregiao": "n_name || '/' || c_mktsegment",
    "id_uf": "CAST(n_nationkey AS BIGINT)",
    "sigla_uf": "n_name",
    "nome_uf": "n_name",
    "id_regiao": "CAST(r_regionkey AS BIGINT)",
    "sigla_regiao": "left(r_name, 2)",
    "nome_regiao": "r_name",
}
SQL_DIM = (
    "dim AS (SELECT c_custkey AS id_municipio, c_name AS nome_municipio, "
    + ", ".join(f"CASE WHEN c_acctbal >= 0 THEN {e} END AS {c}" for c, e in _LEVELS.items())
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
SQL_WIDE = SQL_CLEAN + ", " + SQL_DIM + """,
sums AS (SELECT id_municipio, """ + ", ".join(
    f"coalesce(sum(valor) FILTER (WHERE atividade = '{a}'), 0.0) AS {a}" for a in sorted(ACTIVITIES)
) + " FROM clean GROUP BY id_municipio)," + """
wide AS MATERIALIZED (SELECT dim.*, """ + ", ".join(f"coalesce({a}, 0.0) AS {a}" for a in sorted(ACTIVITIES)) + """
  FROM dim LEFT JOIN sums USING (id_municipio))"""

SQL_LONG = SQL_WIDE + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT id_municipio, '{a}' AS atividade, {i} AS ord, {a} AS valor FROM wide" for i, a in enumerate(ACTIVITIES)
) + "),\n" + """
limits AS (SELECT atividade, count(*) AS n_rows, quantile_cont(valor, 0.33) AS q_low, quantile_cont(valor, 0.66) AS q_high
  FROM long WHERE valor > 0 GROUP BY atividade),
bands AS (SELECT id_municipio, atividade, CASE
    WHEN coalesce(n_rows, 0) < 3 THEN CASE WHEN valor > 0 THEN 'presente_' ELSE 'sem_' END
    WHEN valor = 0 THEN 'sem_' WHEN valor <= q_low THEN 'baixa_' WHEN valor <= q_high THEN 'media_' ELSE 'alta_' END
    || atividade AS band
  FROM long LEFT JOIN limits USING (atividade)),
shares AS (SELECT id_municipio, atividade, ord, cume_dist() OVER (PARTITION BY atividade ORDER BY valor) AS share
  FROM long WHERE valor <> 0 AND atividade <> 'unspecified'),
best AS (SELECT id_municipio, atividade AS main FROM shares
  QUALIFY row_number() OVER (PARTITION BY id_municipio ORDER BY share DESC, ord) = 1)"""

SQL_FEATURES = SQL_LONG + """,
described AS (SELECT wide.*, """ + ", ".join(
    f"(SELECT band FROM bands b WHERE b.id_municipio = wide.id_municipio AND b.atividade = '{a}') AS perfil_{a}"
    for a in ACTIVITIES
) + """,
    CASE WHEN urgent + high + medium + low > 0 THEN 'especializado_em_' || main ELSE 'sem_producao' END AS especializacao,
    CAST(""" + " + ".join(f"CAST({a} > 0 AS INT)" for a in ACTIVITIES) + """ AS BIGINT) AS n_atividades,
    concat_ws(' ', """ + ", ".join(f"CASE WHEN {a} > 0 THEN '{a}' END" for a in ACTIVITIES) + """) AS atividades_presentes
  FROM wide LEFT JOIN best USING (id_municipio)),
features AS MATERIALIZED (SELECT *, trim(regexp_replace(concat_ws(' ', """ + ", ".join(
    [sql_snake(c) for c in SPEC.context] + [f"perfil_{a}" for a in sorted(ACTIVITIES)]
) + """, especializacao, atividades_presentes), '\\s+', ' ', 'g')) AS tags FROM described)"""

SQL_TERMS = SQL_FEATURES + """,
terms AS MATERIALIZED (SELECT id, token, count(*) AS cnt FROM
    (SELECT id_municipio AS id, unnest(string_split(tags, ' ')) AS token FROM features) GROUP BY id, token),
vectors AS MATERIALIZED (SELECT id, CAST(sum(cnt * cnt) AS BIGINT) AS sq, CAST(sum(cnt) AS BIGINT) AS l1 FROM terms GROUP BY id)"""
