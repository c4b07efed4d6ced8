"""Queries on sources, quality, cleaning and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions.text import contains_text, normalise_text, same_name, snake_token
from affinis.operators import features as feat
from affinis.operators import quality, report
from affinis.operators.cleaning import clean, unmapped
from affinis.operators.topk import seeded_sample
from affinis.plans import orders_profile as op
from affinis.plans.registry import query, table
from affinis.session import scratch_path
from affinis.sources import batches, hierarchy, landing

SPEC, ACTIVITIES = op.SPEC, op.ACTIVITIES


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- sources ------------------------------------------------------------------


@query("hierarchy_flatten", f"WITH {op.SQL_DIM} SELECT * FROM dim")
def hierarchy_flatten(spark, sf):
    return op.dimension(spark, sf)


@query("hierarchy_from_json_text", f"WITH {op.SQL_DIM} SELECT * FROM dim")
def hierarchy_from_json_text(spark, sf):
    text = op.records(spark, sf).select(F.to_json(F.struct("id", "nome", "microrregiao")).alias("j"))
    return hierarchy.from_json_column(text, "j")


@query(
    "json_property_values",
    """SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
    FROM events GROUP BY ALL""",
)
def json_property_values(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("dimension_typed", f"WITH {op.SQL_DIM} SELECT * FROM dim")
def dimension_typed(spark, sf):
    return hierarchy.typed(op.dimension(spark, sf))


@query("dimension_landed_json", f"WITH {op.SQL_DIM} SELECT * FROM dim")
def dimension_landed_json(spark, sf):
    path = scratch_path(spark, "records")
    op.records(spark, sf).write.json(path)
    return hierarchy.read_json(spark, path, lines=True)


@query(
    "measurements_landed_by_year",
    f"""WITH {op.SQL_CLEAN} SELECT ano, count(*) AS n_rows, count(valor) AS n_values, round(sum(valor), 2) AS total
    FROM clean WHERE ano = 1998 GROUP BY ano""",
)
def measurements_landed_by_year(spark, sf):
    landed = landing.land_measurements(op.measurements(spark, sf), scratch_path(spark, "measurements"), SPEC.period)
    one = landing.for_period(landed, SPEC.period, 1998)
    return one.groupBy(F.col(SPEC.period).cast("bigint").alias(SPEC.period)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(SPEC.value).alias("n_values"),
        F.round(F.sum(SPEC.value), 2).alias("total"),
    )


@query(
    "latest_period",
    f"""WITH {op.SQL_CLEAN} SELECT ano, atividade, count(*) AS n_rows FROM clean
    WHERE ano = (SELECT max(ano) FROM clean) GROUP BY ano, atividade""",
)
def latest_period(spark, sf):
    latest = landing.for_period(op.measurements(spark, sf), SPEC.period)
    return latest.groupBy(SPEC.period, SPEC.activity).agg(F.count(F.lit(1)).alias("n_rows"))


def _order_batches(spark, sf):
    orders = table(spark, sf, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey", "o_totalprice")
    rest = {
        p: orders.filter(F.col("o_orderpriority") == p).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
        for p in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    }
    return landing.union_batches({"1-URGENT": urgent, **rest})


@query(
    "batch_union",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS batch,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS o_orderstatus FROM orders""",
)
def batch_union(spark, sf):
    return _order_batches(spark, sf)


@query(
    "batch_failures",
    """SELECT DISTINCT event_type AS batch FROM events
    WHERE event_type NOT IN (SELECT DISTINCT o_orderpriority FROM orders)""",
)
def batch_failures(spark, sf):
    expected = table(spark, sf, "events").select(F.col("event_type").alias("batch"))
    return landing.failed_batches(_order_batches(spark, sf), expected)


@query(
    "ordered_batches",
    """SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 500) AS BIGINT) AS batch
    FROM customer""",
)
def ordered_batches(spark, sf):
    return batches.assign_batches(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 500)


@query(
    "grouped_key_lists",
    """WITH n AS (SELECT c_nationkey, c_custkey,
      (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 100 AS part FROM customer)
    SELECT c_nationkey, CAST(part AS BIGINT) AS part, count(*) AS n_keys,
      string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS keys
    FROM n GROUP BY c_nationkey, part""",
)
def grouped_key_lists(spark, sf):
    lists = batches.key_lists(table(spark, sf, "customer"), "c_nationkey", "c_custkey", 100)
    return lists.withColumn("keys", F.array_join("keys", ","))


@query("write_once", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def write_once(spark, sf):
    path = scratch_path(spark, "suppliers")
    suppliers = table(spark, sf, "supplier")
    landing.land_once(suppliers, path)
    # The second write must leave the landed table alone.
    return landing.land_once(suppliers.withColumn("s_name", F.lit("changed")), path)


# -- quality ------------------------------------------------------------------


@query(
    "coverage_check",
    """WITH req AS (SELECT DISTINCT c_custkey AS k FROM customer),
    rec AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
    miss AS (SELECT k FROM req WHERE k NOT IN (SELECT k FROM rec)),
    n AS (SELECT (SELECT count(*) FROM req) AS n_requested, (SELECT count(*) FROM rec) AS n_received,
      (SELECT count(*) FROM miss) AS n_missing)
    SELECT *, round(n_missing / greatest(n_requested, 1), 6) AS missing_fraction,
      CASE WHEN n_missing / greatest(n_requested, 1) > 0.5 THEN 'error'
           WHEN n_missing / greatest(n_requested, 1) > 0.02 THEN 'warning' ELSE 'ok' END AS status,
      (SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM (SELECT k FROM miss ORDER BY k LIMIT 10)) AS sample
    FROM n""",
)
def coverage_check(spark, sf):
    requested = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    orders = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    got = quality.coverage(requested, orders.select(F.col("o_custkey").alias("k")), "k")
    return rounded(got, "missing_fraction").withColumn("sample", F.array_join("sample", ","))


@query(
    "missing_keys",
    """SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def missing_keys(spark, sf):
    requested = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return quality.missing_keys(requested, urgent.select(F.col("o_custkey").alias("k")), "k")


@query(
    "consistency_check",
    """SELECT (SELECT count(*) FROM documents) AS n_features, (SELECT count(*) FROM labels) AS n_vectors,
    (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS only_features,
    (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS only_vectors""",
)
def consistency_check(spark, sf):
    return quality.consistency(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    "unmapped_categories",
    f"""WITH {op.SQL_CLEAN} SELECT DISTINCT cat AS category FROM trimmed
    WHERE cat NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', '3-MEDIUM - part')""",
)
def unmapped_categories(spark, sf):
    return unmapped(op.raw_measurements(spark, sf), SPEC)


# -- cleaning -----------------------------------------------------------------


@query("clean_measurements", f"WITH {op.SQL_CLEAN} SELECT * FROM clean")
def clean_measurements(spark, sf):
    return clean(op.raw_measurements(spark, sf), SPEC)


@query("normalised_text", f"SELECT doc_id, md5({op.sql_normalised('text')}) AS text FROM documents")
def normalised_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(normalise_text(F.col("text"))).alias("text"))


@query(
    "snake_tokens",
    f"""SELECT p_partkey, {op.sql_snake("p_brand || '/' || p_name || ' - ' || p_type || '''s'")} AS token FROM part""",
)
def snake_tokens(spark, sf):
    label = F.concat("p_brand", F.lit("/"), "p_name", F.lit(" - "), "p_type", F.lit("'s"))
    return table(spark, sf, "part").select("p_partkey", snake_token(label).alias("token"))


@query(
    "name_predicates",
    """SELECT s_suppkey, lower(trim('  ' || upper(s_name) || ' ')) = lower(trim(s_name)) AS same,
    contains(lower(s_name), lower('ER#0000000')) AS has_part FROM supplier""",
)
def name_predicates(spark, sf):
    padded = F.concat(F.lit("  "), F.upper("s_name"), F.lit(" "))
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        same_name(padded, F.col("s_name")).alias("same"),
        contains_text(F.col("s_name"), F.lit("ER#0000000")).alias("has_part"),
    )


# -- features -----------------------------------------------------------------


@query(
    "wide_measurements",
    f"WITH {op.SQL_WIDE} SELECT id_municipio, " + ", ".join(f"round({a}, 2) AS {a}" for a in ACTIVITIES) + " FROM sums",
)
def wide_measurements(spark, sf):
    return rounded(feat.widen(op.measurements(spark, sf), ACTIVITIES, SPEC), *ACTIVITIES, digits=2)


@query(
    "enriched_dimension",
    f"WITH {op.SQL_WIDE} SELECT * REPLACE (" + ", ".join(f"round({a}, 2) AS {a}" for a in ACTIVITIES) + ") FROM wide",
)
def enriched_dimension(spark, sf):
    wide = feat.widen(op.measurements(spark, sf), ACTIVITIES, SPEC)
    return rounded(feat.enrich(op.dimension(spark, sf), wide, SPEC), *ACTIVITIES, digits=2)


@query(
    "band_limits",
    f"""WITH {op.SQL_LONG}
    SELECT atividade, 0.33::DOUBLE AS share, round(q_low, 4) AS quantile, n_rows FROM limits
    UNION ALL SELECT atividade, 0.66::DOUBLE, round(q_high, 4), n_rows FROM limits""",
)
def band_limits(spark, sf):
    wide = op.wide_table(spark, sf)
    return rounded(feat.positive_quantiles(wide, ACTIVITIES, SPEC), "quantile", digits=4)


@query("bands", f"WITH {op.SQL_LONG} SELECT id_municipio, band FROM bands")
def bands(spark, sf):
    wide = op.wide_table(spark, sf)
    banded = feat.add_bands(wide, feat.band_thresholds(wide, ACTIVITIES, SPEC), SPEC)
    columns = F.array(*[SPEC.band_prefix + a for a in ACTIVITIES])
    return banded.select(SPEC.entity, F.explode(columns).alias("band"))


@query("value_shares", f"WITH {op.SQL_LONG} SELECT id_municipio, atividade, round(share, 9) AS share FROM shares")
def value_shares(spark, sf):
    shares = feat.value_shares(op.wide_table(spark, sf), list(SPEC.main_activities), SPEC)
    return rounded(shares.select(SPEC.entity, SPEC.activity, "share"), "share", digits=9)


@query("dominant_activity", f"WITH {op.SQL_LONG} SELECT id_municipio, main AS atividade FROM best")
def dominant_activity(spark, sf):
    return feat.dominant(op.wide_table(spark, sf), SPEC)


@query(
    "specialty",
    f"WITH {op.SQL_FEATURES} SELECT id_municipio, especializacao FROM features",
)
def specialty(spark, sf):
    return feat.add_specialty(op.wide_table(spark, sf), SPEC).select(SPEC.entity, SPEC.specialty)


@query(
    "diversity",
    f"WITH {op.SQL_FEATURES} SELECT id_municipio, n_atividades, atividades_presentes FROM features",
)
def diversity(spark, sf):
    wide = feat.enrich(op.dimension(spark, sf), feat.widen(op.measurements(spark, sf), ACTIVITIES, SPEC), SPEC)
    return feat.add_diversity(wide, SPEC).select(SPEC.entity, SPEC.count, SPEC.present)


@query("profile_text", f"WITH {op.SQL_FEATURES} SELECT id_municipio, tags FROM features")
def profile_text(spark, sf):
    return op.features(spark, sf).select(SPEC.entity, SPEC.text)


@query(
    "feature_table",
    f"WITH {op.SQL_FEATURES} SELECT * REPLACE (" + ", ".join(f"round({a}, 2) AS {a}" for a in ACTIVITIES) + ") FROM features",
)
def feature_table(spark, sf):
    return rounded(op.features(spark, sf), *ACTIVITIES, digits=2)


@query(
    "features_saved",
    f"WITH {op.SQL_FEATURES} SELECT id_municipio, especializacao, tags FROM features",
)
def features_saved(spark, sf):
    path = scratch_path(spark, "features")
    landing.save_features(op.features(spark, sf), path)
    return landing.load(spark, path).select(SPEC.entity, SPEC.specialty, SPEC.text)


# -- reports ------------------------------------------------------------------


@query(
    "value_counts",
    """SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 6) AS pct
    FROM customer GROUP BY c_mktsegment""",
)
def value_counts(spark, sf):
    return rounded(report.value_counts(table(spark, sf, "customer"), "c_mktsegment"), "pct")


@query(
    "distinct_counts",
    f"""WITH {op.SQL_DIM} SELECT count(DISTINCT id_municipio) AS id_municipio, count(DISTINCT sigla_uf) AS sigla_uf,
    count(DISTINCT nome_mesorregiao) AS nome_mesorregiao, count(DISTINCT nome_regiao) AS nome_regiao FROM dim""",
)
def distinct_counts(spark, sf):
    columns = ["id_municipio", "sigla_uf", "nome_mesorregiao", "nome_regiao"]
    return report.distinct_counts(op.dimension(spark, sf), columns)


@query(
    "activity_totals",
    f"""WITH {op.SQL_LONG} SELECT atividade, count(*) FILTER (WHERE valor > 0) AS n_positive,
    round(sum(valor), 2) AS total FROM long GROUP BY atividade""",
)
def activity_totals(spark, sf):
    wide = feat.enrich(op.dimension(spark, sf), feat.widen(op.measurements(spark, sf), ACTIVITIES, SPEC), SPEC)
    return rounded(report.activity_totals(wide, ACTIVITIES, SPEC), "total", digits=2)


@query(
    "seeded_sample",
    f"""WITH {op.SQL_DIM} SELECT id_municipio, nome_municipio FROM dim
    WHERE nome_regiao = (SELECT nome_regiao FROM dim WHERE nome_regiao IS NOT NULL
      GROUP BY nome_regiao ORDER BY count(*) DESC, nome_regiao LIMIT 1)
    ORDER BY md5(id_municipio || ':42'), id_municipio LIMIT 3""",
)
def sample(spark, sf):
    """Three customers of the largest region by a seeded hash."""
    dimension = op.dimension(spark, sf)
    largest = dimension.filter("nome_regiao IS NOT NULL").groupBy("nome_regiao").count().orderBy(F.desc("count"), "nome_regiao").limit(1)
    inside = dimension.join(largest, "nome_regiao", "left_semi")
    return seeded_sample(inside.select(SPEC.entity, SPEC.name), 3, SPEC.entity)
