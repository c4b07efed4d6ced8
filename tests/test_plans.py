"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from affinis.operators import features as feat
from affinis.operators import similarity as sim
from affinis.operators import vocabulary as voc
from affinis.operators.cleaning import clean
from affinis.plans import orders_profile as op

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    return sorted(tuple((v is None, str(type(v)), v if v is not None else 0) for v in (row[c] for c in columns)) for row in rows)


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = [dict(zip(columns, row, strict=True)) for row in cursor.fetchall()]
    got = [row.asDict() for row in df.collect()]
    columns = sorted(columns)
    for a, b in zip(ordered(got, columns), ordered(expected, columns), strict=True):
        for (none_a, kind_a, x), (none_b, kind_b, y) in zip(a, b, strict=True):
            assert (none_a, kind_a) == (none_b, kind_b)
            assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) if isinstance(x, float) else x == y


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.oracle_sql())))
def test_without_sql(spark, name):
    assert entry_points.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25 * 5


# -- plans -------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_does_not_shuffle(spark):
    cleaned = plan(clean(op.raw_measurements(spark, SF_DIR), op.SPEC))
    assert "Exchange" not in cleaned and "Python" not in cleaned
    scan = cleaned[cleaned.index("ReadSchema"):]
    assert "o_orderkey" not in scan  # only the columns in use are read


def test_wide_table_shuffles_partial_sums(spark):
    wide = plan(feat.widen(op.measurements(spark, SF_DIR), op.ACTIVITIES, op.SPEC))
    assert wide.count("Exchange") == 1 and "partial_sum" in wide


def test_scores_stay_in_the_entity_partition(spark):
    docs = voc.term_vectors(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id", "text", False)
    asked = voc.term_vectors(spark.read.parquet(f"{SF_DIR}/benchmark.parquet"), "item_id", "text", False)
    scores = plan(sim.cosine_scores(asked, docs, "item_id", "doc_id"))
    top = scores[: scores.index("BroadcastHashJoin")]
    assert "Exchange" not in top  # nothing moves between the join and the finished sums
    assert "CartesianProduct" not in scores and "NestedLoop" not in scores


def test_no_query_is_a_cross_join(spark):
    for name in ("recommend_by_entity", "nearest_cosine", "similar_profiles", "search_substring", "resolve_names"):
        shape = plan(entry_points.queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in shape and "BroadcastNestedLoopJoin" not in shape, name


def test_bands_are_literals(spark):
    wide = op.wide_table(spark, SF_DIR)
    banded = feat.add_bands(wide, feat.band_thresholds(wide, op.ACTIVITIES, op.SPEC), op.SPEC)
    assert "Exchange" not in plan(banded.select(F.col("perfil_high")))
