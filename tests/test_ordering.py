"""Range-wise ordering against plain windows, with a value that fills a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from affinis.operators import ordering


@pytest.fixture(scope="module")
def rows(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.xxhash64("id") % 500).cast("double"))
    group = F.when(F.col("id") % 10 < 8, "big").otherwise("small")
    return spark.range(3000).select("id", group.alias("g"), hot.alias("v")).cache()


def test_split_points_cover_the_hot_value(rows):
    splits = ordering.split_points(rows, ["g", "v"], ["id"], 8)
    assert splits == sorted(splits) and ("big", 7.0) in {tuple(s) for s in splits}


@pytest.mark.parametrize("ranges", [1, 2, 8, 64])
def test_cumulative_share(rows, ranges):
    got = ordering.cumulative_share(rows, "g", "v", ["id"], ranges=ranges)
    plain = rows.withColumn("plain", F.cume_dist().over(Window.partitionBy("g").orderBy("v")))
    joined = got.join(plain, ["id", "g", "v"])
    assert joined.count() == 3000
    assert joined.filter(F.abs(F.col("share") - F.col("plain")) > 1e-12).count() == 0


@pytest.mark.parametrize("ranges", [1, 8, 64])
def test_positions(rows, ranges):
    shuffled = rows.repartition(5, F.xxhash64("id", F.lit(1)))
    for groups in ([], ["g"]):
        got = ordering.positions(shuffled, ["id"], groups, ranges=ranges)
        order = Window.partitionBy(*groups).orderBy("id")
        plain = rows.withColumn("plain", F.row_number().over(order) - 1)
        joined = got.join(plain, "id")
        assert joined.count() == 3000
        assert joined.filter(F.col("position") != F.col("plain")).count() == 0


def test_positions_of_strings(spark):
    words = spark.range(400).select(F.concat(F.lit("é"), F.hex("id"), F.lit("~"), F.md5(F.col("id").cast("string"))).alias("w"))
    got = {r["w"]: r["position"] for r in ordering.positions(words, ["w"], ranges=8).collect()}
    assert [w for w, _ in sorted(got.items(), key=lambda item: item[1])] == sorted(got)


@pytest.mark.parametrize("ranges", [1, 8, 64])
def test_quantiles(rows, ranges):
    shares = [0.0, 0.1, 0.33, 0.5, 0.66, 1.0]
    got = {(r["g"], r["share"]): r["quantile"] for r in ordering.quantiles(rows, "g", "v", shares, ["id"], ranges).collect()}
    plain = rows.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(s) for s in shares])).alias("q")).collect()
    expected = {(r["g"], s): q for r in plain for s, q in zip(shares, r["q"], strict=True)}
    assert got == pytest.approx(expected)


def test_missing_key_comes_first(spark):
    df = spark.range(400).select(F.when(F.col("id") != 200, F.col("id")).alias("id"))
    got = {r["id"]: r["position"] for r in ordering.positions(df, ["id"], ranges=8).collect()}
    assert got[None] == 0 and got[0] == 1 and got[399] == 399
