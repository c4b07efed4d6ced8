"""Landed tables: reading, writing once, periods, unions of batches."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.recommend import ProfileIndex
from affinis.spec import LIVESTOCK, ProfileSpec

# Fixed value: the thirteen text columns of a raw survey row.
RAW_COLUMNS = ("NC", "NN", "MC", "MN", "V", "D1C", "D1N", "D2C", "D2N", "D3C", "D3N", "D4C", "D4N")


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A landed Parquet table; one that is not there is a plain error."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"nothing landed at {path}") from error


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: only then does its folder hold the success mark."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def land_once(df: DataFrame, path: str, force: bool = False, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write unless a complete table is there already, or anew with ``force``; read it back.

    What a crashed job left is written anew.
    """
    if force or not complete(df.sparkSession, path):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return load(df.sparkSession, path)


def land_measurements(df: DataFrame, path: str, period: str, force: bool = False) -> DataFrame:
    """Land measurements with the period as a partition column."""
    return land_once(df, path, force, (period,))


def for_period(df: DataFrame, period: str, wanted: int | None = None) -> DataFrame:
    """Rows of the wanted period, or of the latest one.

    On a table partitioned by the period only that partition is read: the latest
    is found from partition values and pruned to at run time.
    """
    if wanted is not None:
        return df.filter(F.col(period) == wanted)
    latest = df.select(period).distinct().agg(F.max(period)).scalar()
    return df.filter(F.col(period) == latest)


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """One row with the latest period."""
    return df.agg(F.max(period).alias(period))


def union_batches(batches: Mapping[str, DataFrame]) -> DataFrame:
    """All batches as one table with a ``batch`` column; columns a batch lacks are NULL.

    Raises when there is no batch at all.
    """
    result = None
    for name, df in batches.items():
        part = df.withColumn("batch", F.lit(name))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise RuntimeError("no batch was landed")
    return result


def landed_batches(spark: SparkSession, paths: Mapping[str, str]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The batches that can be opened, and the reason for each that cannot."""
    found, failed = {}, {}
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except (AnalysisException, Py4JError) as error:
            failed[name] = str(error).splitlines()[0]
    return found, failed


def failed_batches(union: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (batch) names for which the union holds no row."""
    return expected.select("batch").distinct().join(union.select("batch").distinct(), "batch", "left_anti")


def save_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").parquet(path)


def save_index(index: ProfileIndex, path: str) -> None:
    """Save vocabulary and vectors next to the feature table."""
    save_features(index.features, f"{path}/features")
    index.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    index.vectors.write.mode("overwrite").parquet(f"{path}/vectors")


def load_index(
    spark: SparkSession, path: str, spec: ProfileSpec = LIVESTOCK, stemming: bool = True
) -> ProfileIndex:
    """Load a saved index and check that its tables belong together."""
    features, vectors, vocabulary = (load(spark, f"{path}/{name}") for name in ("features", "vectors", "vocabulary"))
    index = ProfileIndex(features, vectors, spec, stemming, vocabulary)
    index.check()
    return index


def save_vectoriser(model: CountVectorizerModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_vectoriser(path: str) -> CountVectorizerModel:
    return CountVectorizerModel.load(path)
