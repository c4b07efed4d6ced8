"""Written tables in the shared folder, which cut a plan in two and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from affinis.session import shared_folder


def _path(spark: SparkSession, name: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


class Scratch:
    """A folder of one run below ``spark.checkpoint.dir``.

    ``drop`` deletes a table that nothing reads any more; the rest goes when the
    driver ends, as a returned DataFrame may still read it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        files, path = _path(spark, self.folder)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        files, path = _path(self.spark, f"{self.folder}/{name}")
        files.delete(path, True)
