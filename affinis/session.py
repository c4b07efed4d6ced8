"""Session settings, and the written tables that cut a plan in two."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20  # as JSON text


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; on a cluster
    every executor must see the folder, so there a missing setting is an error.
    The session's settings stay as they are.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="affinis-")
    return _own_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own for a table, which goes when the driver ends."""
    name = f"{shared_folder(spark).rstrip('/')}/affinis/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For a result that several branches read: the branches all see the same
    values (floating sums included), the input is read once, and a lost
    executor re-reads a file rather than re-running everything before it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` has few rows and few bytes; stops counting beyond the rows."""
    most = BROADCAST_ROWS if max_rows is None else max_rows
    size = df.limit(most + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")
    ).first()
    return size.n <= most and size.bytes <= BROADCAST_BYTES


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salts(count: int):
    """A column of the array 0 .. count-1, for replicating the small side of a salted join."""
    return F.sequence(F.lit(0), F.lit(count - 1))
