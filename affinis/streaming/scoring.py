"""Row-wise operators on a stream: frozen vocabulary and classifier scores.

These keep no state, so they need no watermark: every micro-batch is treated as
the batch operators treat a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinis.functions.text import tokens
from affinis.operators.classifier import DescentModel
from affinis.session import scratch_path


def known_tokens(stream: DataFrame, vocabulary: DataFrame, entity: str, text: str) -> DataFrame:
    """(entity, token, idx) for every known token of each text, by a stream-static join."""
    words = stream.select(entity, F.explode(tokens(F.col(text))).alias("token"))
    return words.join(vocabulary.select("token", "idx"), "token").select(entity, "token", "idx")


def scored(stream: DataFrame, model: DescentModel, threshold: float) -> DataFrame:
    return model.predict(model.predict_proba(stream), threshold)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to a Parquet table, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet file or folder at a path as a stream, with the schema it has now."""
    # A pattern that the path alone fits: without one a stream takes folders only.
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def landed(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to a table in the shared folder, start it again from its checkpoint, and read the table.

    The second start finds what arrived in between; what the first has written is not
    written again.
    """
    path, checkpoint = scratch_path(stream.sparkSession, label), scratch_path(stream.sparkSession, f"{label}-checkpoint")
    for _ in range(2):
        run_to_table(stream, path, checkpoint).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
