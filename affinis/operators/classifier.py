"""Binary classifier: logistic regression by full-batch gradient descent.

One Spark job per iteration. Each task turns its rows into one row of partial
sums (gradient, loss, row count) with numpy on Arrow batches; the weights travel
with the task, so the compiled plan stays the same. Partial sums are added in
partition order, in steps of a bounded number of rows, so a fit is repeatable and
the driver receives few rows for any number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from affinis.functions.vectors import linear, sigmoid

# Default settings, and the clip of probabilities in the loss.
LEARNING_RATE = 0.01
ITERATIONS = 1000
TOLERANCE = 1e-6
THRESHOLD = 0.5
EPSILON = 1e-15

PARTIALS_PER_STEP = 1024


@dataclass(frozen=True)
class GradientDescent:
    """Settings of a fit."""

    learning_rate: float = LEARNING_RATE
    iterations: int = ITERATIONS
    tolerance: float = TOLERANCE

    def __post_init__(self) -> None:
        if self.learning_rate <= 0:
            raise ValueError(f"learning_rate must be positive, got {self.learning_rate}")
        if self.iterations <= 0:
            raise ValueError(f"iterations must be positive, got {self.iterations}")
        if self.tolerance < 0:
            raise ValueError(f"tolerance must not be negative, got {self.tolerance}")

    def get_params(self) -> dict:
        return asdict(self)

    def fit(self, df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> DescentModel:
        """Fit from zero weights; stop early once the loss changes by less than the tolerance.

        With ``weight``, gradient and loss are weighted means; weights are not negative, and their sum is positive.
        """
        features = list(features)
        check_inputs(df, features, label, weight)
        inputs = [F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(features)]
        weights = [F.col(weight).cast("double").alias("w")] if weight else []
        data = df.select(*inputs, F.col(label).cast("double").alias("y"), *weights).persist()
        try:
            return self._descend(data, features)
        finally:
            data.unpersist()

    def _descend(self, data: DataFrame, features: list[str]) -> DescentModel:
        weights, bias = np.zeros(len(features)), 0.0
        many = data.rdd.getNumPartitions() > PARTIALS_PER_STEP
        history: list[float] = []
        converged, last = False, np.inf
        for _ in range(self.iterations):
            gradient, loss = gradient_step(data, weights, bias, many)
            history.append(loss)
            weights = weights - self.learning_rate * gradient[:-1]
            bias = bias - self.learning_rate * float(gradient[-1])
            if self.tolerance > 0 and abs(last - loss) < self.tolerance:
                converged = True
                break
            last = loss
        return DescentModel(tuple(features), tuple(map(float, weights)), float(bias), tuple(history), converged)


@dataclass(frozen=True)
class DescentModel:
    """Fitted weights and the loss before each update."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    losses: tuple[float, ...]
    converged: bool

    @property
    def iterations_run(self) -> int:
        return len(self.losses)

    def history(self, spark: SparkSession) -> DataFrame:
        """(iteration, loss), from 0."""
        return spark.createDataFrame(list(enumerate(self.losses)), "iteration bigint, loss double")

    def probability(self) -> Column:
        return sigmoid(linear([F.col(c) for c in self.features], self.weights, self.bias))

    def predict_proba(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """Add the probability of class 1. Row-wise, so a streaming table will do."""
        check_features(df, self.features)
        return df.withColumn(name, self.probability())

    def predict(self, df: DataFrame, threshold: float = THRESHOLD, name: str = "prediction") -> DataFrame:
        """Add the class: 1 where the probability is strictly above the threshold."""
        check_features(df, self.features)
        return df.withColumn(name, (self.probability() > threshold).cast("bigint"))


def check_features(df: DataFrame, features: Sequence[str]) -> None:
    if not features:
        raise ValueError("no feature columns given")
    for column in features:
        if column not in df.columns:
            raise ValueError(f"missing feature column {column!r}; found {df.columns}")
        if not isinstance(df.schema[column].dataType, T.NumericType):
            raise ValueError(f"feature column {column!r} is not numeric")


def check_inputs(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> None:
    """Columns exist and are numeric, no value is missing, and the weights can be averaged with."""
    columns = [*features, label, *([weight] if weight else [])]
    check_features(df, columns)
    sums = [F.min(weight).cast("double").alias("least"), F.sum(F.col(weight).cast("double")).alias("total")] if weight else []
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{j}") for j, c in enumerate(columns)],
        *sums,
    ).first()
    if row["n"] == 0:
        raise ValueError("no rows to fit")
    missing = [c for j, c in enumerate(columns) if row[f"m{j}"]]
    if missing:
        raise ValueError(f"missing values in {missing}")
    if weight and not (row["least"] >= 0 and 0 < row["total"] < float("inf")):
        raise ValueError(f"weights in {weight!r} must not be negative and must have a positive, finite sum")


def gradient_step(
    data: DataFrame, weights: np.ndarray, bias: float, many_partitions: bool = True
) -> tuple[np.ndarray, float]:
    """Mean gradient (weights, then bias) and mean loss over rows of x0, x1, ..., y, weighted if there is a column w."""
    width = len(weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width + 3)
        for batch in batches:
            x = np.column_stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(width)])
            y = batch.column(width).to_numpy(zero_copy_only=False)
            z = x @ weights + bias
            small = np.exp(-np.abs(z))
            p = np.where(z >= 0, 1.0, small) / (1.0 + small)
            w = batch.column(width + 1).to_numpy(zero_copy_only=False) if batch.num_columns > width + 1 else np.ones(len(y))
            error = (p - y) * w
            clipped = np.clip(p, EPSILON, 1.0 - EPSILON)
            sums[:width] += x.T @ error
            sums[width] += error.sum()
            sums[width + 1] -= ((y * np.log(clipped) + (1.0 - y) * np.log(1.0 - clipped)) * w).sum()
            sums[width + 2] += w.sum()
        at = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sums.tolist()])], ["part", "sums"])

    parts = data.mapInArrow(partial, "part int, sums array<double>")
    if many_partitions:
        parts = _added(parts, width + 3)
    total = np.zeros(width + 3)
    for row in sorted(parts.collect()):
        total += np.array(row["sums"])
    count = total[-1]
    return total[: width + 1] / count, float(total[width + 1] / count)


def _added(parts: DataFrame, size: int) -> DataFrame:
    """Add up runs of neighbouring partitions, each run in partition order."""
    zeros = F.array(*[F.lit(0.0)] * size)
    ordered = F.array_sort(F.collect_list(F.struct("part", "sums")))
    return parts.groupBy(F.floor(F.col("part") / PARTIALS_PER_STEP).cast("int").alias("part")).agg(
        F.aggregate(
            ordered, zeros, lambda acc, one: F.zip_with(acc, one["sums"], lambda a, b: a + b)
        ).alias("sums")
    )
