"""Column functions on number arrays, and the scalar functions of the classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["array_to_vector", "vector_to_array"]  # between arrays and ML vectors, dense or sparse


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(left: Column, right: Column) -> Column:
    return _total(F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")))


def norm_l2(vector: Column) -> Column:
    return F.sqrt(_total(F.transform(vector, lambda x: x.cast("double") * x.cast("double"))))


def norm_l1(vector: Column) -> Column:
    return _total(F.transform(vector, lambda x: F.abs(x.cast("double"))))


def _same_length(left: Column, right: Column, result: Column, strict: bool) -> Column:
    fits = F.size(left) == F.size(right)
    if strict:
        return F.when(fits, result).otherwise(
            F.raise_error(F.lit("vectors of different length")).cast("double")
        )
    return F.when(fits, result)


def cosine(left: Column, right: Column, strict: bool = False) -> Column:
    """Cosine of a pair; a zero vector is an error in strict mode, else NULL."""
    norms = norm_l2(left) * norm_l2(right)
    undefined = F.raise_error(F.lit("cosine of a zero vector")).cast("double") if strict else F.lit(None)
    score = F.when(norms > 0, dot(left, right) / norms).otherwise(undefined)
    return _same_length(left, right, score, strict)


def euclidean(left: Column, right: Column, strict: bool = False) -> Column:
    gap = F.zip_with(left, right, lambda x, y: x.cast("double") - y.cast("double"))
    return _same_length(left, right, norm_l2(gap), strict)


def manhattan(left: Column, right: Column, strict: bool = False) -> Column:
    gap = F.zip_with(left, right, lambda x, y: x.cast("double") - y.cast("double"))
    return _same_length(left, right, norm_l1(gap), strict)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def sigmoid(z: Column) -> Column:
    """Logistic function; neither branch lets ``exp`` overflow."""
    small = F.exp(-F.abs(z))
    return F.when(z >= 0, 1.0 / (1.0 + small)).otherwise(small / (1.0 + small))


def cross_entropy(label: Column, probability: Column, epsilon: float = 1e-15) -> Column:
    """Binary cross-entropy of one row."""
    p = clip(probability, epsilon, 1.0 - epsilon)
    return -(label * F.log(p) + (1.0 - label) * F.log(1.0 - p))


def linear(features: Sequence[Column], weights: Sequence[float], bias: float) -> Column:
    """Weighted sum of columns, written out so that it is compiled with its stage."""
    total = F.lit(float(bias))
    for column, weight in zip(features, weights, strict=True):
        total = total + column.cast("double") * F.lit(float(weight))
    return total
