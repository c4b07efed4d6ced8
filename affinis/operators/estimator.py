"""The classifier and the vectoriser as stages of an ML pipeline, with parameters, saved and loaded.

``DescentClassifier`` wraps :class:`~affinis.operators.classifier.GradientDescent`; what it
fits is parameters of the model, so the ML library's own writers and readers keep them.
``vectoriser`` turns a fitted vocabulary into the ML library's model of term counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.classifier import ITERATIONS, LEARNING_RATE, THRESHOLD, TOLERANCE, DescentModel, GradientDescent

MOST_TERMS = 1 << 18  # the ML model keeps its terms on the driver; a larger vocabulary is an error


def _checked(convert: Callable, holds: Callable, rule: str) -> Callable:
    def check(value):
        value = convert(value)
        if not holds(value):
            raise ValueError(f"{rule}, got {value}")
        return value

    return check


class _DescentParams(HasInputCols, HasLabelCol, HasWeightCol, HasPredictionCol, HasProbabilityCol):
    learningRate = Param(Params._dummy(), "learningRate", "step of the descent", _checked(TypeConverters.toFloat, lambda v: v > 0, "learningRate must be positive"))
    iterations = Param(Params._dummy(), "iterations", "steps at most", _checked(TypeConverters.toInt, lambda v: v > 0, "iterations must be positive"))
    tolerance = Param(
        Params._dummy(), "tolerance", "change of the loss below which the fit stops", _checked(TypeConverters.toFloat, lambda v: v >= 0, "tolerance must not be negative")
    )
    threshold = Param(
        Params._dummy(), "threshold", "probability above which the class is 1", _checked(TypeConverters.toFloat, lambda v: 0 <= v <= 1, "threshold must be in 0 to 1")
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(
            labelCol="label", predictionCol="prediction", probabilityCol="probability",
            learningRate=LEARNING_RATE, iterations=ITERATIONS, tolerance=TOLERANCE, threshold=THRESHOLD,
        )


class DescentClassifier(Estimator, _DescentParams, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression by full-batch gradient descent on the columns ``inputCols``."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, weightCol=None, predictionCol=None, probabilityCol=None, learningRate=None, iterations=None, tolerance=None, threshold=None) -> None:
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols=None, labelCol=None, weightCol=None, predictionCol=None, probabilityCol=None, learningRate=None, iterations=None, tolerance=None, threshold=None) -> DescentClassifier:
        """Set what is given; the rest keeps its value."""
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DescentClassifierModel:
        settings = GradientDescent(self.getOrDefault("learningRate"), self.getOrDefault("iterations"), self.getOrDefault("tolerance"))
        weight = self.getWeightCol() if self.isDefined("weightCol") else None
        found = settings.fit(dataset, self.getInputCols(), self.getLabelCol(), weight)
        model = self._copyValues(DescentClassifierModel())
        return model._set(coefficients=list(found.weights), intercept=found.bias, losses=list(found.losses), converged=found.converged)


class DescentClassifierModel(Model, _DescentParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the probability of class 1 and the class; row-wise, so a streaming table will do."""

    coefficients = Param(Params._dummy(), "coefficients", "fitted weights, in the order of inputCols", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "fitted constant", TypeConverters.toFloat)
    losses = Param(Params._dummy(), "losses", "loss before each step", TypeConverters.toListFloat)
    converged = Param(Params._dummy(), "converged", "whether the tolerance was reached", TypeConverters.toBoolean)

    @property
    def fitted(self) -> DescentModel:
        weights, losses = (tuple(self.getOrDefault(p)) for p in ("coefficients", "losses"))
        return DescentModel(tuple(self.getInputCols()), weights, self.getOrDefault("intercept"), losses, self.getOrDefault("converged"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        with_chance = self.fitted.predict_proba(dataset, self.getProbabilityCol())
        return self.fitted.predict(with_chance, self.getOrDefault("threshold"), self.getPredictionCol())


def vectoriser(vocabulary: DataFrame, input_col: str = "words", output_col: str = "counts") -> CountVectorizerModel:
    """The ML library's model of term counts with a fitted vocabulary (token, idx): its vector places are ``idx``.

    An empty vocabulary is an error, and so is one of more than ``MOST_TERMS`` tokens: restrict it with ``max_features``.
    """
    known = vocabulary.select("token", "idx").limit(MOST_TERMS + 1).collect()
    if not known:
        raise ValueError("empty vocabulary: no text holds a token within the limits")
    if len(known) > MOST_TERMS:
        raise ValueError(f"the vocabulary has more than {MOST_TERMS} tokens; fit it with max_features")
    terms = [row["token"] for row in sorted(known, key=lambda row: row["idx"])]
    return CountVectorizerModel.from_vocabulary(terms, inputCol=input_col, outputCol=output_col)


def ml_vectors(vectors: DataFrame, model: CountVectorizerModel) -> DataFrame:
    """Term vectors (``terms``) with the ML vector of the same counts beside them; tokens that the model lacks count nothing."""
    words = F.flatten(F.transform("terms", lambda term: F.array_repeat(term["token"], term["cnt"].cast("int"))))
    return model.transform(vectors.withColumn(model.getInputCol(), words)).drop(model.getInputCol())
