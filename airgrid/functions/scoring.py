"""Predictions and update steps of the linear models, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from airgrid import config


def _terms(weights: list[Column]) -> list[Column]:
    return [w * F.col(name) for w, name in zip(weights, config.FEATURES, strict=True)]


def weights_of(name: str) -> list[Column]:
    """The entries of a coefficient array column, in feature order."""
    return [F.col(name)[i] for i in range(len(config.FEATURES))]


def linear_score(weights: list[Column]) -> Column:
    """Weighted sum of the features; a term that is missing or not a number counts as zero, an infinite one stays."""
    return sum((F.coalesce(F.nanvl(t, F.lit(0.0)), F.lit(0.0)) for t in _terms(weights)), F.lit(0.0))


def strict_score(weights: list[Column]) -> Column:
    """Weighted sum of the features; a missing feature makes it null."""
    return sum(_terms(weights), F.lit(0.0))


def sgd_step(weights: list[Column], n: Column, eta: Column) -> list[Column]:
    """Weights after one gradient step on the row at hand.

    The residual is raised by a share of the weight sum where the prediction falls short.
    """
    label, score = F.col(config.LABEL), strict_score(weights)
    total = sum(weights, F.lit(0.0))
    residual = label - score + F.when(label > score, config.SGD_UNDERSHOOT_PENALTY * total).otherwise(0.0)
    return [w + 2 * eta / n * F.col(name) * residual for w, name in zip(weights, config.FEATURES, strict=True)]
