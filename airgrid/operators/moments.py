"""Second moments per segment: all that the linear models need to know about the training rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.schema import SEGMENT

# Order of the moment matrix: a constant, the features, the label.
WIDTH = len(config.FEATURES) + 2
LABEL = WIDTH - 1


def moment_pairs() -> list[tuple[int, int]]:
    """Index pairs of the upper triangle, row by row, as the `moments` array stores them."""
    return [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]


def _has_null() -> Column:
    return F.greatest(*[F.col(name).isNull() for name in config.FEATURES])


def segment_moments(train: DataFrame) -> DataFrame:
    """Sums of all pairwise products of (1, features, label), in one aggregation per segment.

    Each task adds up its own rows first, so a segment of any size is shuffled as a few sums.
    `sum` skips nulls, which would bend the result unseen; rows with a null feature are counted.
    """
    terms = [F.lit(1.0), *[F.col(name).cast("double") for name in config.FEATURES], F.col(config.LABEL)]
    sums = [F.sum(terms[i] * terms[j]).alias(f"m_{i}_{j}") for i, j in moment_pairs()]
    return (
        train.groupBy(*SEGMENT)
        .agg(F.count(F.lit(1)).alias("n_kept"), F.count_if(_has_null()).alias("n_null"), *sums)
        .select(*SEGMENT, "n_kept", "n_null", F.array(*[f"m_{i}_{j}" for i, j in moment_pairs()]).alias("moments"))
    )


def moment(i: int, j: int) -> Column:
    """One entry of the stored moment matrix."""
    return F.col("moments")[moment_pairs().index((min(i, j), max(i, j)))]


def _sum(weights: list[Column]) -> Column:
    """Sum of the predictions."""
    return sum((w * moment(0, i) for i, w in enumerate(weights, start=1)), F.lit(0.0))


def _square_sum(weights: list[Column]) -> Column:
    """Sum of the squared predictions."""
    terms = [
        (1 if i == j else 2) * weights[i - 1] * weights[j - 1] * moment(i, j)
        for i in range(1, LABEL) for j in range(i, LABEL)
    ]
    return sum(terms, F.lit(0.0))


def all_pairs_error(weights: list[Column]) -> Column:
    """Mean of (y_i - p_j)^2 over all pairs of a label and a prediction of a segment.

    Equals var(y) + var(p) + (mean y - mean p)^2, so the moments give it without any pairing.
    """
    n, total_y, total_yy = moment(0, 0), moment(0, LABEL), moment(LABEL, LABEL)
    return (total_yy + _square_sum(weights)) / n - 2 * (total_y / n) * (_sum(weights) / n)


def squared_error(weights: list[Column]) -> Column:
    """Mean of (y_i - p_i)^2, the ordinary mean squared error."""
    cross = sum((w * moment(i, LABEL) for i, w in enumerate(weights, start=1)), F.lit(0.0))
    return (moment(LABEL, LABEL) - 2 * cross + _square_sum(weights)) / moment(0, 0)
