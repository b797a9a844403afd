"""Stochastic gradient descent per segment on rows drawn with replacement, drawn in Spark."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators.moments import LABEL
from airgrid.operators.nnls import moment_matrix
from airgrid.schema import SEGMENT

TRACE_COLUMNS = [*SEGMENT, "iter", "weights", "step", "all_pairs_error"]
TRACE_SCHEMA = (
    "cnlname string, day_type string, iter int, weights array<double>, step double, all_pairs_error double"
)
SPREAD = 64


@dataclass(frozen=True)
class SgdSettings:
    seed: int = 42
    max_iter: int = config.SGD_MAX_ITER
    rate: float = config.SGD_RATE
    min_step: float = config.SGD_MIN_STEP


def draw_order(train: DataFrame, settings: SgdSettings) -> DataFrame:
    """The first `max_iter` distinct rows of each segment in the order random draws would meet them.

    Equal rows are merged with their multiplicity m. In repeated uniform draws, new rows come up in
    the order of independent exponential arrival times of rate m, and a hash of seed and row gives
    those. No run of `max_iter` draws can meet more distinct rows than are kept, so the cut is exact.
    Each task passes on its own earliest rows, then `SPREAD` groups per segment, then one: no task
    ever holds a segment.
    """
    # Spark cuts a window's rows map-side only up to this many of them.
    limit, conf = "spark.sql.optimizer.windowGroupLimitThreshold", train.sparkSession.conf
    if int(conf.get(limit)) < settings.max_iter:
        conf.set(limit, str(settings.max_iter))
    x = [F.col(name).cast("double").alias(name) for name in config.FEATURES]
    rows = train.select(*SEGMENT, *x, config.LABEL).groupBy(*SEGMENT, *config.FEATURES, config.LABEL).agg(
        F.count(F.lit(1)).alias("m")
    )
    bits = F.shiftrightunsigned(
        F.xxhash64(F.lit(settings.seed), *SEGMENT, *config.FEATURES, config.LABEL), 11
    )
    rows = rows.select(
        "*",
        (-F.log((bits + 1) / F.lit(float(2**53))) / F.col("m")).alias("arrival"),
        (F.spark_partition_id() % SPREAD).alias("spread"),
    )
    order = [F.col("arrival"), *[F.col(name) for name in [*config.FEATURES, config.LABEL]]]
    for groups in [[*SEGMENT, "spread"], SEGMENT]:
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        rows = rows.withColumn("place", place).where(F.col("place") <= settings.max_iter)
    return rows.select(*SEGMENT, "place", "m", F.array(*config.FEATURES).alias("x"), F.col(config.LABEL).alias("y"))


def draw_places(m: np.ndarray, n: int, draws: int, rng: np.random.Generator) -> np.ndarray:
    """Places of `draws` uniform draws from n rows, where place k is the k-th distinct row to come up.

    A draw hits a row already seen with the share of rows seen so far, and otherwise the next place.
    """
    seen = np.zeros(0, dtype=np.int64)
    places = np.empty(draws, dtype=np.int64)
    for t in range(draws):
        at = rng.integers(n)
        place = int(np.searchsorted(seen, at, side="right"))
        if place == len(seen):
            seen = np.append(seen, m[place] + (seen[-1] if place else 0))
        places[t] = place
    return places


def descend(x, y, places, start, n, settings: SgdSettings):
    """Weights after each step, and the length of each step."""
    w = np.asarray(start, dtype=float)
    weights, steps = [], []
    with np.errstate(all="ignore"):
        for i, place in enumerate(places, start=1):
            xi, score = x[place], float(x[place] @ w)
            penalty = config.SGD_UNDERSHOOT_PENALTY * w.sum() if y[place] > score else 0.0
            move = 2 * settings.rate / i / n * (y[place] - score + penalty) * xi
            w = w + move
            weights.append(w)
            steps.append(float(np.linalg.norm(move)))
            if steps[-1] <= settings.min_step:
                break
    return np.array(weights), np.array(steps)


def pair_errors(weights: np.ndarray, moments: np.ndarray) -> np.ndarray:
    """All-pairs error of each weight vector, from the moment matrix."""
    n, total_yy = moments[0, 0], moments[LABEL, LABEL]
    with np.errstate(all="ignore"):
        mean_p = weights @ moments[0, 1:LABEL] / n
        total_pp = np.einsum("ti,ij,tj->t", weights, moments[1:LABEL, 1:LABEL], weights)
        return (total_yy + total_pp) / n - 2 * moments[0, LABEL] / n * mean_p


def sgd_trace(train: DataFrame, linear: DataFrame, settings: SgdSettings = SgdSettings()) -> DataFrame:
    """One row per segment and step: weights, step length and all-pairs error, starting from NNLS.

    Only the drawn rows (at most `max_iter`) and one row of moments reach the step loop of a segment.
    """

    def run(rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or fitted.empty:
            return pd.DataFrame(columns=TRACE_COLUMNS, dtype=object)
        rows, fitted = rows.sort_values("place"), fitted.iloc[0]
        n = int(fitted.n_kept)
        rng = np.random.default_rng([settings.seed, *f"{fitted.cnlname}/{fitted.day_type}".encode()])
        places = draw_places(rows.m.to_numpy(), n, settings.max_iter, rng)
        weights, steps = descend(np.stack(rows.x), rows.y.to_numpy(), places, fitted.nnls, n, settings)
        return pd.DataFrame({
            "cnlname": fitted.cnlname,
            "day_type": fitted.day_type,
            "iter": np.arange(1, len(steps) + 1),
            "weights": list(weights),
            "step": steps,
            "all_pairs_error": pair_errors(weights, moment_matrix(fitted.moments)),
        })

    fitted = linear.where("nnls is not null").select(*SEGMENT, "n_kept", "moments", "nnls")
    return (
        draw_order(train, settings).groupBy(*SEGMENT)
        .cogroup(fitted.groupBy(*SEGMENT))
        .applyInPandas(run, TRACE_SCHEMA)
    )


def final_weights(trace: DataFrame) -> DataFrame:
    """Weights of the last step, the number of steps, and whether they stayed finite."""
    finite = F.forall(
        "sgd", lambda w: w.isNotNull() & ~F.isnan(w) & (F.abs(w) != F.lit(float("inf")))
    )
    return (
        trace.groupBy(*SEGMENT)
        .agg(F.max_by("weights", "iter").alias("sgd"), F.max("iter").alias("steps"))
        .select("*", finite.alias("sgd_finite"))
    )
