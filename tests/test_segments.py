from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions.calendar import FoldCalendar
from airgrid.functions.scoring import linear_score, sgd_step, strict_score
from airgrid.operators import boosting, moments, segments
from airgrid.plans import forecast
from airgrid.schema import SEGMENT
from tests.micro import as_set

CALENDAR = FoldCalendar(start=date(2024, 1, 25), lookback=14, step=7)


def labelled(spark, rows):
    """Rows of (channel, weekday, blockdate, rating)."""
    df = spark.createDataFrame(rows, "cnlname string, weekday int, blockdate int, factratebase double")
    return segments.with_segments(df, CALENDAR, ["A", "B"])


def test_channel_lists():
    listed = segments.listed_channels()
    assert len(config.CHANNELS) == 22 and len(listed) == 20
    assert not set(config.EXCLUDED_CHANNELS) & set(listed)
    assert segments.listed_channels(["x", "y"], ["y"]) == ["x"]


def test_channels_are_compared_exactly(spark):
    rows = labelled(spark, [("A", 0, 20240101, 1.0), ("a", 0, 20240101, 1.0), (None, 0, 20240101, 1.0), ("A ", 0, 20240101, 1.0)])
    assert rows.count() == 1


def test_split_is_strictly_before_the_start_day(spark):
    rows = labelled(spark, [("A", 3, 20240124, 1.0), ("A", 3, 20240125, 1.0)])
    assert as_set(rows.select("blockdate", "is_train", "day_type")) == {
        (20240124, True, "weekend"), (20240125, False, "weekend"),
    }


def trimmed(spark, rows):
    data = labelled(spark, rows)
    return segments.trimmed_train(data, segments.label_statistics(data))


def test_trim_has_an_upper_side_only(spark):
    ratings = [10.0] * 30 + [-500.0, 400.0]
    assert np.mean(ratings) - 3 * np.std(ratings, ddof=1) > -500
    assert np.mean(ratings) + 3 * np.std(ratings, ddof=1) < 400
    kept = trimmed(spark, [("A", 0, 20240101, r) for r in ratings])
    assert sorted(r.factratebase for r in kept.collect()) == [-500.0] + [10.0] * 30


def test_trim_is_strict_and_drops_missing_labels_and_lone_rows(spark):
    rows = [("A", 0, 20240101, 2.0), ("A", 0, 20240101, 2.0), ("A", 3, 20240101, 7.0), ("B", 0, 20240101, None),
            ("B", 0, 20240101, 1.0), ("B", 0, 20240101, 3.0)]
    # Equal labels: deviation 0, and nothing lies strictly below the mean. One row: no deviation.
    assert as_set(trimmed(spark, rows).select("cnlname", "factratebase")) == {("B", 1.0), ("B", 3.0)}


def test_trim_uses_training_labels_only(spark):
    rows = [("A", 0, 20240101, r) for r in [1.0, 2.0, 3.0]] + [("A", 0, 20240201, 1000.0)]
    assert trimmed(spark, rows).count() == 3


def test_status_of_every_listed_segment(spark):
    rows = [("A", 0, 20240101, 1.0), ("A", 0, 20240101, 3.0), ("A", 0, 20240201, None),
            ("A", 3, 20240101, 1.0),
            ("B", 0, 20240101, 2.0), ("B", 0, 20240102, 2.0), ("B", 0, 20240201, None)]
    data = labelled(spark, rows)
    stats = segments.label_statistics(data)
    kept = segments.trimmed_train(data, stats).groupBy(*SEGMENT).agg(
        F.count(F.lit(1)).alias("n_kept"), F.lit(0).alias("n_null")
    )
    found = segments.segment_status(spark, stats, kept, ["A", "B"])
    assert as_set(found.select(*SEGMENT, "status")) == {
        ("A", "weekdays", "ready"), ("A", "weekend", "empty"),
        ("B", "weekdays", "failed"), ("B", "weekend", "empty"),
    }


def feature_rows(spark, seed=0, n=60, missing=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = [float(v) for v in rng.random(4).round(3)] + [int(i % 2), int(i % 5 + 1)] + [float(v) for v in rng.normal(size=2).round(3)]
        if missing and i == 3:
            x[0] = None
        rows.append(("A" if i % 3 else "B", "weekdays", *x, float(rng.random().__round__(3))))
    types = ["double"] * 4 + ["int", "int"] + ["double"] * 2
    schema = ", ".join(["cnlname string", "day_type string", *[f"{f} {t}" for f, t in zip(config.FEATURES, types)], "factratebase double"])
    return spark.createDataFrame(rows, schema)


WEIGHTS = [0.5, -0.25, 1.0, 2.0, 0.125, 0.0, 3.0, 0.75]


def test_moments_equal_the_matrix_product(spark):
    rows = feature_rows(spark)
    pdf = rows.toPandas()
    for r in moments.segment_moments(rows).collect():
        part = pdf[pdf.cnlname == r.cnlname]
        z = np.column_stack([np.ones(len(part)), part[config.FEATURES], part.factratebase])
        assert r.n_kept == len(part) and r.n_null == 0
        assert np.allclose([(z.T @ z)[i, j] for i, j in moments.moment_pairs()], r.moments)


def test_null_features_are_counted(spark):
    found = moments.segment_moments(feature_rows(spark, missing=True)).collect()
    assert sorted((r.cnlname, r.n_null) for r in found) == [("A", 0), ("B", 1)]


def test_errors_equal_the_definition(spark):
    rows = feature_rows(spark, seed=3)
    pdf = rows.toPandas()
    w = [F.lit(v) for v in WEIGHTS]
    found = moments.segment_moments(rows).select(
        "cnlname", moments.all_pairs_error(w).alias("pairs"), moments.squared_error(w).alias("own")
    )
    for r in found.collect():
        part = pdf[pdf.cnlname == r.cnlname]
        y, p = part.factratebase.to_numpy(), part[config.FEATURES].to_numpy(float) @ WEIGHTS
        assert np.isclose(r.pairs, np.mean((y[:, None] - p[None, :]) ** 2))
        assert np.isclose(r.own, np.mean((y - p) ** 2))


def test_scores_differ_only_in_how_they_treat_missing_features(spark):
    rows = feature_rows(spark, missing=True)
    pdf = rows.toPandas()
    w = [F.lit(v) for v in WEIGHTS]
    found = rows.select(linear_score(w).alias("lenient"), strict_score(w).alias("strict")).toPandas()
    expected = (pdf[config.FEATURES] * WEIGHTS).sum(axis=1)
    assert np.allclose(found.lenient, expected)
    assert found.strict.isna().sum() == 1 and np.isnan(found.strict[3])
    assert np.allclose(found.strict.drop(3), expected.drop(3))


def test_step_expression_equals_the_definition(spark):
    rows = feature_rows(spark, seed=5)
    pdf = rows.toPandas()
    stepped = sgd_step([F.lit(v) for v in WEIGHTS], F.lit(60), F.lit(0.5))
    found = rows.select(*[c.alias(str(i)) for i, c in enumerate(stepped)]).toPandas().to_numpy()
    w = np.array(WEIGHTS)
    for got, x, y in zip(found, pdf[config.FEATURES].to_numpy(float), pdf.factratebase):
        short = y > x @ w
        assert np.allclose(got, w + 2 * 0.5 / 60 * x * (y - x @ w + (0.9 * w.sum() if short else 0)))


@pytest.mark.parametrize("folds", [2, 3, 5])
def test_cv_folds_are_contiguous_and_even(spark, folds):
    rows = spark.createDataFrame(
        [("A", "weekdays", 20240101 + i // 10, i % 10, i) for i in range(100)],
        "cnlname string, day_type string, blockdate int, hour int, blockid long",
    )
    found = boosting.with_cv_folds(rows, folds).collect()
    in_time = [r.cv_fold for r in sorted(found, key=lambda r: (r.blockdate, r.hour))]
    assert in_time == sorted(in_time) and set(in_time) == set(range(folds))
    assert max(in_time.count(k) for k in range(folds)) - min(in_time.count(k) for k in range(folds)) <= 1


def test_forecast_has_all_columns_in_order():
    assert len(forecast.SAMPLE_COLUMNS) == 28 and len(forecast.FORECAST_COLUMNS) == 32


@pytest.mark.parametrize("folds", [2, 3, 5])
def test_cv_folds_split_a_moment_with_many_rows(spark, folds):
    rows = [("A", "weekdays", 20240101, 7, i) for i in range(400)] + [("A", "weekdays", 20240102, 1, 400 + i) for i in range(200)]
    rows = spark.createDataFrame(rows, "cnlname string, day_type string, blockdate int, hour int, blockid long")
    found = boosting.with_cv_folds(rows, folds).collect()
    sizes = [sum(r.cv_fold == k for r in found) for k in range(folds)]
    assert sum(sizes) == 600 and max(sizes) - min(sizes) < 60
    last = max(r.cv_fold for r in found if r.blockdate == 20240101)
    assert all(r.cv_fold >= last for r in found if r.blockdate == 20240102)  # still in order of time
    again = boosting.with_cv_folds(rows.repartition(3), folds).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
