"""The solvers against brute force, and the draws against their distribution."""

from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators import moments, nnls, sgd
from airgrid.schema import SEGMENT
from tests.test_segments import feature_rows


def brute_force_nnls(x, y):
    """Best non-negative least-squares fit over every choice of columns."""
    best = (float(y @ y), np.zeros(x.shape[1]))
    for size in range(1, x.shape[1] + 1):
        for columns in combinations(range(x.shape[1]), size):
            c = np.zeros(x.shape[1])
            c[list(columns)] = np.linalg.lstsq(x[:, columns], y, rcond=None)[0]
            if (c >= 0).all():
                best = min(best, (float(((y - x @ c) ** 2).sum()), c), key=lambda b: b[0])
    return best


@settings(deadline=None, max_examples=40)
@given(seed=st.integers(0, 10**6), rows=st.integers(1, 40), columns=st.integers(1, 6), scale=st.sampled_from([1e-3, 1.0, 1e3]))
def test_nnls_reaches_the_brute_force_optimum(seed, rows, columns, scale):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, columns)) * scale ** rng.integers(0, 2, columns)
    if columns > 2:
        x[:, 0] = 0.0
        x[:, 1] = x[:, 2]
    y = rng.normal(size=rows)
    c = nnls.solve_nnls(x.T @ x, x.T @ y)
    assert (c >= 0).all()
    if columns > 2:
        assert c[0] == 0
    assert ((y - x @ c) ** 2).sum() <= brute_force_nnls(x, y)[0] + 1e-8 * float(y @ y)


def test_nnls_per_segment(spark):
    rows = feature_rows(spark, n=90)
    pdf = rows.toPandas()
    for r in nnls.fit_nnls(moments.segment_moments(rows)).collect():
        part = pdf[pdf.cnlname == r.cnlname]
        x, y = part[config.FEATURES].to_numpy(float), part.factratebase.to_numpy()
        assert np.isclose(((y - x @ r.nnls) ** 2).sum(), brute_force_nnls(x, y)[0], rtol=1e-9)


def test_segment_with_a_null_feature_gets_no_coefficients(spark):
    found = nnls.fit_nnls(moments.segment_moments(feature_rows(spark, missing=True))).collect()
    assert {r.cnlname: r.nnls is None for r in found} == {"A": False, "B": True}


def test_descent_equals_the_definition():
    rng = np.random.default_rng(1)
    x, y, w = rng.random((20, 8)), rng.random(20), rng.random(8)
    places = rng.integers(0, 20, 300)
    weights, steps = sgd.descend(x, y, places, w, 20, sgd.SgdSettings())
    for i, place in enumerate(places, start=1):
        p = x[place] @ w
        new = w + 2 * (10 / i) / 20 * x[place] * (y[place] - p + (0.9 * w.sum() if y[place] > p else 0))
        assert np.allclose(weights[i - 1], new)
        assert np.isclose(steps[i - 1], np.linalg.norm(new - w))
        w = new
    assert len(weights) == 300


def test_descent_stops_after_a_tiny_step():
    x, y = np.zeros((2, 8)), np.ones(2)
    weights, steps = sgd.descend(x, y, [0, 1, 0], np.ones(8), 2, sgd.SgdSettings())
    assert len(weights) == 1 and steps[0] == 0


def test_pair_errors_equal_the_definition():
    rng = np.random.default_rng(2)
    x, y, w = rng.random((30, 8)), rng.random(30), rng.normal(size=(5, 8))
    z = np.column_stack([np.ones(30), x, y])
    expected = [np.mean((y[:, None] - (x @ v)[None, :]) ** 2) for v in w]
    assert np.allclose(sgd.pair_errors(w, z.T @ z), expected)


def test_draws_are_uniform_with_replacement():
    """Over many runs, each copy of each row is drawn equally often, and repeats are as frequent as they should be."""
    m = np.array([1, 1, 3, 5])
    n, runs, draws = int(m.sum()), 4000, 6
    rng = np.random.default_rng(3)
    hits, repeats = np.zeros(4), 0
    for _ in range(runs):
        order = np.argsort(rng.exponential(size=4) / m)
        rows = order[sgd.draw_places(m[order], n, draws, rng)]
        hits += np.bincount(rows, minlength=4)
        repeats += rows[0] == rows[1]
    assert np.allclose(hits / (runs * draws), m / n, atol=0.01)
    assert abs(repeats / runs - float(((m / n) ** 2).sum())) < 0.03


def test_draw_order_keeps_the_earliest_rows_and_all_multiplicities(spark):
    rows = feature_rows(spark, n=60)
    copies = rows.unionByName(rows).unionByName(rows.limit(1))
    everything = sgd.draw_order(copies, sgd.SgdSettings()).collect()
    assert sum(r.m for r in everything) == 121 and len(everything) == 60
    few = sgd.draw_order(copies, sgd.SgdSettings(max_iter=5)).collect()
    assert sorted((r.cnlname, r.place, r.m, tuple(r.x)) for r in few) == sorted(
        (r.cnlname, r.place, r.m, tuple(r.x)) for r in everything if r.place <= 5
    )


def test_draw_order_does_not_depend_on_partitioning(spark):
    rows = feature_rows(spark, n=200)
    orders = [
        sorted((r.cnlname, r.place, r.y) for r in sgd.draw_order(rows.repartition(k), sgd.SgdSettings(max_iter=20)).collect())
        for k in (1, 7)
    ]
    assert orders[0] == orders[1]


def test_draw_order_favours_copies(spark):
    """A row that makes up a third of a segment comes first in about a third of all seeds."""
    rows = feature_rows(spark, n=60).where("cnlname = 'A'")
    hot = rows.limit(1).withColumn("copies", F.explode(F.sequence(F.lit(1), F.lit(19)))).drop("copies")
    both = rows.unionByName(hot).cache()
    m = both.groupBy(*both.columns).count().agg(F.max("count")).first()[0]
    first = [
        sgd.draw_order(both, sgd.SgdSettings(seed=seed, max_iter=1)).first()["m"] == m for seed in range(40)
    ]
    assert 4 <= sum(first) <= 24


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = sgd.draw_order(feature_rows(spark), sgd.SgdSettings())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_top_rows_are_cut_before_the_shuffle_beyond_the_planners_default(spark):
    plan = sgd.draw_order(feature_rows(spark), sgd.SgdSettings(max_iter=1001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_a_solver_that_gives_up_says_so(monkeypatch):
    gram = np.array([[1.0, 0.5], [0.5, 1.0]])
    assert nnls.solve_nnls(gram, np.array([1.0, 1.0])) is not None
    monkeypatch.setattr(np.linalg, "lstsq", lambda a, b, rcond: (np.full(len(b), -1.0),))
    assert nnls.solve_nnls(gram, np.array([1.0, 1.0])) is None


def test_sgd_trace_repeats_with_its_seed(spark, work):
    rows = feature_rows(spark, n=90)
    linear = work.keep(nnls.fit_nnls(moments.segment_moments(rows)), "nnls")
    runs = [
        {(r.cnlname, r.iter): r.weights for r in sgd.sgd_trace(rows, linear, sgd.SgdSettings(seed=s, max_iter=50)).collect()}
        for s in (1, 1, 2)
    ]
    assert runs[0] == runs[1] != runs[2]
    assert sorted(runs[0]) == [(c, i) for c in "AB" for i in range(1, 51)]


def test_runaway_weights_are_reported(spark):
    trace = spark.createDataFrame(
        [("A", "weekdays", 1, [1.0, 2.0]), ("A", "weekdays", 2, [float("inf"), 2.0]), ("B", "weekdays", 1, [1.0, 2.0]),
         ("C", "weekdays", 1, [float("nan"), 0.0])],
        "cnlname string, day_type string, iter int, weights array<double>",
    )
    found = sgd.final_weights(trace).collect()
    assert {r.cnlname: (r.steps, r.sgd_finite) for r in found} == {"A": (2, False), "B": (1, True), "C": (1, False)}


def test_segments_without_coefficients_are_skipped(spark):
    rows = feature_rows(spark, missing=True)
    linear = nnls.fit_nnls(moments.segment_moments(rows))
    trace = sgd.sgd_trace(rows, linear, sgd.SgdSettings(max_iter=5))
    assert [tuple(r) for r in trace.select(*SEGMENT).distinct().collect()] == [("A", "weekdays")]
