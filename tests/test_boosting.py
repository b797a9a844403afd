"""Boosting of all segments together: against a plain version, job counts, isolation, scoring."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators import boosting
from airgrid.plans import forecast
from airgrid.schema import SEGMENT
from airgrid.session import Workspace
from checks.grids import EVENT_CALENDAR, EVENT_CHANNELS, event_blocks

LAYOUT = ", ".join(["cnlname string", "day_type string", *[f"{f} double" for f in config.FEATURES], "factratebase double", "cv_fold int"])


def learnable_rows(names, n=120, folds=3, seed=0):
    """Rows per segment whose label depends on some features; one feature is constant, one has two values."""
    rng, rows = np.random.default_rng(seed), []
    for name in names:
        x = np.round(rng.normal(size=(n, 8)) * 8) / 8
        x[:, 4], x[:, 5] = rng.integers(0, 2, n), 3.0
        y = np.round((2 * (x[:, 0] > 0.3) + x[:, 4] * (x[:, 1] < 0) + 0.3 * rng.normal(size=n)) * 64) / 64
        rows += [(name, "weekdays", *map(float, x[i]), float(y[i]), i * folds // n) for i in range(n)]
    return rows


def plain_bins(x, bins):
    """Borders at the smallest values that k / bins of the rows do not exceed, and each value's bin."""
    cuts = []
    for column in x.T:
        s = np.sort(column)
        cuts.append(sorted({s[max(0, math.ceil(k * len(s) / bins) - 1)] for k in range(1, bins)}))
    return cuts, np.stack([[sum(b < v for b in c) for v in column] for c, column in zip(cuts, x.T, strict=True)], 1)


def plain_boosting(binned, y, seen, depth, iterations, settings):
    """Predictions for all rows after each tree grown on the rows `seen`."""
    predicted, out = np.full(len(y), y[seen].mean()), []
    for _ in range(iterations):
        residual, node = y - predicted, np.zeros(len(y), int)
        for _ in range(depth):
            best = None
            for f in range(binned.shape[1]):
                for b in range(settings.bins - 1):
                    right, explained = binned[:, f] > b, 0.0
                    for side in (right, ~right):
                        for leaf in np.unique(node):
                            part = residual[seen & side & (node == leaf)]
                            explained += part.sum() ** 2 / (len(part) + settings.shrink)
                    if best is None or explained > best[0] + 1e-9:
                        best = explained, f, b
            node = 2 * node + (binned[:, best[1]] > best[2])
        for leaf in np.unique(node):
            part = residual[seen & (node == leaf)]
            predicted = predicted + np.where(node == leaf, settings.rate * part.sum() / (len(part) + settings.shrink), 0.0)
        out.append(predicted)
    return out


@pytest.mark.parametrize("settings", [
    boosting.BoostingSettings(iterations=[1, 3], depths=[1, 3], cv_folds=2, bins=6),
    boosting.BoostingSettings(iterations=[2], depths=[2], cv_folds=2, bins=4),
], ids=["search", "one setting"])
def test_trees_and_scores_equal_a_plain_version(spark, work, settings):
    data = learnable_rows(["a", "b"], n=60, folds=2)
    train = spark.createDataFrame(data, LAYOUT).repartition(3)
    fitted = boosting.fit_boosted(train, [("a", "weekdays"), ("b", "weekdays")], work, settings)
    grid = {(r.cnlname, r.iterations, r.depth): r.r2 for r in fitted.grid.collect()}
    models = {r.cnlname: r for r in fitted.models.collect()}
    scored = boosting.score_boosted(train, fitted.models).collect()
    assert fitted.errors.count() == 0 and set(models) == {"a", "b"}
    for name in "ab":
        mine = [r for r in data if r[0] == name]
        x, y, fold = np.array([r[2:10] for r in mine]), np.array([r[10] for r in mine]), np.array([r[11] for r in mine])
        _, binned = plain_bins(x, settings.bins)
        if settings.several:
            want = {}
            for depth in settings.depths:
                for k in (0, 1):
                    runs, unseen = plain_boosting(binned, y, fold != k, depth, max(settings.iterations), settings), fold == k
                    for i in settings.iterations:
                        r2 = 1 - ((y - runs[i - 1])[unseen] ** 2).mean() / y[unseen].var()
                        want[i, depth] = want.get((i, depth), 0) + r2 / 2
            assert {k[1:]: v for k, v in grid.items() if k[0] == name} == pytest.approx(want)
            best = max(sorted(want), key=lambda s: want[s])
        else:
            best = (settings.iterations[0], settings.depths[0])
        assert (models[name].iterations, models[name].depth) == best and len(models[name].trees) == best[0]
        final = plain_boosting(binned, y, np.ones(len(y), bool), best[1], best[0], settings)[-1]
        got = {tuple(r)[2:11]: r.Pred_GBT for r in scored if r.cnlname == name}
        assert [got[r[2:11]] for r in mine] == pytest.approx(list(final))


def jobs_of(spark, name, run):
    """Spark jobs that `run` starts."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(name))


def test_job_count_does_not_depend_on_the_segments(spark):
    counts = []
    settings = boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2], cv_folds=2)
    for n in (4, 40):
        names = [f"c{i:02}" for i in range(n)]
        work = Workspace(spark)
        train = work.keep(spark.createDataFrame(learnable_rows(names, n=30, folds=2), LAYOUT), "train", partition_by=SEGMENT)
        found = []
        counts.append(jobs_of(spark, f"boost-{n}", lambda: found.append(boosting.fit_boosted(train, [(c, "weekdays") for c in names], work, settings))))
        assert found[0].models.count() == n and found[0].grid.count() == 4 * n
    # Adaptive execution may run a small table's broadcast as a job of its own or not.
    assert abs(counts[0] - counts[1]) <= 3 and counts[1] < 60


def test_scoring_is_one_pass_without_python(spark, work):
    names = [f"c{i:02}" for i in range(40)]
    train = work.keep(spark.createDataFrame(learnable_rows(names, n=12, folds=2), LAYOUT), "rows")
    fitted = boosting.fit_boosted(train, [(c, "weekdays") for c in names], work, boosting.BoostingSettings(iterations=[2], depths=[2]))
    plan = boosting.score_boosted(train, fitted.models)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Python" not in plan and "Arrow" not in plan


def test_many_tasks_and_shares_change_nothing(spark, work, monkeypatch):
    train = spark.createDataFrame(learnable_rows(["a", "b"], n=90), LAYOUT)
    settings = boosting.BoostingSettings(iterations=[1, 2], depths=[2, 3])
    found = []
    for parts, shared, held in ((1, 16, 1 << 26), (12, 2, 1 << 12)):
        monkeypatch.setattr(boosting, "SHARED_BEYOND", shared)
        monkeypatch.setattr(boosting, "HELD", held)
        spark.conf.set("spark.sql.files.openCostInBytes", "1g" if parts > 1 else "4m")
        fitted = boosting.fit_boosted(train.repartition(parts), [("a", "weekdays"), ("b", "weekdays")], work, settings)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        scored = {tuple(r)[:11]: r.Pred_GBT for r in boosting.score_boosted(train, fitted.models).collect()}
        found.append((sorted((r.cnlname, r.iterations, r.depth, round(r.r2, 9)) for r in fitted.grid.collect()), scored))
    assert found[0][0] == found[1][0] and found[0][1] == pytest.approx(found[1][1])


def test_chunks_within_one_fold_change_nothing(spark, work):
    """A large segment has whole chunks in the fold that a replica leaves out."""
    train, settings, found = spark.createDataFrame(learnable_rows(["a", "b"], n=90), LAYOUT).coalesce(1), boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2]), []
    for rows in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        fitted = boosting.fit_boosted(train, [("a", "weekdays"), ("b", "weekdays")], work, settings)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert fitted.errors.count() == 0
        found.append({(r.cnlname, r.iterations, r.depth): r.r2 for r in fitted.grid.collect()})
    assert len(found[0]) == 8 and found[0] == pytest.approx(found[1])


def test_chunks_are_held_a_few_at_a_time(spark, work, monkeypatch):
    """Neither a Parquet page or row group nor what goes to Python at once grows with the rows of a task, however well they
    compress, and a chunk not with the rows of an Arrow batch."""
    train, settings = spark.createDataFrame(learnable_rows(["a"], n=600), LAYOUT).coalesce(1), boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2])
    whole = boosting.fit_boosted(train, [("a", "weekdays")], work, settings).grid.collect()
    files, limits, keep, collect = [], [], Workspace.keep, type(train).collect

    def watched(self, df, name, *args, **kwargs):
        stage = keep(self, df, name, *args, **kwargs)
        if name == "chunks":
            files.extend(pq.ParquetFile(f.removeprefix("file:")) for f in stage.inputFiles())
        return stage

    monkeypatch.setattr(Workspace, "keep", watched)
    monkeypatch.setattr(type(train), "collect", lambda df: limits.append((df.columns, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None))) or collect(df))
    monkeypatch.setattr(boosting, "CHUNK_BYTES", 8 * len(settings.replicas) * 20, raising=False)
    fitted = boosting.fit_boosted(train, [("a", "weekdays")], work, settings)
    groups = [f.metadata.row_group(k) for f in files for k in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 3 * 30 and max(g.num_rows for g in groups) <= 4
    assert sum(x for f in files for g in range(f.num_row_groups) for x in f.read_row_group(g, ["n"])["n"].to_pylist()) == 3 * 600
    assert max(x for f in files for x in f.read(["n"])["n"].to_pylist()) == 20
    levels = [limit for columns, limit in limits if "border" in columns]
    assert len(levels) == 4 and set(levels) == {"4m"}
    assert {tuple(r)[:4]: r.r2 for r in fitted.grid.collect()} == pytest.approx({tuple(r)[:4]: r.r2 for r in whole})


def test_a_forecast_holds_chunks_a_few_at_a_time(spark, work, sf_dir, monkeypatch):
    """The whole run, with as many chunks as tables 360 times as large have."""
    groups, keep = [], Workspace.keep

    def watched(self, df, name, *args, **kwargs):
        stage = keep(self, df, name, *args, **kwargs)
        if name == "chunks":
            files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in stage.inputFiles()]
            groups.append([m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)])
        return stage

    monkeypatch.setattr(Workspace, "keep", watched)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        settings = boosting.BoostingSettings(iterations=[1], depths=[1, 2], cv_folds=2)
        run = forecast.run_forecast(event_blocks(spark, sf_dir), EVENT_CALENDAR, work, ["click", "view"], [], boosting_settings=settings)
        assert run.forecast.where("Pred_GBT is not null").count() == run.forecast.count() > 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(groups) == 2 and all(sum(g) > 40 and max(g) <= 4 for g in groups)


def test_a_task_hands_on_its_sums_in_pieces(spark, work, monkeypatch):
    train, settings, found = spark.createDataFrame(learnable_rows(["a", "b"], n=90), LAYOUT), boosting.BoostingSettings(iterations=[1, 2], depths=[2, 3]), []
    for handed in (1 << 22, 1):
        monkeypatch.setattr(boosting, "HANDED", handed)
        fitted = boosting.fit_boosted(train, [("a", "weekdays"), ("b", "weekdays")], work, settings)
        found.append({tuple(r)[:4]: r.r2 for r in fitted.grid.collect()})
    assert len(found[0]) == 8 and found[0] == pytest.approx(found[1])


def test_rows_stay_where_they_are(spark, work, monkeypatch):
    """Rows and chunks meet what belongs to their segment in their own tasks, even where Spark itself broadcasts nothing:
    dealt by segment, a segment's would all go to one task. The borders are a written stage, joined by its size."""
    train, settings = work.keep(spark.createDataFrame(learnable_rows(["a", "b"], n=60), LAYOUT), "rows"), boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2])
    plans, keep = [], Workspace.keep

    def watched(self, df, name, *args, **kwargs):
        if name == "chunks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name, *args, **kwargs)

    monkeypatch.setattr(Workspace, "keep", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        boosting.fit_boosted(train, [("a", "weekdays"), ("b", "weekdays")], work, settings)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [p.count("SortMergeJoin") for p in plans] == [1, 0, 0]


def test_an_unusable_segment_does_not_stop_the_others(spark, work):
    rows = learnable_rows(["good", "huge", "null", "nan"], n=30)
    spoiled = {"huge": (10, 1e200), "null": (3, None), "nan": (10, math.nan)}
    rows = [tuple(spoiled[r[0]][1] if r[0] in spoiled and i == spoiled[r[0]][0] and k % 30 == 4 else v for i, v in enumerate(r)) for k, r in enumerate(rows)]
    listed = [(c, "weekdays") for c in ("good", "huge", "null", "nan", "off air")]
    fitted = boosting.fit_boosted(spark.createDataFrame(rows, LAYOUT), listed, work, boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2]))
    errors = {r.cnlname: r.error.split(":")[0] for r in fitted.errors.collect()}
    assert errors == {"huge": "OverflowError", "null": "ValueError", "nan": "ValueError", "off air": "ValueError"}
    assert [r.cnlname for r in fitted.models.collect()] == ["good"] and {r.cnlname for r in fitted.grid.collect()} == {"good"}
    nothing = boosting.fit_boosted(spark.createDataFrame([], LAYOUT), listed, work)
    assert nothing.models.count() == 0 and nothing.grid.count() == 0 and nothing.errors.count() == 5


def test_one_long_run_scores_the_shorter_ones(spark, work):
    train = spark.createDataFrame(learnable_rows(["a"]), LAYOUT)
    together = {r.iterations: r.r2 for r in boosting.fit_boosted(train, [("a", "weekdays")], work, boosting.BoostingSettings(iterations=[2, 4], depths=[3])).grid.collect()}
    for n in (2, 4):
        alone = boosting.fit_boosted(train, [("a", "weekdays")], work, boosting.BoostingSettings(iterations=[n], depths=[3, 2])).grid
        assert {r.depth: r.r2 for r in alone.collect()}[3] == together[n]
    assert together[4] > together[2] > 0.3  # held-out rows: the label can be learned


def test_a_search_without_result_leaves_the_first_setting(spark, work):
    train = spark.createDataFrame(learnable_rows(["a"], folds=1), LAYOUT)
    fitted = boosting.fit_boosted(train, [("a", "weekdays")], work, boosting.BoostingSettings(iterations=[3, 2], depths=[3, 2]))
    model = fitted.models.first()
    assert fitted.grid.count() == 0 and (model.iterations, model.depth, len(model.trees)) == (3, 3, 3)
    assert all(len(t.splits) == 3 and len(t.leaves) == 8 for t in model.trees)


def test_missing_test_features_are_scored_not_dropped(spark, work, sf_dir):
    modelled = forecast.model_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, ["click"], work)
    settings = boosting.BoostingSettings(iterations=[2], depths=[2])
    fitted = boosting.fit_boosted(boosting.with_cv_folds(modelled.train, 2), [("click", "weekdays")], work, settings)
    rows = modelled.rows.where("day_type = 'weekdays' and not is_train").withColumn("average_grp", F.lit(None).cast("double"))
    scored = boosting.score_boosted(rows, fitted.models)
    assert scored.count() == rows.count() > 0
    assert scored.where("Pred_GBT is null").count() == 0


def test_every_segment_of_a_grid_is_searched(spark, work, sf_dir):
    modelled = forecast.model_sample(event_blocks(spark, sf_dir), EVENT_CALENDAR, EVENT_CHANNELS, work)
    settings = boosting.BoostingSettings(iterations=[1, 2], depths=[1, 2], cv_folds=3)
    train = boosting.training_table(modelled.train, settings, work)
    listed = [(c, d) for c in EVENT_CHANNELS for d in ("weekdays", "weekend")]
    fitted = boosting.fit_boosted(train, listed, work, settings)
    rank = {}
    for r in fitted.grid.collect():
        rank.setdefault((r.cnlname, r.day_type), []).append((-r.r2, r.iterations, r.depth))
    assert {(r.cnlname, r.day_type): (r.iterations, r.depth) for r in fitted.models.collect()} == {s: min(v)[1:] for s, v in rank.items()}
    assert set(rank) == set(listed)
