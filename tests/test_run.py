"""Whole runs: forecast, status, isolation of failures, appended tables."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrid import config
from airgrid.operators import boosting
from airgrid.plans import forecast
from airgrid.sources.runs import RunTables
from checks.grids import EVENT_CALENDAR, EVENT_CHANNELS, event_blocks
from checks.queries import QUERIES
from tests.micro import as_set

QUICK = boosting.BoostingSettings(iterations=[2], depths=[2])


@pytest.fixture(scope="module")
def bad_blocks(spark, sf_dir):
    """The event grid, with a null flag that spoils one channel's features."""
    spoiled = (F.col("cnlname") == "view") & (F.col("blockdate") < EVENT_CALENDAR.start_key)
    return event_blocks(spark, sf_dir).withColumn("isprime", F.when(~spoiled, F.col("isprime")))


def test_run_reports_each_segment_and_forecasts_the_sound_ones(spark, work, bad_blocks):
    channels = [*EVENT_CHANNELS, "off air"]
    run = forecast.run_forecast(bad_blocks, EVENT_CALENDAR, work, channels, ["error"], boosting_settings=QUICK)
    status = {(r.cnlname, r.day_type): r.status for r in run.status.collect()}
    assert len(status) == 10 and not any(c == "error" for c, _ in status)
    assert {status["view", d] for d in ("weekdays", "weekend")} == {"failed"}
    assert {status["off air", d] for d in ("weekdays", "weekend")} == {"empty"}
    sound = {s for s, outcome in status.items() if outcome == "loaded"}
    assert {c for c, _ in sound} == {"click", "purchase", "signup"}

    assert run.forecast.columns == forecast.FORECAST_COLUMNS
    rows = run.forecast.toPandas()
    assert set(rows.cnlname) == {"click", "purchase", "signup"}
    assert (rows.blockdate >= EVENT_CALENDAR.start_key).all() and (rows.Today == "2024-01-28").all()
    assert rows[["Pred_GBT", "Pred_NNLS", "Pred_SGD"]].notna().all().all()

    weights = {(r.cnlname, r.day_type, r.feature): r.nnls for r in run.coefficients.collect()}
    assert len(weights) == 8 * len(sound)
    for r in rows.sample(20, random_state=1).itertuples():
        day_type = "weekend" if r.weekday in (3, 4) else "weekdays"
        expected = sum(weights[r.cnlname, day_type, f] * getattr(r, f) for f in config.FEATURES)
        assert abs(expected - r.Pred_NNLS) < 1e-9

    tables = RunTables(spark, work.path("tables"))
    assert forecast.publish_forecast(run, tables)
    for again in (False, True):  # a repeated run is not appended; a replaced one takes the place of the first
        assert forecast.publish_forecast(run, tables, replace=again) == again
        assert tables.read("forecast", forecast.FORECAST).count() == len(rows)
        assert tables.read("segment_status", run.status.schema).count() == 10
        assert tables.read("coefficients", run.coefficients.schema).count() == 8 * len(sound)


def test_run_without_any_sound_segment_still_reports(spark, work, sf_dir):
    run = forecast.run_forecast(event_blocks(spark, sf_dir), EVENT_CALENDAR, work, ["off air"], [], boosting_settings=QUICK)
    assert run.forecast.count() == 0
    assert as_set(run.status.select("cnlname", "status")) == {("off air", "empty")}
    assert run.coefficients.count() == 0 and run.grid.count() == 0


def test_weights_that_are_no_number_count_as_zero_and_infinite_ones_show(spark):
    inf, nan = float("inf"), float("nan")
    coefficients = spark.createDataFrame(
        [("click", "weekdays", [1.0] * 8, [2.0, 0.0, nan, None, 0.0, 0.0, 0.0, 0.0]), ("click", "weekend", [1.0] * 8, [2.0, inf, nan, *[0.0] * 5])],
        "cnlname string, day_type string, nnls array<double>, sgd array<double>",
    )
    layout = ", ".join(["cnlname string", "day_type string", *[f"{f} double" for f in config.FEATURES]])
    rows = spark.createDataFrame([("click", "weekdays", *[1.0] * 8), ("click", "weekend", *[1.0] * 8)], layout)
    found = {r.day_type: r for r in forecast.score_linear(rows, coefficients).collect()}
    assert found["weekdays"].Pred_SGD == 2.0 and found["weekdays"].Pred_NNLS == 8.0
    assert found["weekend"].Pred_SGD == inf


def test_a_segment_at_one_moment_is_searched_and_loaded(spark, work, sf_dir):
    """All training rows on one day and slot: folds are cut inside it, and the forecasts stay."""
    moved = (F.col("cnlname") == "view") & (F.col("blockdate") < EVENT_CALENDAR.start_key)
    blocks = event_blocks(spark, sf_dir).withColumns({
        "blockdate": F.when(moved, F.lit(20240118)).otherwise(F.col("blockdate")),
        "blocktime": F.when(moved, F.lit(40000)).otherwise(F.col("blocktime")),
    })
    grid = boosting.BoostingSettings(iterations=[1, 2], depths=[2], cv_folds=3)
    run = forecast.run_forecast(blocks, EVENT_CALENDAR, work, ["view"], [], boosting_settings=grid)
    status = {r.day_type: r.status for r in run.status.collect()}
    assert "loaded" in status.values() and "failed" not in status.values()
    assert run.grid.count() >= 2


def test_replacing_a_run_clears_what_it_no_longer_has(spark, work, sf_dir):
    tables = RunTables(spark, work.path("tables"))
    run = forecast.run_forecast(event_blocks(spark, sf_dir), EVENT_CALENDAR, work, ["click"], [], boosting_settings=QUICK)
    forecast.publish_forecast(run, tables)
    layout = tables.read("forecast", forecast.FORECAST)
    assert dict(layout.dtypes)["Today"] == "string" and layout.first()["Today"] == "2024-01-28"
    empty = forecast.run_forecast(event_blocks(spark, sf_dir), EVENT_CALENDAR, work, ["off air"], [], boosting_settings=QUICK)
    forecast.publish_forecast(empty, tables, replace=True)
    for name, schema in (("forecast", forecast.FORECAST), ("coefficients", run.coefficients.schema)):
        assert tables.read(name, schema).count() == 0
    assert tables.read("segment_status", run.status.schema).count() == 2


@pytest.mark.parametrize("arguments", [
    ["--old", "x"], ["--new", "x"], ["--sql", "a.sql"], ["--source", "jdbc", "--old", "x", "--new", "y"], ["--sink", "jdbc", "--replace-run"],
    ["--step-log", "x"], ["--state", "x", "--source", "catalog"],
])
def test_options_that_do_not_go_together_are_refused(arguments, capsys):
    from airgrid import __main__ as command

    with pytest.raises(SystemExit):
        command.parse(["--network", "n", "--tables", "t", *arguments])


def test_command_line_run_over_catalog_tables_with_sql_steps(spark, work, sf_dir, tmp_path):
    """The network table comes from the last step, days outside it stay, counts and results go to catalog tables."""
    from airgrid import __main__ as command
    from checks.grids import NEW_GRID_NAMES, event_grids

    old, new = event_grids(spark, sf_dir)
    old.write.saveAsTable("grid_old")
    new.withColumnsRenamed(NEW_GRID_NAMES).write.saveAsTable("grid_new")
    names = old.columns
    (tmp_path / "kept.sql").write_text("select * from {old} where blockdate > 0;")
    (tmp_path / "both.sql").write_text(
        f"select {', '.join(names)}, 'old' as VIMB_type from {{kept}} union all select {', '.join(names)}, 'new' as VIMB_type from {{new}}"
    )
    arguments = [
        "--source", "catalog", "--sink", "catalog", "--old", "grid_old", "--new", "grid_new", "--network", "network", "--tables", "run_",
        "--sql", str(tmp_path / "kept.sql"), str(tmp_path / "both.sql"), "--start", "2024-01-25", "--lookback", "14", "--step", "7",
        "--history-floor", "20230101", "--channels", "click", "--exclude", "--iterations", "2", "--depths", "2",
    ]
    try:
        command.main(arguments, spark)
        n = spark.table("network").count()
        assert n == old.count() + new.count()
        assert {r.step: r.row_count for r in spark.table("run_step_counts").collect()} == {"kept": old.count(), "both": n}
        assert spark.table("run_forecast").count() > 0 and {r.status for r in spark.table("run_segment_status").collect()} == {"loaded"}
        forecasts = spark.table("run_forecast").count()
        command.main(arguments, spark)  # that run is published: nothing happens
        command.main([*arguments, "--run", "again", "--step-log", f"file:{tmp_path}/log"], spark)
        assert spark.table("network").count() == n and spark.table("run_forecast").count() == 2 * forecasts
        assert {r.run_id for r in spark.table("run_manifest").collect()} == {"2024-01-28", "again"}
    finally:
        for name in ("grid_old", "grid_new", "network", "run_step_counts", "run_forecast", "run_coefficients", "run_segment_status", "run_manifest"):
            spark.sql(f"drop table if exists {name}")


def test_a_failed_run_leaves_no_stage(spark, work, sf_dir):
    from airgrid import __main__ as command

    path = work.path("network")
    event_blocks(spark, sf_dir).limit(5).write.parquet(path)
    shared = os.path.dirname(work.root).removeprefix("file:")
    before = set(os.listdir(shared))
    with pytest.raises(Exception):
        command.main(["--network", path, "--tables", "nowhere://x", "--start", "2024-01-25", "--channels", "click"], spark)
    assert set(os.listdir(shared)) == before


def test_command_line_run(spark, work, sf_dir):
    """Grids in, tables out; a second run of the same day replaces the first; no stage is left behind."""
    from airgrid import __main__ as command
    from checks.grids import NEW_GRID_NAMES, event_grids

    root = work.path("cli")
    old, new = event_grids(spark, sf_dir)
    old.write.parquet(f"{root}/old")
    new.write.parquet(f"{root}/new")
    arguments = [
        "--old", f"{root}/old", "--new", f"{root}/new", "--rename-new", json.dumps(NEW_GRID_NAMES),
        "--network", f"{root}/network", "--tables", f"{root}/tables", "--start", "2024-01-25",
        "--lookback", "14", "--step", "7", "--history-floor", "20230101",
        "--channels", *EVENT_CHANNELS, "--exclude", "view", "--iterations", "2", "--depths", "2", "--replace-run", "--state", f"{root}/state",
    ]
    shared = os.path.dirname(work.root).removeprefix("file:")
    before = set(os.listdir(shared))
    command.main(arguments, spark)
    tables = RunTables(spark, f"{root}/tables")
    first = tables.read("forecast", forecast.FORECAST).count()
    command.main(arguments, spark)
    assert set(os.listdir(shared)) == before
    assert tables.read("forecast", forecast.FORECAST).count() == first > 0
    assert as_set(spark.read.parquet(f"{root}/network")) == as_set(event_blocks(spark, sf_dir).select(spark.read.parquet(f"{root}/network").columns))
    status = tables.read("segment_status", T.StructType.fromDDL("cnlname string, status string"))
    assert {r.status for r in status.collect()} == {"loaded"} and status.count() == 8


@pytest.mark.parametrize("name", ["forecast", "boosted_forecast", "run_status"])
def test_queries_search_every_setting(spark, sf_dir, monkeypatch, name):
    class Searched(Exception):
        pass

    def fit(train, listed, work, settings=boosting.BoostingSettings()):
        raise Searched(settings)

    monkeypatch.setattr(boosting, "fit_boosted", fit)
    with pytest.raises(Searched) as found:
        QUERIES[name](spark, sf_dir)
    assert found.value.args == (boosting.BoostingSettings(),)
