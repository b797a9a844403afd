import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from airgrid.functions.calendar import FoldCalendar
from airgrid.operators import history, targets
from airgrid.schema import BLOCKS, conform
from airgrid.session import Workspace, shared_folder
from airgrid.sources import sinks
from airgrid.sources.steps import Step, run_steps
from airgrid.sources.tables import RelationalStore, month_predicates, read_blocks, table_blocks, write_blocks
from airgrid.sources.unify import unify
from checks.grids import line_blocks
from tests.micro import CALENDAR, as_set, blocks, full_blocks


def test_layout_is_fixed_and_required_columns_are_checked(spark):
    rows = spark.createDataFrame([("7", 20240101, 20000, "A", 1)], "blockid string, blockdate long, blocktime int, cnlname string, factratebase int")
    found = conform(rows)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in BLOCKS]
    assert found.first()["blockid"] == 7 and found.first()["prgname"] is None
    with pytest.raises(ValueError, match="blocktime"):
        conform(rows.drop("blocktime"))


def test_unify_aligns_tags_and_keeps_copies(spark):
    old = spark.createDataFrame([(1, 20240101, 0, "A", 1.0, "x")], "blockid int, blockdate int, blocktime int, cnlname string, factratebase double, prgname string")
    new = spark.createDataFrame([("y", 1.0, "A", 0, 20240101, 1), ("y", 1.0, "A", 0, 20240101, 1)], "title string, factratebase double, cnlname string, blocktime int, blockdate int, blockid int")
    found = unify(old, new, rename_new={"title": "prgname"}).select("blockid", "prgname", "VIMB_type", "factratebase")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "x", "old", 1.0), (1, "y", "new", 1.0), (1, "y", "new", 1.0)]


def test_steps_build_on_each_other_and_report_rows(spark, work):
    inputs = {"blocks": spark.range(10).toDF("id")}
    steps = [Step("even", "select id from {blocks} where id % 2 = 0"), Step("none", "select id from {even} where id < 0"),
             Step("both", "select id from {even} union all select id from {blocks}")]
    tables, counts = run_steps(spark, steps, inputs, work)
    assert counts == [("even", 5), ("none", 0), ("both", 15)]
    assert tables["both"].count() == 15


def test_failing_step_stops_the_run(spark, work):
    with pytest.raises(Exception, match="missing_column"):
        run_steps(spark, [Step("bad", "select missing_column from {t}"), Step("never", "select 1")], {"t": spark.range(1)}, work)


def test_month_predicates_cover_each_day_once():
    found = month_predicates(20231115, 20240203)
    assert found == [
        "blockdate >= 20231115 AND blockdate <= 20231131", "blockdate >= 20231201 AND blockdate <= 20231231",
        "blockdate >= 20240101 AND blockdate <= 20240131", "blockdate >= 20240201 AND blockdate <= 20240203",
    ]
    with pytest.raises(ValueError):
        month_predicates(20240102, 20240101)


def test_store_options_come_from_the_environment(monkeypatch):
    monkeypatch.delenv("AIRGRID_JDBC_URL", raising=False)
    with pytest.raises(RuntimeError):
        RelationalStore.from_environment()
    monkeypatch.setenv("AIRGRID_JDBC_URL", "jdbc:example:db")
    monkeypatch.setenv("AIRGRID_JDBC_USER", "u")
    store = RelationalStore.from_environment()
    assert store.url == "jdbc:example:db"
    assert store.properties() == {"user": "u", "fetchsize": "10000", "batchsize": "10000"}


def test_append_repeats_and_replace_does_not(spark, work):
    path = work.path("forecast")
    first, second = [FoldCalendar(start=date(2024, 1, d)) for d in (1, 2)]
    rows = spark.range(3)
    sinks.append_run(sinks.stamp(rows, first), path)
    sinks.append_run(sinks.stamp(rows, second), path)
    sinks.append_run(sinks.stamp(rows, second), path)
    read = spark.read.schema("id long, Today string").parquet(path)
    assert {r.Today: r["count"] for r in read.groupBy("Today").count().collect()} == {"2024-01-04": 3, "2024-01-05": 6}
    sinks.append_run(sinks.stamp(rows, second), path, replace_run=True)
    spark.catalog.refreshByPath(path)
    read = spark.read.schema("id long, Today string").parquet(path)
    assert {r.Today: r["count"] for r in read.groupBy("Today").count().collect()} == {"2024-01-04": 3, "2024-01-05": 3}


def test_append_to_a_catalog_table(spark):
    rows = sinks.stamp(spark.range(2), FoldCalendar(start=date(2024, 1, 1)))
    sinks.append_run_table(rows, "forecast_rows")
    sinks.append_run_table(rows, "forecast_rows")
    assert spark.table("forecast_rows").count() == 4
    spark.sql("drop table forecast_rows")


def test_coefficient_rows_keep_feature_order(spark):
    fitted = spark.createDataFrame(
        [("A", "weekend", [float(i) for i in range(8)], [float(-i) for i in range(8)])],
        "cnlname string, day_type string, nnls array<double>, sgd array<double>",
    )
    found = sinks.coefficient_rows(fitted).collect()
    assert [(r.position, r.nnls, r.sgd) for r in found] == [(i, float(i), float(-i)) for i in range(8)]
    assert found[4].feature == "isprime"


def test_staged_segments_keep_names_that_look_like_numbers_or_paths(spark, work):
    rows = spark.createDataFrame([("5", "weekdays", 1), ("2х2", "weekend", 2), ("a/b=c", "weekend", 3)], "cnlname string, day_type string, v int")
    kept = work.keep(rows, "segments", partition_by=["cnlname", "day_type"])
    assert kept.schema.simpleString() == rows.schema.simpleString()
    assert as_set(kept) == as_set(rows)


def test_stages_go_to_the_configured_folder(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    work = Workspace(spark)
    work.keep(spark.range(3), "numbers")
    assert any(name.endswith("numbers") for name in os.listdir(work.root.removeprefix("file:")))


def test_stage_plans_start_from_files(spark, work):
    kept = work.keep(spark.range(100).groupBy((F.col("id") % 3).alias("k")).count(), "counts")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet" in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_their_columns_and_days_only(spark, work):
    path = work.path("blocks")
    rows = [dict(blockid=d, blockdate=20240100 + d, blocktime=20000, cnlname="A", factratebase=1.0, proid=1, pro2=1) for d in range(1, 32)]
    write_blocks(full_blocks(spark, rows), path)
    stored = read_blocks(spark, path)
    assert as_set(stored) == as_set(full_blocks(spark, rows))
    calendar = FoldCalendar(start=date(2024, 1, 11), lookback=0, last_horizon=5, history_floor=20240103)
    for df, columns in [
        (history.time_averages(stored, calendar), "struct<blocktime:int,cnlname:string,factratebase:double>"),
        (history.line_averages(stored, calendar), "struct<blocktime:int,factratebase:double,proid:int>"),
        (history.title_averages(stored, calendar), "struct<blocktime:int,cnlname:string,factratebase:double,pro2:int>"),
    ]:
        plan = plan_of(df)
        assert f"ReadSchema: {columns}" in plan
        assert "PartitionFilters: [isnotnull(blockdate" in plan and "<= 20240110)" in plan
    plan = plan_of(targets.target_grid(stored, calendar))
    assert "(blockdate" in plan and "> 20240110)" in plan and "<= 20240115)" in plan
    assert targets.target_grid(stored, calendar).count() == 5


def test_catalog_blocks(spark):
    blocks(spark).createOrReplaceTempView("grid")
    assert as_set(table_blocks(spark, "grid")) == as_set(blocks(spark))


def test_feature_plan_has_no_pairing_joins_and_stays_on_the_jvm(spark, work, sf_dir):
    from airgrid.plans.sample import feature_sample

    from checks.grids import LINE_CALENDAR

    plan = plan_of(feature_sample(line_blocks(spark, sf_dir), LINE_CALENDAR, work))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window"):
        assert unwanted not in plan
    assert plan.count("Subquery") >= 1


def test_averages_shuffle_sums_and_never_repeat_rows_per_fold(spark):
    plan = plan_of(history.line_averages(blocks(spark), CALENDAR))
    assert "Generate" not in plan and "Join" not in plan
    assert "partial_sum" in plan[plan.rindex("Exchange"):]


def test_steps_from_files(spark, work, tmp_path):
    (tmp_path / "small.sql").write_text("select id from {t} where id < 3;\n")
    step = Step.from_file(str(tmp_path / "small.sql"))
    assert step == Step("small", "select id from {t} where id < 3")
    assert run_steps(spark, [step], {"t": spark.range(9)}, work)[1] == [("small", 3)]


def test_only_the_written_days_are_replaced(spark, work):
    path = work.path("network")
    write_blocks(full_blocks(spark, [dict(blockid=1, blockdate=20240101), dict(blockid=2, blockdate=20240102)]), path)
    write_blocks(full_blocks(spark, [dict(blockid=3, blockdate=20240102)]), path)
    assert sorted(r.blockid for r in read_blocks(spark, path).collect()) == [1, 3]


@pytest.mark.parametrize("master,folder,works", [
    ("local[2]", "", True), ("local", "", True), ("local-cluster[2,1,900]", "", False), ("spark://h:7077", "", False),
    ("spark://h:7077", "file:/x", False), ("spark://h:7077", "hdfs://h/x", True), ("local-cluster[2,1,900]", "file:/x", True),
])
def test_the_shared_folder_is_one_that_executors_reach(master, folder, works, tmp_path):
    from types import SimpleNamespace

    given = folder or None
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: given, setCheckpointDir=lambda d: None)
    if not folder and works:
        context.getCheckpointDir = iter([None, str(tmp_path)]).__next__
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: given), sparkContext=context)
    if works:
        assert shared_folder(session)
    else:
        with pytest.raises(RuntimeError):
            shared_folder(session)
