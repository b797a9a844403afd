"""Daily sums, merged grids, published runs and restarted steps on small tables."""

import os

import pytest
from pyspark.sql import functions as F

from airgrid.operators import history
from airgrid.operators.asof import per_fold
from airgrid.schema import BLOCKS
from airgrid.sources import files, merge
from airgrid.sources.daily import DailySums, day_sums
from airgrid.sources.runs import RunTables
from airgrid.sources.steps import Step, StepLog, run_steps
from airgrid.sources.tables import read_blocks, table_blocks, write_blocks
from checks.queries import QUERIES
from tests.micro import CALENDAR, as_set, blocks, full_blocks


def day(number, n=3, rating=1.0, **more):
    rows = [dict(blockid=100 * number + i, blockdate=20240100 + number, blocktime=20000 + 1800 * i, cnlname="A", factratebase=rating + i, proid=i, pro2=i, VIMB_type="old") for i in range(n)]
    return [r | more for r in rows]


# Daily sums

def equal_averages(sums, rows, calendar):
    found, wanted = sums.averages(calendar), {
        "by_time": history.time_averages(rows, calendar), "by_line": history.line_averages(rows, calendar), "by_title": history.title_averages(rows, calendar),
    }
    return all(as_set(per_fold(found[name])) == as_set(per_fold(wanted[name])) for name in wanted)


def test_averages_from_daily_sums_equal_those_from_the_history(spark, work):
    network, sums = work.path("network"), DailySums(spark, work.path("state"))
    rows = blocks(spark)
    write_blocks(rows, network)
    assert sums.update(network, work) == sorted({r.blockdate for r in rows.collect()})
    assert equal_averages(sums, read_blocks(spark, network), CALENDAR)
    assert sums.update(network, work) == []


def test_a_new_day_alone_is_read(spark, work, monkeypatch):
    network, sums = work.path("network"), DailySums(spark, work.path("state"))
    write_blocks(full_blocks(spark, day(1) + day(2) + day(3)), network)
    assert sums.update(network, work) == [20240101, 20240102, 20240103]
    write_blocks(full_blocks(spark, day(4)), network)
    seen = []
    monkeypatch.setattr("airgrid.sources.daily.day_sums", lambda rows: (seen.append(rows), day_sums(rows))[1])
    assert sums.update(network, work) == [20240104]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(blockdate" in plan and "20240104)" in plan and "20240103" not in plan
    assert sorted(r.blockdate for r in sums.days().collect()) == [20240101, 20240102, 20240103, 20240104]


def test_replaced_emptied_and_lost_days(spark, work):
    network, sums = work.path("network"), DailySums(spark, work.path("state"))
    write_blocks(full_blocks(spark, day(1) + day(2) + day(3)), network)
    sums.update(network, work)
    write_blocks(full_blocks(spark, day(2, rating=7.0, pro2=0)), network)  # no title left on this day
    files.delete(spark, f"{network}/blockdate=20240103")
    assert sums.update(network, work) == [20240102]
    assert {r.blockdate for r in sums.sums("title").collect()} == {20240101}
    assert {r.blockdate for r in sums.sums("line").collect()} == {20240101, 20240102}
    assert equal_averages(sums, read_blocks(spark, network), CALENDAR)


def test_an_update_that_was_cut_off_is_made_up_for(spark, work, monkeypatch):
    network, sums = work.path("network"), DailySums(spark, work.path("state"))
    write_blocks(full_blocks(spark, day(1) + day(2)), network)
    monkeypatch.setattr(spark, "createDataFrame", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")) if a[-1] == "version string, blockdate int" and a[0] else type(spark).createDataFrame(spark, *a))
    with pytest.raises(RuntimeError):
        sums.update(network, work)
    monkeypatch.undo()
    assert sums.sums("time").count() == 0  # written, but without its version nobody reads it
    assert sums.update(network, work) == [20240101, 20240102]
    assert sums.sums("line").agg(F.sum("n")).first()[0] == 6
    assert equal_averages(sums, read_blocks(spark, network), CALENDAR)


# Merged grids

def test_merge_keeps_what_a_part_of_a_day_does_not_hold(spark, work):
    path = work.path("network")
    merge.merge_blocks(full_blocks(spark, day(1) + day(2)), path, work)
    fixed = [day(1)[0] | {"factratebase": 9.0}, day(2)[1], dict(day(2)[2], blockdate=20240103), dict(day(1)[0], blockid=900)]
    changes = {(r.blockid, r.change) for r in merge.merge_blocks(full_blocks(spark, fixed), path, work).collect()}
    assert changes == {(100, "changed"), (201, "same"), (202, "changed"), (900, "added")}
    got = {r.blockid: (r.blockdate, r.factratebase) for r in read_blocks(spark, path).collect()}
    assert got == {100: (20240101, 9.0), 101: (20240101, 2.0), 102: (20240101, 3.0), 200: (20240102, 1.0), 201: (20240102, 2.0), 202: (20240103, 3.0), 900: (20240101, 1.0)}


def test_merge_of_whole_days_removes_what_they_no_longer_hold(spark, work):
    path = work.path("network")
    merge.merge_blocks(full_blocks(spark, day(1) + day(2)), path, work)
    fixed = [dict(r, blockdate=20240102) for r in day(1)]  # the first day's blocks moved: that day is empty now
    changes = merge.merge_blocks(full_blocks(spark, fixed), path, work, whole_days=True).collect()
    assert {(r.blockid, r.change) for r in changes} == {(100, "changed"), (101, "changed"), (102, "changed"), (200, "gone"), (201, "gone"), (202, "gone")}
    assert {(r.blockid, r.blockdate) for r in read_blocks(spark, path).collect()} == {(100, 20240102), (101, 20240102), (102, 20240102)}
    assert not files.exists(spark, f"{path}/blockdate=20240101")


def test_merge_with_null_and_repeated_keys_and_values_that_swap(spark, work):
    path = work.path("network")
    rows = day(1, n=2) + [day(1)[0]] + [dict(day(1)[0], blockid=None, VIMB_type=None)] + [dict(day(1)[0], blockid=5, proid=4, pro2=None)]
    merge.merge_blocks(full_blocks(spark, rows), path, work)
    same = merge.merge_blocks(full_blocks(spark, rows), path, work)
    assert {r.change for r in same.collect()} == {"same"} and merge.touched_days(same) == []
    fixed = [day(1)[0], dict(day(1)[0], blockid=None, VIMB_type=None, factratebase=None), dict(day(1)[0], blockid=5, proid=None, pro2=4)]
    changes = {r.blockid: r.change for r in merge.merge_blocks(full_blocks(spark, fixed), path, work).collect()}
    assert changes == {100: "changed", None: "changed", 5: "changed"}  # 100 came twice before
    got = read_blocks(spark, path).collect()
    assert sorted((r.blockid or 0) for r in got) == [0, 5, 100, 101]
    assert [(r.proid, r.pro2) for r in got if r.blockid == 5] == [(None, 4)]


def test_days_without_a_change_keep_their_files(spark, work):
    path = work.path("network")
    merge.merge_blocks(full_blocks(spark, day(1) + day(2)), path, work)
    before = {d: set(os.listdir(f"{path.removeprefix('file:')}/blockdate={d}")) for d in (20240101, 20240102)}
    merge.merge_blocks(full_blocks(spark, day(1) + [dict(day(2)[0], factratebase=4.0)]), path, work)
    after = {d: set(os.listdir(f"{path.removeprefix('file:')}/blockdate={d}")) for d in (20240101, 20240102)}
    assert before[20240101] == after[20240101] and before[20240102] != after[20240102]


def test_merge_into_a_catalog_table(spark, work):
    try:
        merge.merge_table(full_blocks(spark, day(1) + day(2)), "merged_network", work)
        merge.merge_table(full_blocks(spark, [dict(r, blockdate=20240103) for r in day(2)]), "merged_network", work)
        assert {(r.blockid, r.blockdate) for r in table_blocks(spark, "merged_network").collect()} == {(100 + i, 20240101) for i in range(3)} | {(200 + i, 20240103) for i in range(3)}
        assert merge.touched_days(merge.merge_table(full_blocks(spark, day(1)), "merged_network", work)) == []
    finally:
        spark.sql("drop table if exists merged_network")


def test_a_merge_reads_no_other_column_of_the_history(spark, work):
    path = work.path("network")
    write_blocks(full_blocks(spark, day(1)), path)
    plan = merge.block_changes(read_blocks(spark, path), full_blocks(spark, day(1)).select(*BLOCKS.fieldNames()))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


# Published runs

@pytest.mark.parametrize("sink", ["files", "catalog"])
def test_runs_show_all_their_tables_or_none(spark, work, sink):
    root = work.path("tables") if sink == "files" else "published_"
    tables, rows = RunTables(spark, root, sink), spark.range(5)
    try:
        assert tables.read("a", rows.schema).count() == 0 and not tables.is_published("one")
        attempt = tables.stage("one", {"a": rows})  # killed before the second table
        assert tables.read("a", rows.schema).count() == 0
        assert tables.publish("one", {"a": rows, "b": rows.where("id < 2")})
        assert not tables.publish("one", {"a": rows, "b": rows})
        assert (tables.read("a", rows.schema).count(), tables.read("b", rows.schema).count()) == (5, 2)
        assert tables.publish("two", {"a": rows.where("id = 4"), "b": rows.where("false")})
        assert tables.publish("one", {"a": rows.where("id > 2"), "b": rows.where("false")}, replace=True)
        assert sorted(tuple(r) for r in tables.read("a", rows.schema, with_run=True).collect()) == [(3, "one"), (4, "one"), (4, "two")]
        assert tables.read("b", rows.schema).count() == 0
        assert attempt not in {r.attempt_id for r in tables.published().collect()}
        assert tables.remove_others() == 3  # of the killed one a table, of the replaced one both
        assert tables.remove_others() == 0 and tables.read("a", rows.schema).count() == 3
    finally:
        if sink == "catalog":
            for name in ("a", "b", "manifest"):
                spark.sql(f"drop table if exists published_{name}")


def test_a_table_that_fails_leaves_the_run_unseen(spark, work):
    tables, rows = RunTables(spark, work.path("tables")), spark.range(3)
    broken = rows.select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.publish("run", {"a": rows, "b": broken})
    assert not tables.is_published("run") and tables.read("a", rows.schema).count() == 0
    assert tables.publish("run", {"a": rows, "b": rows}) and tables.read("a", rows.schema).count() == 3


# Restarted steps

def test_a_run_goes_on_with_the_step_that_failed(spark, work):
    numbers = work.keep(spark.range(10).toDF("id"), "numbers")
    log, made = StepLog(spark, work.path("log")), []
    steps = [Step("even", "select id from {numbers} where id % 2 = 0"), Step("large", "select id from {even} where id > 3")]
    failing = Step("last", "select raise_error('stop') as id from {large}")
    with pytest.raises(Exception, match="stop"):
        run_steps(spark, [*steps, failing], {"numbers": numbers}, work, log)
    assert len(log.done()) == 2
    real = spark.sql
    spark.sql = lambda text, **tables: (made.append(text), real(text, **tables))[1]
    try:
        tables, counts = run_steps(spark, [*steps, Step("last", "select max(id) as id from {large}")], {"numbers": numbers}, work, log)
    finally:
        del spark.sql
    assert made == ["select max(id) as id from {large}"]
    assert counts == [("even", 5), ("large", 3), ("last", 1)] and tables["last"].first()["id"] == 8


def test_a_step_is_made_again_when_its_input_or_sql_changes(spark, work):
    log, path = StepLog(spark, work.path("log")), work.path("numbers")
    step = Step("n", "select count(*) as n from {t}")
    for rows, expected in ((3, 1), (4, 2)):
        spark.range(rows).write.mode("overwrite").parquet(path)
        table = spark.read.parquet(path)
        for _ in range(2):
            found, _ = run_steps(spark, [step], {"t": table}, work, log)
            assert found["n"].first()["n"] == rows and len(log.done()) == expected
    run_steps(spark, [Step("n", "select count(*) + 1 as n from {t}")], {"t": table}, work, log)
    run_steps(spark, [step], {"t": table.where("id > 0")}, work, log)
    assert len(log.done()) == 4
    run_steps(spark, [step], {"t": spark.range(2)}, work, log)  # no files: nothing tells its content, so it is not kept
    assert len(log.done()) == 4


@pytest.mark.parametrize("name", ["merge_changes", "state_updates"])
def test_queries_have_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
