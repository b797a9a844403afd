"""The batch run from the command line.

    python -m airgrid --old /grids/old --new /grids/new --network /grids/network --tables /forecast

or, on a cluster, `spark-submit --py-files airgrid.zip airgrid/__main__.py ...` with the same options.

Unifies the grids into the network table (or takes `--network` as it is when no grids are given),
then forecasts from the start day on and appends to the tables below `--tables`.

Instead of the built-in unification, `--sql` steps can make the network table: one query per file, run in order over
`{old}`, `{new}` and the steps before; the last result is the network table, and each step's row count goes to
the table `step_counts`. With `--step-log`, a run goes on after the last step that an earlier one has written. The result
is merged into the network table by block and origin; only days with a change are written.

All tables of a run are published together under `--run`, by default the run date. A run that is published already does
nothing, unless `--replace-run` is given. With `--state`, the averages come from daily sums kept in that folder.

`--source` and `--sink` say where tables are: `files` (paths), `catalog` (names), or `jdbc` (names in the database that
AIRGRID_JDBC_URL and its companions point to; what a run needs of it is read once and staged).
"""

import argparse
import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from airgrid import config
from airgrid.functions.calendar import FoldCalendar, default_start
from airgrid.operators.boosting import BoostingSettings
from airgrid.operators.sgd import SgdSettings
from airgrid.plans.forecast import run_forecast, run_tables
from airgrid.schema import conform
from airgrid.session import Workspace, build_session
from airgrid.sources.daily import DailySums
from airgrid.sources.merge import merge_blocks, merge_table
from airgrid.sources.runs import RunTables
from airgrid.sources.sinks import stamp
from airgrid.sources.steps import Step, StepLog, run_steps
from airgrid.sources.tables import RelationalStore, read_blocks, table_blocks
from airgrid.sources.unify import unify


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="airgrid", description="Forecast block ratings per channel and day type.")
    parser.add_argument("--network", required=True, help="unified block table; written if grids are given, else read")
    parser.add_argument("--old", help="old grid")
    parser.add_argument("--new", help="new grid")
    parser.add_argument("--rename-old", type=json.loads, default={}, help='JSON, such as {"title": "prgname"}')
    parser.add_argument("--rename-new", type=json.loads, default={}, help="the same for the new grid")
    parser.add_argument("--format", default="parquet", help="file format of the grids")
    parser.add_argument("--sql", nargs="+", default=[], metavar="FILE", help="SQL steps that make the network table from the grids")
    parser.add_argument("--source", choices=["files", "catalog", "jdbc"], default="files", help="where grids and network table are")
    parser.add_argument("--sink", choices=["files", "catalog", "jdbc"], default="files", help="where the result tables go")
    parser.add_argument("--tables", required=True, help="folder of the forecast, coefficient and status tables, or what their names begin with")
    parser.add_argument("--start", type=date.fromisoformat, default=None, help="first day to forecast (default: three days ago)")
    parser.add_argument("--lookback", type=int, default=config.LOOKBACK_DAYS)
    parser.add_argument("--step", type=int, default=config.STEP_DAYS)
    parser.add_argument("--horizon", type=int, default=config.LAST_HORIZON_DAYS)
    parser.add_argument("--history-floor", type=int, default=config.HISTORY_FLOOR)
    parser.add_argument("--channels", nargs="*", default=None, help="default: the configured list")
    parser.add_argument("--exclude", nargs="*", default=None, help="default: the configured exclusions")
    parser.add_argument("--iterations", type=int, nargs="+", default=config.BOOSTING_ITERATIONS)
    parser.add_argument("--depths", type=int, nargs="+", default=config.BOOSTING_DEPTHS)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--step-log", help="folder of written SQL steps, to go on from after a failure")
    parser.add_argument("--whole-days", action="store_true", help="the grids hold all blocks of their days: others on these days go")
    parser.add_argument("--state", help="folder of daily sums, kept from run to run")
    parser.add_argument("--run", help="name that the run is published under (default: the run date)")
    parser.add_argument("--replace-run", action="store_true", help="publish the run anew if it is published already")
    parser.add_argument("--keep-stages", action="store_true", help="leave the intermediate tables in the shared folder")
    options = parser.parse_args(arguments)
    if bool(options.old) != bool(options.new):
        parser.error("--old and --new go together: unifying takes both grids")
    if options.sql and not options.old:
        parser.error("--sql steps need --old and --new")
    if options.source == "jdbc" and options.old:
        parser.error("grids are read from files or the catalog; of a database only the network table is")
    if options.replace_run and options.sink == "jdbc":
        parser.error("a database keeps no runs apart: --replace-run works on files and in the catalog")
    if options.state and options.source != "files":
        parser.error("--state needs a network table in files")
    if options.step_log and not options.sql:
        parser.error("--step-log goes with --sql")
    return options


def network(spark: SparkSession, options: argparse.Namespace, calendar: FoldCalendar, work: Workspace) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The network table, made from the grids first if there are any, and what there is to publish about that."""
    found = {}
    if options.old:
        load = spark.table if options.source == "catalog" else spark.read.format(options.format).load
        old, new = load(options.old), load(options.new)
        if options.sql:
            steps = [Step.from_file(path) for path in options.sql]
            log = StepLog(spark, options.step_log) if options.step_log else None
            made, counts = run_steps(spark, steps, {"old": old, "new": new}, work, log)
            blocks = conform(made[steps[-1].name])
            found["step_counts"] = stamp(spark.createDataFrame(counts, "step string, row_count long"), calendar)
        else:
            blocks = unify(old, new, options.rename_old, options.rename_new)
        merge = merge_table if options.source == "catalog" else merge_blocks
        merge(blocks, options.network, work, options.whole_days)
    if options.source == "catalog":
        return table_blocks(spark, options.network), found
    if options.source == "jdbc":
        store = RelationalStore.from_environment()
        rows = store.read_blocks(spark, options.network, calendar.history_floor, calendar.folds[-1].target_to)
        return work.keep(rows, "network"), found
    return read_blocks(spark, options.network), found


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parse(arguments)
    spark = spark or build_session()
    calendar = FoldCalendar(
        options.start or default_start(), options.lookback, options.step, options.horizon, options.history_floor
    )
    run_id = options.run or calendar.run_date
    published = RunTables(spark, options.tables, options.sink) if options.sink != "jdbc" else None
    if published and not options.replace_run and published.is_published(run_id):
        return
    work = Workspace(spark)
    try:
        blocks, tables = network(spark, options, calendar, work)
        sums = DailySums(spark, options.state) if options.state else None
        if sums:
            sums.update(options.network, work)
        run = run_forecast(
            blocks, calendar, work, options.channels, options.exclude, SgdSettings(seed=options.seed),
            BoostingSettings(iterations=options.iterations, depths=options.depths), sums,
        )
        tables |= run_tables(run)
        if published:
            published.publish(run_id, tables, options.replace_run)
        else:
            store = RelationalStore.from_environment()
            for name, rows in tables.items():
                store.append(rows, f"{options.tables}{name}")
    finally:
        if not options.keep_stages:
            work.remove()


if __name__ == "__main__":
    main()
