"""The feature sample: every target block of every fold with what was known at its cutoff."""

from pyspark.sql import DataFrame

from airgrid.functions.calendar import FoldCalendar
from airgrid.operators import features, history, targets
from airgrid.session import Workspace
from airgrid.sources.daily import DailySums


def raw_sample(
    blocks: DataFrame, calendar: FoldCalendar, work: Workspace, sums: DailySums | None = None
) -> tuple[DataFrame, DataFrame]:
    """Targets with their raw averages, and the one-row overall mean that fills the gaps. With `sums`, up to date with
    `blocks`, the averages come from these instead of the history."""
    by_time, by_line, by_title = work.keep_all(sums.averages(calendar) if sums else {
        "by_time": history.time_averages(blocks, calendar),
        "by_line": history.line_averages(blocks, calendar),
        "by_title": history.title_averages(blocks, calendar),
    })
    grid = targets.target_grid(blocks, calendar)
    return features.attach_averages(grid, by_time, by_line, by_title), features.overall_average(grid, by_time)


def filled_sample(blocks: DataFrame, calendar: FoldCalendar, work: Workspace, sums: DailySums | None = None) -> DataFrame:
    rows, mean = raw_sample(blocks, calendar, work, sums)
    return features.fill_gaps(rows, mean)


def feature_sample(blocks: DataFrame, calendar: FoldCalendar, work: Workspace, sums: DailySums | None = None) -> DataFrame:
    """Train and test rows together, with every feature in place."""
    return features.add_differences(filled_sample(blocks, calendar, work, sums))
