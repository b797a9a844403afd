"""What is known up to each cutoff: average ratings by time, programme line and title.

Each table has one row per key, with an array over the folds for every mean.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.calendar import FoldCalendar, day_key, slot, wrapped_slot
from airgrid.operators.asof import means_as_of


def history(blocks: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """Distinct (day, channel, time, rating) rows from the floor to the last cutoff.

    The day key follows from the day, so it is left out of the de-duplication. Copies collapse
    map-side; what is shuffled is spread over all four columns, whatever one channel's share.
    """
    return (
        blocks.where(F.col("blockdate").between(calendar.history_floor, calendar.last_cutoff))
        .select("cnlname", "blocktime", "blockdate", "factratebase")
        .distinct()
        .select(day_key(F.col("blockdate")).alias("weekday"), "cnlname", "blocktime", "blockdate", "factratebase")
    )


def time_averages(blocks: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """Mean rating by day key, channel and wrapped slot: all history, trailing week, trailing month.

    Both trailing ranges include their first day and the cutoff (8 and 32 days).
    """
    rows = (
        history(blocks, calendar)
        .where(F.col("cnlname").isNotNull() & F.col("blocktime").isNotNull())
        .withColumn("hour", wrapped_slot(F.col("blocktime")))
    )
    return means_as_of(rows, ["weekday", "cnlname", "hour"], calendar.folds, {
        "average_grp": None, "average_grp_week": "week_from", "average_grp_month": "month_from",
    })


def line_averages(blocks: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """Mean rating by programme line, slot and day key, over all channels and all rows, copies included.

    A missing line is a group of its own.
    """
    rows = blocks.where(F.col("blockdate") <= calendar.last_cutoff).select(
        "proid", slot(F.col("blocktime")).alias("hour"), day_key(F.col("blockdate")).alias("weekday"), "blockdate", "factratebase"
    )
    return means_as_of(rows, ["proid", "hour", "weekday"], calendar.folds, {"average_grp_line_prg": None})


def title_averages(blocks: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """Mean rating by title, slot and channel; title 0 stands for none and is left out."""
    rows = blocks.where((F.col("blockdate") <= calendar.last_cutoff) & (F.col("pro2") != 0)).select(
        "pro2", slot(F.col("blocktime")).alias("hour"), "cnlname", "blockdate", "factratebase"
    )
    return means_as_of(rows, ["pro2", "hour", "cnlname"], calendar.folds, {"average_pro2": None})
