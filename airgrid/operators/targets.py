"""The blocks to attach features to, each with the one fold it belongs to."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.calendar import FoldCalendar, day_key, slot
from airgrid.schema import BLOCKS


def target_grid(blocks: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """All block columns plus fold, day key and slot. The slot is not wrapped here, unlike in the history."""
    day = F.col("blockdate")
    return blocks.where(calendar.is_target(day)).select(
        calendar.fold_of(day).alias("fold"),
        *BLOCKS.fieldNames(),
        day_key(day).alias("weekday"),
        slot(F.col("blocktime")).alias("hour"),
    )
