"""A dozen blocks on which every rule of the averages shows."""

from datetime import date

from airgrid.functions.calendar import FoldCalendar
from airgrid.schema import BLOCKS, conform

# One fold: cutoff 20240110, week from 20240103, month from 20231210.
CALENDAR = FoldCalendar(start=date(2024, 1, 11), lookback=0, last_horizon=14)

ROWS = [
    (1, 20240103, 20000, "A", 2.0, 1, 0),
    (2, 20240103, 20000, "A", 2.0, 1, 0),
    (3, 20240110, 20100, "A", 4.0, None, 5),
    (4, 20240103, 88300, "A", 6.0, 1, 5),
    (5, 20240103, 86500, "A", 8.0, 1, 0),
    (6, 20231227, 20000, "A", 9.0, 1, 5),
    (7, 20240110, 20000, None, 50.0, 1, 5),
    (8, 20240103, 20300, "A", None, 1, 5),
    (9, 20240117, 20000, "A", None, None, 5),
    (10, 20240117, 88300, "A", None, 1, 0),
    (11, 20240117, 86500, "A", None, 1, 0),
]


def blocks(spark, rows=ROWS):
    names = "blockid long, blockdate int, blocktime int, cnlname string, factratebase double, proid int, pro2 int"
    return conform(spark.createDataFrame(rows, names))


def full_blocks(spark, rows):
    """Blocks from dicts, nulls for what is left out."""
    return spark.createDataFrame([tuple(r.get(n) for n in BLOCKS.fieldNames()) for r in rows], BLOCKS)


def as_set(df, digits=None):
    """Rows as a set; with `digits`, doubles are rounded, since sums of them may be added in any order."""
    return {
        tuple(round(v, digits) if digits and isinstance(v, float) else v for v in row) for row in df.collect()
    }
