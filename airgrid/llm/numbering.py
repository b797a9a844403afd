"""Positions of rows within groups, without bringing a group to one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airgrid.llm.common import fresh
from airgrid.session import Workspace

_PLACE = (1 << 33) - 1  # the low bits of a row's number hold its place in its task


def numbered(rows: DataFrame, group: str, order: list[str], work: Workspace) -> DataFrame:
    """`rows` with pos (from 0, by `order` within `group`) and total (rows of the group). `group` must not be null.

    Rows are dealt by ranges of group and order, so a hot group spreads over many tasks, and equal rows too: their
    number breaks ties. Each task numbers its own sorted rows in the written stage; what is left is to add, per task
    and group, the rows of earlier tasks.
    """
    tie, number, task, least, before = (fresh(rows, s) for s in ("tie", "number", "task", "least", "before"))
    keys = [group, *order, tie]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = work.keep(dealt.drop(tie).withColumn(number, F.monotonically_increasing_id()), "dealt")
    dealt = dealt.withColumn(task, F.shiftright(number, 33))
    place = F.col(number).bitwiseAND(F.lit(_PLACE))
    held = dealt.groupBy(task, group).agg(F.min(place).alias(least), F.count(F.lit(1)).alias("total"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    held = work.keep(
        held.select(task, group, least, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias(before), F.sum("total").over(whole).alias("total")),
        "held",
    )
    found = dealt.join(held, [task, group]).withColumn("pos", place - F.col(least) + F.col(before))
    return found.select(*rows.columns, "pos", "total")
