"""The fold calendar as a table, and what each fold may see of a block table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import calendar as cal
from airgrid.functions.calendar import FoldCalendar


def rows_as_of(blocks: DataFrame, keys: list[str], calendar: FoldCalendar) -> DataFrame:
    """How many rows each fold may learn from and has to predict, and the days on either side of its cutoff."""
    day = F.col("blockdate")
    measures = {
        "n_history": lambda f: F.count_if(day <= f.cutoff),
        "last_history": lambda f: F.max(F.when(day <= f.cutoff, day)),
        "n_target": lambda f: F.count_if((day > f.cutoff) & (day <= f.target_to)),
        "first_target": lambda f: F.min(F.when((day > f.cutoff) & (day <= f.target_to), day)),
    }
    wide = blocks.groupBy(*keys).agg(
        F.min(day).alias("first_day"),
        *[measure(f).alias(f"{name}_{f.number}") for f in calendar.folds for name, measure in measures.items()],
    )
    per_fold = F.array(*[
        F.struct(
            F.lit(f.number).alias("fold"),
            F.lit(f.cutoff).alias("cutoff"),
            *[F.col(f"{name}_{f.number}").alias(name) for name in measures],
        )
        for f in calendar.folds
    ])
    return (
        wide.select(*keys, "first_day", F.inline(per_fold))
        .where(F.col("first_day") <= F.col("cutoff"))
        .select("fold", *keys, *measures)
    )


def calendar_frame(calendar: FoldCalendar, spark: SparkSession) -> DataFrame:
    """The calendar as a table, derived with Spark's date functions."""
    cutoff = F.date_sub(F.lit(calendar.start), (F.lit(calendar.lookback + 1) - F.col("id") * calendar.step).cast("int"))
    last = F.col("id") == len(calendar.folds) - 1
    horizon = F.when(last, calendar.last_horizon).otherwise(calendar.step)
    return spark.range(len(calendar.folds), numPartitions=1).select(
        F.col("id").cast("int").alias("fold"),
        cal.date_key(cutoff).alias("cutoff"),
        cal.date_key(F.date_sub(cutoff, config.WEEK_DAYS)).alias("week_from"),
        cal.date_key(F.date_sub(cutoff, config.MONTH_DAYS)).alias("month_from"),
        cal.date_key(F.date_add(cutoff, horizon)).alias("target_to"),
    )
