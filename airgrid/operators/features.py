"""Averages joined onto the target grid, gaps filled, differences derived."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(rows: DataFrame, averages: DataFrame, keys: list[str], null_safe: list[str]) -> DataFrame:
    """Left join on `keys`, picking each row's fold out of the averages; `null_safe` keys match null to null.

    No hint is given: the averages are written stages, so the planner broadcasts them if their real
    size allows and otherwise shuffles, with skewed partitions of `rows` split at run time.
    """
    means = [name for name, kind in averages.dtypes if kind == "array<double>"]
    right = averages.select(*[F.col(k).alias(f"of_{k}") for k in keys], *[F.col(m).alias(f"of_{m}") for m in means])
    matches = [
        rows[k].eqNullSafe(right[f"of_{k}"]) if k in null_safe else rows[k] == right[f"of_{k}"] for k in keys
    ]
    joined = rows.join(right, reduce(lambda a, b: a & b, matches), "left")
    return joined.select(*rows.columns, *[F.get(f"of_{m}", "fold").alias(m) for m in means])


def attach_averages(targets: DataFrame, by_time: DataFrame, by_line: DataFrame, by_title: DataFrame) -> DataFrame:
    """The five raw averages of each target block, null where its fold's history has none."""
    rows = look_up(targets, by_time, ["weekday", "cnlname", "hour"], null_safe=[])
    rows = look_up(rows, by_line, ["proid", "hour", "weekday"], null_safe=["proid"])
    return look_up(rows, by_title, ["pro2", "hour", "cnlname"], null_safe=["cnlname"])


def overall_average(targets: DataFrame, by_time: DataFrame) -> DataFrame:
    """Mean of the time average over all target rows that have one, train and test alike.

    Target rows are first counted per key, so the mean needs neither the joined sample nor a second
    pass over it: only three columns are read and only the counts are joined.
    """
    keys = ["weekday", "cnlname", "hour"]
    counts = targets.groupBy("fold", *keys).agg(F.count(F.lit(1)).alias("n"))
    matched = look_up(counts, by_time.select(*keys, "average_grp"), keys, null_safe=[]).where("average_grp is not null")
    return matched.agg((F.sum(F.col("average_grp") * F.col("n")) / F.sum("n")).alias("average_grp"))


def fill_gaps(rows: DataFrame, mean: DataFrame) -> DataFrame:
    """Fill each average from the next broader one, the time average from the overall mean."""
    rows = rows.withColumn("average_grp", F.coalesce("average_grp", mean.scalar()))
    rows = rows.withColumns({
        name: F.coalesce(name, "average_grp")
        for name in ["average_grp_week", "average_grp_month", "average_grp_line_prg"]
    })
    return rows.withColumn("average_pro2", F.coalesce("average_pro2", "average_grp_line_prg"))


def add_differences(rows: DataFrame) -> DataFrame:
    """How far a title departs from its programme line, kept apart for movies and for series."""
    difference = F.col("average_pro2") - F.col("average_grp_line_prg")
    return rows.withColumns({
        "Movies_diff": difference * F.col("is_movie"),
        "Series_diff": difference * F.col("is_series"),
    })
