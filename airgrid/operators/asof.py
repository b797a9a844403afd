"""One history as seen from every cutoff, in a single pass over its rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.functions.calendar import Fold, FoldCalendar


def _case(value: Column, uppers: list[int]) -> Column:
    """Index of the first upper bound that the value does not exceed."""
    return reduce(lambda case, upper: case.when(value <= upper[1], upper[0]), enumerate(uppers), F)


def means_as_of(
    rows: DataFrame, keys: list[str], folds: list[Fold], ranges: dict[str, str | None], value: str = "factratebase",
    counted: str | None = None,
) -> DataFrame:
    """Mean of `value` per key, as an array over the folds, for several day ranges that end at the cutoff.

    `ranges` maps an output column to the fold attribute its range starts at (None: all history).
    `first_fold` is the first fold that sees any row of the key. With `counted`, rows are sums already, of so many values.

    The borders of all ranges cut the calendar into a few dozen spans, and every range is a run of
    whole spans. So history rows are never repeated per fold: they are summed per key and span,
    map-side first, and only these sums are put together into the folds' means. A key stays one row
    for all folds, which keeps the lookup joins on it small.
    """
    starts = {name: [getattr(f, start) - 1 if start else None for f in folds] for name, start in ranges.items()}
    uppers = sorted({f.cutoff for f in folds} | {s for days in starts.values() for s in days if s is not None})
    span = {upper: index for index, upper in enumerate(uppers)}
    sums = rows.groupBy(*keys, _case(F.col("blockdate"), uppers).alias("span")).agg(
        F.sum(value).alias("total"), (F.sum(counted) if counted else F.count(value)).alias("n")
    )

    def within(name: str, fold: Fold, column: str):
        start = starts[name][fold.number]
        first = 0 if start is None else span[start] + 1
        return F.sum(F.when(F.col("span").between(first, span[fold.cutoff]), F.col(column)))

    wide = sums.groupBy(*keys).agg(
        F.min("span").alias("first_span"),
        *[within(name, f, part).alias(f"{name}_{f.number}_{part}") for name in ranges for f in folds for part in ("total", "n")],
    )
    means = [
        F.array(*[F.try_divide(f"{name}_{f.number}_total", f"{name}_{f.number}_n") for f in folds]).alias(name)
        for name in ranges
    ]
    first_fold = _case(F.col("first_span"), [span[f.cutoff] for f in folds])
    return wide.select(*keys, first_fold.alias("first_fold"), *means)


def per_fold(averages: DataFrame) -> DataFrame:
    """The same averages with one row per key and fold, for the folds that see the key."""
    means = [name for name, kind in averages.dtypes if kind == "array<double>"]
    keys = [name for name in averages.columns if name not in [*means, "first_fold"]]
    zipped = F.posexplode(F.arrays_zip(*means)).alias("fold", "mean")
    return (
        averages.select(*keys, "first_fold", zipped).where("fold >= first_fold")
        .select("fold", *keys, *[F.col(f"mean.{name}").alias(name) for name in means])
    )
