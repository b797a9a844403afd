"""The batch run: sample, segments, three models per segment, forecast, status."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrid import config
from airgrid.functions.calendar import FoldCalendar
from airgrid.functions.scoring import linear_score, weights_of
from airgrid.operators import boosting, moments, nnls, segments, sgd
from airgrid.plans.sample import feature_sample
from airgrid.schema import BLOCKS, SEGMENT
from airgrid.session import Workspace
from airgrid.sources import sinks
from airgrid.sources.daily import DailySums
from airgrid.sources.runs import RunTables

SAMPLE_COLUMNS = [
    *BLOCKS.fieldNames(), "weekday", "hour",
    "average_grp", "average_grp_week", "average_grp_month", "average_grp_line_prg", "average_pro2",
    "Movies_diff", "Series_diff",
]
FORECAST_COLUMNS = [*SAMPLE_COLUMNS, "Pred_GBT", "Pred_SGD", "Pred_NNLS", "Today"]
FORECAST = T.StructType([
    *BLOCKS.fields, T.StructField("weekday", T.IntegerType()), T.StructField("hour", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in [*SAMPLE_COLUMNS[len(BLOCKS) + 2 :], "Pred_GBT", "Pred_SGD", "Pred_NNLS"]],
    T.StructField("Today", T.StringType()),
])


@dataclass(frozen=True)
class Modelled:
    """The sample of the listed channels, written by segment, with its label statistics."""

    rows: DataFrame
    statistics: DataFrame
    train: DataFrame
    channels: list[str]


def model_sample(
    blocks: DataFrame, calendar: FoldCalendar, channels: list[str], work: Workspace, sums: DailySums | None = None
) -> Modelled:
    """Write the labelled sample once, as every model passes over it.

    It is partitioned by segment and side of the split: fits skip the test rows, which reach much
    further than the training rows, and scoring skips the training rows.
    """
    sample = feature_sample(blocks, calendar, work, sums)
    labelled = segments.with_segments(sample, calendar, channels)
    rows = work.keep(labelled, "sample", partition_by=[*SEGMENT, "is_train"])
    statistics = work.keep(segments.label_statistics(rows), "statistics")
    return Modelled(rows, statistics, segments.trimmed_train(rows, statistics), channels)


def fit_linear(
    modelled: Modelled, work: Workspace, settings: sgd.SgdSettings = sgd.SgdSettings()
) -> tuple[DataFrame, DataFrame]:
    """Coefficients of both linear models per segment, and the SGD trace."""
    linear = work.keep(nnls.fit_nnls(moments.segment_moments(modelled.train)), "nnls")
    trace = work.keep(sgd.sgd_trace(modelled.train, linear, settings), "sgd")
    return work.keep(linear.join(sgd.final_weights(trace), SEGMENT, "left"), "coefficients"), trace


def score_linear(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Both linear predictions for the rows of every fitted segment; weights that ran off to infinity show in them."""
    fitted = coefficients.where("nnls is not null").select(*SEGMENT, "nnls", "sgd")
    return (
        segments.join_per_segment(rows, fitted)
        .withColumns({"Pred_SGD": linear_score(weights_of("sgd")), "Pred_NNLS": linear_score(weights_of("nnls"))})
        .drop("nnls", "sgd")
    )


@dataclass(frozen=True)
class ForecastRun:
    forecast: DataFrame
    coefficients: DataFrame
    trace: DataFrame
    status: DataFrame
    grid: DataFrame
    run_date: str
    boosted: boosting.Boosted


def run_forecast(
    blocks: DataFrame,
    calendar: FoldCalendar,
    work: Workspace,
    channels: list[str] | None = None,
    excluded: list[str] | None = None,
    sgd_settings: sgd.SgdSettings = sgd.SgdSettings(),
    boosting_settings: boosting.BoostingSettings = boosting.BoostingSettings(),
    sums: DailySums | None = None,
) -> ForecastRun:
    """Forecast the blocks from the calendar's start day on, for every listed channel and day type.

    Fails segment by segment: the status table says what became of each one. `sums`: see `raw_sample`.
    """
    spark = work.spark
    channels = segments.listed_channels(channels, excluded)
    modelled = model_sample(blocks, calendar, channels, work, sums)
    coefficients, trace = fit_linear(modelled, work, sgd_settings)
    status = work.keep(segments.segment_status(spark, modelled.statistics, coefficients, channels), "status")
    # At most two rows per listed channel come to the driver here.
    solved = coefficients.where("nnls is not null").select(*SEGMENT)
    ready = [(r.cnlname, r.day_type) for r in status.where("status = 'ready'").join(solved, SEGMENT, "left_semi").select(*SEGMENT).collect()]

    train = boosting.training_table(modelled.train, boosting_settings, work)
    boosted = boosting.fit_boosted(train, ready, work, boosting_settings)

    test = score_linear(modelled.rows.where(~F.col("is_train")), coefficients)
    forecast = sinks.stamp(boosting.score_boosted(test, boosted.models), calendar).select(*FORECAST_COLUMNS)
    outcome = (
        F.when(F.col("status") != "ready", F.col("status"))
        .when(~F.coalesce("solved", F.lit(False)), "failed")
        .when(F.col("error").isNotNull(), "failed")
        .when(~F.coalesce("sgd_finite", F.lit(False)), "diverged")
        .otherwise("loaded")
    )
    status = (
        status.join(boosted.errors, SEGMENT, "left")
        .join(coefficients.select(*SEGMENT, "sgd_finite", F.col("nnls").isNotNull().alias("solved")), SEGMENT, "left")
        .select(*SEGMENT, "n_train", "n_test", "n_kept", outcome.alias("status"), "error")
    )
    return ForecastRun(
        forecast, sinks.stamp(sinks.coefficient_rows(coefficients.where("nnls is not null")), calendar),
        trace, sinks.stamp(status, calendar), boosted.grid, calendar.run_date, boosted,
    )


def publish_forecast(run: ForecastRun, tables: RunTables, run_id: str | None = None, replace: bool = False) -> bool:
    """Publish the run's forecast, coefficients and status together, under its date if it has no other name; false if
    that run is published already and not to be replaced."""
    return tables.publish(run_id or run.run_date, run_tables(run), replace)


def run_tables(run: ForecastRun) -> dict[str, DataFrame]:
    return {"forecast": run.forecast, "coefficients": run.coefficients, "segment_status": run.status}
