"""Segments (channel and day type): labels, train/test split, outlier trim, and what each holds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions.calendar import FoldCalendar, day_type
from airgrid.schema import SEGMENT

DAY_TYPES = ["weekdays", "weekend"]


def listed_channels(channels: list[str] | None = None, excluded: list[str] | None = None) -> list[str]:
    """The configured channels without the excluded ones."""
    channels = config.CHANNELS if channels is None else channels
    excluded = config.EXCLUDED_CHANNELS if excluded is None else excluded
    return [c for c in channels if c not in excluded]


def with_segments(sample: DataFrame, calendar: FoldCalendar, channels: list[str]) -> DataFrame:
    """Rows of the listed channels, labelled with their day type and whether they are for training."""
    return sample.where(F.col("cnlname").isin(channels)).select(
        "*",
        day_type(F.col("weekday")).alias("day_type"),
        (F.col("blockdate") < calendar.start_key).alias("is_train"),
    )


def segment_list(spark: SparkSession, channels: list[str]) -> DataFrame:
    """Every listed channel with both day types, so that segments without rows show up too."""
    return spark.createDataFrame([(c, d) for c in channels for d in DAY_TYPES], "cnlname string, day_type string")


def join_per_segment(rows: DataFrame, per_segment: DataFrame) -> DataFrame:
    """Attach one row per segment. Spark picks the join by the size of that side, so pass a written stage where it can be."""
    return rows.join(per_segment, SEGMENT)


def label_statistics(rows: DataFrame) -> DataFrame:
    """Mean and sample deviation of the training labels, and row counts on both sides of the split."""
    label = F.when(F.col("is_train"), F.col(config.LABEL))
    return rows.groupBy(*SEGMENT).agg(
        F.avg(label).alias("label_mean"),
        F.stddev_samp(label).alias("label_std"),
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )


def trimmed_train(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """Training rows whose label stays strictly below mean + 3 deviations.

    There is no lower bound. Rows without label fall out, and so does a segment's only row.
    """
    upper = F.col("label_mean") + config.TRIM_SIGMAS * F.col("label_std")
    return (
        join_per_segment(rows.where("is_train"), statistics.select(*SEGMENT, "label_mean", "label_std"))
        .where(F.col(config.LABEL) < upper)
        .select(*rows.columns)
    )


def segment_status(
    spark: SparkSession, statistics: DataFrame, kept: DataFrame, channels: list[str]
) -> DataFrame:
    """One row per listed segment.

    `empty`: no rows on one side of the split. `failed`: nothing left after the trim, or a null
    feature. `ready`: can be fitted. `kept` holds n_kept and n_null per segment.
    """
    counts = ["n_train", "n_test", "n_kept", "n_null"]
    found = (
        segment_list(spark, channels)
        .join(statistics.select(*SEGMENT, "n_train", "n_test"), SEGMENT, "left")
        .join(kept.select(*SEGMENT, "n_kept", "n_null"), SEGMENT, "left")
        .fillna(0, counts)
    )
    status = (
        F.when((F.col("n_train") == 0) | (F.col("n_test") == 0), "empty")
        .when((F.col("n_kept") == 0) | (F.col("n_null") > 0), "failed")
        .otherwise("ready")
    )
    return found.select(*SEGMENT, *counts, status.alias("status"))
