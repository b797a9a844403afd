"""Append tables: forecasts, coefficients and segment status, all stamped with the run date."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrid import config
from airgrid.functions.calendar import FoldCalendar
from airgrid.schema import SEGMENT


def stamp(rows: DataFrame, calendar: FoldCalendar) -> DataFrame:
    """Add the run date as text."""
    return rows.withColumn("Today", F.lit(calendar.run_date))


def append_run(rows: DataFrame | None, path: str, replace_run: bool = False, run_date: str | None = None) -> None:
    """Append stamped rows to a parquet table partitioned by run date, creating it if missing.

    A plain append repeats the rows when a run is repeated. `replace_run` overwrites the run dates that `rows`
    holds, and clears `run_date` if the run has no rows for this table. Files are cut by size, however many
    parts the rows come in.
    """
    if rows is not None:
        writer = rows.hint("rebalance").write.partitionBy("Today")
        if not replace_run:
            writer.mode("append").parquet(path)
            return
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if replace_run and run_date is not None and (rows is None or rows.isEmpty()):
        spark = SparkSession.active()
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/Today={run_date}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_run_table(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """A table that `append_run` wrote, in its own layout: the run date is text, as it was written, not a date."""
    return spark.read.schema(layout).parquet(path)


def append_run_table(rows: DataFrame, name: str) -> None:
    """The same for a catalog table."""
    rows.hint("rebalance").write.mode("append").partitionBy("Today").format("parquet").saveAsTable(name)


def coefficient_rows(coefficients: DataFrame) -> DataFrame:
    """One row per segment and feature with its NNLS and SGD coefficient, in feature order."""
    names = F.array(*[F.lit(name) for name in config.FEATURES])
    triples = F.arrays_zip(names.alias("feature"), F.col("nnls"), F.col("sgd"))
    return coefficients.select(*SEGMENT, F.posexplode(triples).alias("position", "t")).select(
        *SEGMENT, "position", "t.feature", "t.nnls", "t.sgd"
    )
