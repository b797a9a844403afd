"""Daily sums of a network table, kept between runs.

The averages as of a cutoff are sums over days, so each day's part of them can be made once. A state folder holds, per
day, sums and counts of ratings by the keys of the three averages, and the version of the files they were made of. Copies
are dropped within a day, which is exact, as the day is one of the columns that make a copy. A run lists the network's
files, reads the days that are new or have other files than before, and forgets days that are gone; all else is read
from the state, which is smaller than the history by the number of blocks per key and day.

An update first removes a stale day's version, then its sums, writes the new sums, and writes the version last. So a
day that has a version has its sums, and an update that was cut off is made up for by the next one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.functions.calendar import FoldCalendar, day_key, slot, wrapped_slot
from airgrid.operators.asof import means_as_of
from airgrid.session import Workspace
from airgrid.sources import files
from airgrid.sources.tables import read_blocks

SUMS = "total double, n long, blockdate int"
TABLES = {
    "time": f"cnlname string, hour int, {SUMS}",
    "line": f"proid int, hour int, {SUMS}",
    "title": f"pro2 int, hour int, cnlname string, {SUMS}",
}
DAYS = "version string, blockdate int"


def day_sums(blocks: DataFrame) -> dict[str, DataFrame]:
    """Per day, the sums of ratings by the keys of each average."""
    rating = [F.sum("factratebase").alias("total"), F.count("factratebase").alias("n")]
    single = blocks.select("cnlname", "blocktime", "blockdate", "factratebase").distinct()
    single = single.where(F.col("cnlname").isNotNull() & F.col("blocktime").isNotNull())
    plain = slot(F.col("blocktime")).alias("hour")
    return {
        "time": single.groupBy("blockdate", "cnlname", wrapped_slot(F.col("blocktime")).alias("hour")).agg(*rating),
        "line": blocks.groupBy("blockdate", "proid", plain).agg(*rating),
        "title": blocks.where(F.col("pro2") != 0).groupBy("blockdate", "pro2", plain, "cnlname").agg(*rating),
    }


class DailySums:
    """The state in a folder of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, layout: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(folder)

    def days(self) -> DataFrame:
        """version, blockdate: the days whose sums are here."""
        return self._table("days", DAYS)

    def sums(self, name: str) -> DataFrame:
        """A table of TABLES, for the days that have a version."""
        return self._table(name, TABLES[name]).join(self.days().select("blockdate"), "blockdate", "left_semi")

    def update(self, network: str, work: Workspace) -> list[int]:
        """Bring the state up to the network table in the folder `network`; the days that were read for it."""
        listed = files.listing(self.spark, network).groupBy("blockdate").agg(files.version().alias("now"))
        both = listed.join(self.days().withColumnRenamed("version", "then"), "blockdate", "full")
        # One row per day that differs: bounded by the calendar.
        differing = both.where(~F.col("now").eqNullSafe(F.col("then"))).orderBy("blockdate").collect()
        for name in ("days", *TABLES):
            for row in differing:
                files.delete(self.spark, f"{self.path}/{name}/blockdate={row['blockdate']}")
        stale = [row for row in differing if row["now"] is not None]
        if not stale:
            return []
        days = [row["blockdate"] for row in stale]
        blocks = read_blocks(self.spark, network).where(F.col("blockdate").isin(days))
        # Written side by side in the run's own folder first: only whole sums are appended to the state.
        sums = day_sums(blocks)
        for name, rows in zip(sums, work.keep_all(sums), strict=True):
            rows.hint("rebalance", "blockdate").write.mode("append").partitionBy("blockdate").parquet(f"{self.path}/{name}")
        log = self.spark.createDataFrame([(row["now"], row["blockdate"]) for row in stale], DAYS)
        log.hint("rebalance", "blockdate").write.mode("append").partitionBy("blockdate").parquet(f"{self.path}/days")
        return days

    def averages(self, calendar: FoldCalendar) -> dict[str, DataFrame]:
        """The three averages of `airgrid.operators.history` from the state."""
        last, day = F.col("blockdate") <= calendar.last_cutoff, day_key(F.col("blockdate"))
        time = self.sums("time").where(last & (F.col("blockdate") >= calendar.history_floor)).withColumn("weekday", day)
        line = self.sums("line").where(last).withColumn("weekday", day)
        from_sums = {"value": "total", "counted": "n"}
        return {
            "by_time": means_as_of(time, ["weekday", "cnlname", "hour"], calendar.folds, {
                "average_grp": None, "average_grp_week": "week_from", "average_grp_month": "month_from",
            }, **from_sums),
            "by_line": means_as_of(line, ["proid", "hour", "weekday"], calendar.folds, {"average_grp_line_prg": None}, **from_sums),
            "by_title": means_as_of(
                self.sums("title").where(last), ["pro2", "hour", "cnlname"], calendar.folds, {"average_pro2": None}, **from_sums
            ),
        }
