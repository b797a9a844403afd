"""Where block tables come from: files, catalog tables, or a relational store."""

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from airgrid.schema import BLOCKS, conform


def read_blocks(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Block table from files, in the fixed layout."""
    return conform(spark.read.format(fmt).options(**options).load(path))


def table_blocks(spark: SparkSession, name: str) -> DataFrame:
    """Block table from the catalog, in the fixed layout."""
    return conform(spark.table(name))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Store blocks in a network table partitioned by day, so that date bounds skip whole folders.

    Only the days that `blocks` holds are replaced, each when its rows are written; all other days stay as they are.
    """
    writer = blocks.hint("rebalance", "blockdate").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("blockdate").parquet(path)


def replace_days(blocks: DataFrame, name: str) -> None:
    """The same for a catalog table, which is created if it is missing."""
    rows = blocks.hint("rebalance", "blockdate")
    if not blocks.sparkSession.catalog.tableExists(name):
        rows.write.partitionBy("blockdate").format("parquet").saveAsTable(name)
        return
    spark, mode = blocks.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def month_predicates(first_day: int, last_day: int, column: str = "blockdate") -> list[str]:
    """One condition per month of a yyyymmdd range: even slices for a parallel read.

    Equal-width slices of the integer would be uneven, as it jumps at every month's end.
    """
    if first_day > last_day:
        raise ValueError("first_day lies after last_day")
    (year, month), conditions = divmod(first_day // 100, 100), []
    while year * 100 + month <= last_day // 100:
        base = (year * 100 + month) * 100
        low, high = max(base + 1, first_day), min(base + 31, last_day)
        conditions.append(f"{column} >= {low} AND {column} <= {high}")
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return conditions


@dataclass(frozen=True)
class RelationalStore:
    """A JDBC database. Address and login come from the caller or the environment, never from code."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    fetch_rows: int = 10_000
    batch_rows: int = 10_000

    @classmethod
    def from_environment(cls, prefix: str = "AIRGRID_JDBC") -> "RelationalStore":
        url = os.environ.get(f"{prefix}_URL")
        if not url:
            raise RuntimeError(f"set {prefix}_URL to the JDBC address of the store")
        return cls(url, *[os.environ.get(f"{prefix}_{part}") for part in ("DRIVER", "USER", "PASSWORD")])

    def properties(self) -> dict[str, str]:
        found = {"driver": self.driver, "user": self.user, "password": self.password}
        sizes = {"fetchsize": str(self.fetch_rows), "batchsize": str(self.batch_rows)}
        return {k: v for k, v in found.items() if v} | sizes

    def read_blocks(self, spark: SparkSession, table: str, first_day: int, last_day: int) -> DataFrame:
        """Blocks of a range of days, one parallel query per month; filters and columns reach the store."""
        columns = ", ".join(BLOCKS.fieldNames())
        return conform(spark.read.jdbc(
            self.url, f"(SELECT {columns} FROM {table}) blocks",
            predicates=month_predicates(first_day, last_day), properties=self.properties(),
        ))

    def append(self, rows: DataFrame, table: str) -> None:
        """Append rows; the table is created from their types if it is missing."""
        rows.write.jdbc(self.url, table, mode="append", properties=self.properties())
