"""Result tables whose rows show run by run, all tables of a run together or none.

A run's rows go to all tables under an attempt's name of their own. Only then one row in the manifest names the attempt
as the one in force for its run. Readers see rows of attempts in force, so a run that is killed between two tables shows
nothing, a repeated run is not appended twice, and a replaced run changes from the old rows to the new ones at once.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrid.sources import files

MANIFEST = "run_id string, attempt_id string, tables array<string>, published timestamp"
ATTEMPT = [T.StructField("run_id", T.StringType()), T.StructField("attempt_id", T.StringType())]


class RunTables:
    """Tables below a folder (`sink` "files"), or catalog tables whose names begin with `root` ("catalog")."""

    def __init__(self, spark: SparkSession, root: str, sink: str = "files"):
        if sink not in ("files", "catalog"):
            raise ValueError("sink must be files or catalog")
        self.spark, self.root, self.sink = spark, root, sink

    def _name(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}" if self.sink == "files" else f"{self.root}{table}"

    def _append(self, rows: DataFrame, table: str, partition_by: list[str]) -> None:
        writer = rows.write.mode("append").partitionBy(*partition_by)
        if self.sink == "files":
            writer.parquet(self._name(table))
        else:
            writer.format("parquet").saveAsTable(self._name(table))

    def _all(self, table: str, layout: T.StructType) -> DataFrame:
        """All rows of a table, none if it is missing."""
        if self.sink == "files":
            if files.exists(self.spark, self._name(table)):
                return self.spark.read.schema(layout).parquet(self._name(table))
        elif self.spark.catalog.tableExists(self._name(table)):
            return self.spark.table(self._name(table)).select(*layout.fieldNames())
        return self.spark.createDataFrame([], layout)

    def published(self) -> DataFrame:
        """run_id, attempt_id, tables, published: each run's attempt in force, the last that was published."""
        rows = self._all("manifest", T.StructType.fromDDL(MANIFEST))
        last = F.max(F.struct("published", "attempt_id", "tables")).alias("last")
        return rows.groupBy("run_id").agg(last).select("run_id", "last.attempt_id", "last.tables", "last.published")

    def is_published(self, run_id: str) -> bool:
        return not self.published().where(F.col("run_id") == run_id).isEmpty()

    def stage(self, run_id: str, tables: dict[str, DataFrame]) -> str:
        """Write all tables of a new attempt, seen by nobody yet; the attempt's name."""
        attempt = uuid.uuid4().hex
        for name, rows in tables.items():
            marked = rows.withColumns({"run_id": F.lit(run_id), "attempt_id": F.lit(attempt)})
            self._append(marked.hint("rebalance"), name, ["run_id", "attempt_id"])
        return attempt

    def commit(self, run_id: str, attempt: str, tables: list[str]) -> None:
        """Bring an attempt into force: one row, one file."""
        row = self.spark.createDataFrame([(run_id, attempt, sorted(tables))], "run_id string, attempt_id string, tables array<string>")
        self._append(row.coalesce(1).withColumn("published", F.current_timestamp()), "manifest", [])

    def publish(self, run_id: str, tables: dict[str, DataFrame], replace: bool = False) -> bool:
        """Append a run's tables. A run that is published already stays as it is, or with `replace` gives way; whether
        anything was written."""
        if not replace and self.is_published(run_id):
            return False
        self.commit(run_id, self.stage(run_id, tables), list(tables))
        return True

    def read(self, table: str, layout: T.StructType, with_run: bool = False) -> DataFrame:
        """The rows in force, in the table's own layout, and with `with_run` their run_id."""
        rows = self._all(table, T.StructType([*layout.fields, *ATTEMPT]))
        return rows.join(self.published().select("run_id", "attempt_id"), ["run_id", "attempt_id"], "left_semi").select(*layout.fieldNames(), *["run_id"] * with_run)

    def remove_others(self) -> int:
        """Delete rows of attempts that are not in force, which no reader sees: of killed, repeated and replaced runs. Not
        while a run is being written. How many attempts of a table went."""
        kept = {r["attempt_id"] for r in self.published().select("attempt_id").collect()}  # a row per run
        if self.sink == "files":
            others = [p for p in files.found(self.spark, f"{self._name('*')}/run_id=*/attempt_id=*") if p.rpartition("=")[2] not in kept]
            for path in others:
                files.delete(self.spark, path)
            return len(others)
        others = []
        for table in [t.name for t in self.spark.catalog.listTables() if t.name.startswith(self.root) and t.name != self._name("manifest")]:
            for row in self.spark.sql(f"show partitions {table}").collect():
                run, attempt = (part.partition("=")[2] for part in row["partition"].split("/"))
                if attempt not in kept:
                    others.append((table, run, attempt))
        for table, run, attempt in others:
            self.spark.sql(f"alter table {table} drop partition (run_id = '{run}', attempt_id = '{attempt}')")
        return len(others)
