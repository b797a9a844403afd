"""Multi-step SQL transforms with a row count per step, and a log by which a run goes on where one failed."""

import hashlib
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airgrid.session import Workspace
from airgrid.sources import files


@dataclass(frozen=True)
class Step:
    """A named query. It may use the inputs and every earlier step by name, as `{name}`."""

    name: str
    sql: str

    @classmethod
    def from_file(cls, path: str) -> "Step":
        """One statement per file; the file's name is the step's name."""
        file = Path(path)
        return cls(file.stem, file.read_text(encoding="utf-8").strip().removesuffix(";"))

    @property
    def uses(self) -> list[str]:
        return sorted(set(re.findall(r"\{(\w+)\}", self.sql)))


class StepLog:
    """Results of steps in a folder of their own, by a fingerprint of their SQL and of what they read."""

    LAYOUT = "step string, fingerprint string, row_count long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self, table: DataFrame) -> str | None:
        """Of the files that `table` reads; none if it reads no files, so that its content can't be told."""
        read = table.inputFiles()
        if not read:
            return None
        shape = hashlib.sha256(table._jdf.queryExecution().optimizedPlan().canonicalized().toString().encode()).hexdigest()
        return files.listing(self.spark, *read, pattern="*").agg(files.version().alias("v")).first()["v"] + shape[:16]

    def done(self) -> dict[str, int]:
        """Fingerprints of the steps that were written, with their row counts."""
        if not files.exists(self.spark, f"{self.path}/steps"):
            return {}
        return {r["fingerprint"]: r["row_count"] for r in self.spark.read.schema(self.LAYOUT).parquet(f"{self.path}/steps").collect()}

    def folder(self, fingerprint: str) -> str:
        return f"{self.path}/results/{fingerprint}"

    def add(self, step: str, fingerprint: str, count: int) -> None:
        self.spark.createDataFrame([(step, fingerprint, count)], self.LAYOUT).coalesce(1).write.mode("append").parquet(f"{self.path}/steps")


def fingerprint(step: Step, versions: dict[str, str | None]) -> str | None:
    """Of a step's SQL and the versions of what it uses; none if one of these is unknown."""
    used = [versions.get(name) for name in step.uses]
    if None in used:
        return None
    return hashlib.sha256("\0".join([step.name, step.sql, *used]).encode()).hexdigest()


def run_steps(
    spark: SparkSession, steps: list[Step], inputs: dict[str, DataFrame], work: Workspace, log: StepLog | None = None
) -> tuple[dict[str, DataFrame], list[tuple[str, int]]]:
    """Run the steps in order; return each result as written, and each step's row count.

    Rows are counted while they are written, so no step is computed twice. With a `log`, results are written there, and
    a step whose SQL and inputs are those of a written result is read from it: a run that failed goes on with the step
    that did. A result is logged when it is whole.
    """
    tables, counts = dict(inputs), []
    versions = {name: log.version(table) for name, table in inputs.items()} if log else {}
    done = log.done() if log else {}
    for step in steps:
        mark = fingerprint(step, versions) if log else None
        if mark in done:
            tables[step.name] = spark.read.parquet(log.folder(mark))
            counts.append((step.name, done[mark]))
        else:
            seen = Observation(step.name)
            rows = spark.sql(step.sql, **tables).observe(seen, F.count(F.lit(1)).alias("rows"))
            if mark:
                rows.write.mode("overwrite").parquet(log.folder(mark))
                tables[step.name] = spark.read.schema(rows.schema).parquet(log.folder(mark))
                log.add(step.name, mark, seen.get["rows"])
            else:
                tables[step.name] = work.keep(rows, step.name)
            counts.append((step.name, seen.get["rows"]))
        versions[step.name] = mark
    return {step.name: tables[step.name] for step in steps}, counts
