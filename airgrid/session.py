"""Spark session settings and the shared folder that stage outputs go to."""

import re
import tempfile
import uuid
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "airgrid", **conf) -> SparkSession:
    """A session with the settings the jobs expect; `conf` entries (dots as `__`) win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a session within one process may fall back to a folder of its own, and
    only executors on one machine may share a `file:` folder."""
    master = spark.sparkContext.master
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder and folder.startswith("file:") and not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, which other machines don't see")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="airgrid-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: While a stage is written, Spark removes its shuffle files when it ends, instead of when the driver happens to collect
#: garbage, and hands rows of long texts to Python in batches of bounded bytes.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", _BATCH_BYTES: "4m"}
#: How stages of long rows (megabytes each) are written: a page holds a row, a row group a few. By default Parquet looks at
#: a page's size only after a hundred rows, compresses them at once, and a reader takes up to 4,096 rows of a group together.
_LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.row.count.limit": "4", "parquet.enable.dictionary": "false"}


def bound_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of the bytes that stages are written with, unless it has a
    limit of its own. For jobs that return frames unwritten: their batches are made when the caller runs them."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, _WRITING[_BATCH_BYTES])


class Workspace:
    """Stage outputs of one run, written as parquet under the shared folder.

    A written stage cuts lineage (a lost executor never replays the stages before it) and gives
    the planner its real size, so a later join broadcasts it only when it truly is small.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/airgrid-{uuid.uuid4().hex}"
        self._written = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def path(self, name: str) -> str:
        self._written += 1
        return f"{self.root}/{self._written:03d}-{name}"

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None, long_rows: bool = False) -> DataFrame:
        """Write `df` and return it as read back.

        With `partition_by`, rows are first rebalanced on those columns: one value's rows end up in
        few files, and a value holding a large share of the rows is split over several tasks. With
        `long_rows`, no more than a few rows are held at once, neither here nor when they are read.
        """
        with self.running():
            return self._keep_at(self.path(name), df, partition_by, _LONG_ROWS if long_rows else {})

    def keep_all(self, stages: dict[str, DataFrame]) -> list[DataFrame]:
        """Write stages that do not depend on each other side by side, so one's tail leaves no idle cores."""
        paths = [self.path(name) for name in stages]
        write = inheritable_thread_target(self.spark)(lambda stage: self._keep_at(*stage))
        with ThreadPool(len(stages)) as pool, self.running():
            return pool.map(write, zip(paths, stages.values()), chunksize=1)

    @contextmanager
    def running(self):
        """While a stage is written, or a result is brought to the driver: nobody reads its shuffle files again, as all go on
        from what it made."""
        before = {key: self.spark.conf.get(key, None) for key in _WRITING}
        for key, value in _WRITING.items():
            self.spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def _keep_at(self, path: str, df: DataFrame, partition_by: list[str] | None = None, options: dict[str, str] = {}) -> DataFrame:
        if partition_by:
            df.hint("rebalance", *[F.col(c) for c in partition_by]).write.options(**options).partitionBy(*partition_by).parquet(path)
        else:
            df.write.options(**options).parquet(path)
        stage = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        self._paths[id(stage)] = stage, path  # with the stage itself, so that its number stays its own
        return stage

    def drop(self, *stages: DataFrame) -> None:
        """Delete stages that `keep` returned and nothing reads any more, so that a run holds what it still needs only.
        A frame that is no stage of this run is left alone."""
        for stage in stages:
            _, path = self._paths.pop(id(stage), (None, None))
            if path:
                self._delete(path)

    def remove(self) -> None:
        """Delete this run's stages, once everything that reads them has been written elsewhere."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
