"""Files of tables, by listing alone: what versions they have, and removing what is no longer needed."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that isn't there is none to delete."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with wildcards matches."""
    folder, store = _folder(spark, pattern)
    return [str(status.getPath()) for status in store.globStatus(folder) or []]


def version() -> Column:
    """Of a listing's files: their number, and their names, lengths and times of change in a few characters."""
    name = F.element_at(F.split("path", "/"), -1)
    return F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor(F.xxhash64(name, "length", "modificationTime"))))


def listing(spark: SparkSession, *paths: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length, modificationTime of files, and the partition columns in their folders' names. None is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(list(paths))
    return files.drop("content")
