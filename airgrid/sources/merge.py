"""Corrected blocks merged into a network table by key, and what changed.

A block's key is its id and its origin. A grid with a part of a day replaces the blocks it holds and leaves the others; only
days with a change are written again, so a state made of the other days' files stays valid. Keys may be null and may
repeat: all rows of a key are one value, compared by their number and the sum of their hashes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.schema import BLOCKS
from airgrid.session import Workspace
from airgrid.sources import files
from airgrid.sources.tables import read_blocks, replace_days, table_blocks, write_blocks

KEY = ["blockid", "VIMB_type"]


def _by_key(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on the key, null to null; `other`'s key columns are called of_blockid and of_VIMB_type."""
    renamed = other.withColumnsRenamed({k: f"of_{k}" for k in KEY})
    return rows.join(renamed, F.col("blockid").eqNullSafe(F.col("of_blockid")) & F.col("VIMB_type").eqNullSafe(F.col("of_VIMB_type")), how)


def _values(blocks: DataFrame, side: str) -> DataFrame:
    """Per key, what stands for its rows, and the days they are on."""
    # A hash passes over nulls, so which columns are null goes in besides.
    nulls = F.concat(*[F.isnull(name).cast("int").cast("string") for name in BLOCKS.fieldNames()])
    row = F.xxhash64(nulls, *BLOCKS.fieldNames()).cast("decimal(20,0)")
    return blocks.groupBy(*KEY).agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("hash")).alias(side), F.collect_set("blockdate").alias(f"{side}_days")
    )


def block_changes(existing: DataFrame, incoming: DataFrame, whole_days: bool = False) -> DataFrame:
    """Per key of `incoming`: blockid, VIMB_type, change (added, changed, same), old_days, new_days.

    With `whole_days`, the incoming grid holds all blocks of its days: keys that only `existing` has on them are gone.
    A block that moved to another day is found wherever it was; only the key, the day and the row's hash are compared.
    """
    new = _values(incoming, "new")
    asked = new.select(*KEY)
    if whole_days:
        days = incoming.select("blockdate").distinct()
        there = existing.join(days, "blockdate", "left_semi").select(*KEY)
        asked = asked.unionByName(there).distinct()
    both = _by_key(_values(_by_key(existing, asked, "left_semi"), "old"), new, "full")
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone")
        .when(F.col("old") == F.col("new"), "same").otherwise("changed")
    )
    none = F.array().cast("array<int>")
    keys = [F.when(F.col("new").isNull(), F.col(k)).otherwise(F.col(f"of_{k}")).alias(k) for k in KEY]
    return both.select(*keys, change.alias("change"), F.coalesce("old_days", none).alias("old_days"), F.coalesce("new_days", none).alias("new_days"))


def touched_days(changes: DataFrame) -> list[int]:
    """The days that a change takes something from or adds something to: bounded by the calendar."""
    rows = changes.where("change <> 'same'").select(F.explode(F.array_union("old_days", "new_days")).alias("day"))
    return sorted(r["day"] for r in rows.distinct().collect())


def merged_blocks(existing: DataFrame, incoming: DataFrame, changes: DataFrame, days: list[int]) -> DataFrame:
    """The blocks of `days` after the changes."""
    differing = changes.where("change <> 'same'").select(*KEY)
    kept = _by_key(existing.where(F.col("blockdate").isin(days)), differing, "left_anti")
    fresh = _by_key(incoming, differing, "left_semi")
    return kept.select(*BLOCKS.fieldNames()).unionByName(fresh.select(*BLOCKS.fieldNames()))


def merge_blocks(incoming: DataFrame, path: str, work: Workspace, whole_days: bool = False) -> DataFrame:
    """Merge `incoming` into the network table in the folder `path`; the changes. A merge that was cut off is completed by
    repeating it: what it did is then the same, what it did not is changed still."""
    spark = work.spark
    if not files.exists(spark, path):
        write_blocks(incoming, path)
        return work.keep(block_changes(spark.createDataFrame([], BLOCKS), incoming), "changes")
    changes, merged, days = _merged(read_blocks(spark, path), incoming, work, whole_days)
    if days:
        write_blocks(merged, path)
        filled = {r["blockdate"] for r in merged.select("blockdate").distinct().collect()}
        for day in set(days) - filled:
            files.delete(spark, f"{path}/blockdate={day}")
    return changes


def merge_table(incoming: DataFrame, name: str, work: Workspace, whole_days: bool = False) -> DataFrame:
    """The same for a catalog table, which is created if it is missing."""
    spark = work.spark
    if not spark.catalog.tableExists(name):
        replace_days(incoming, name)
        return work.keep(block_changes(spark.createDataFrame([], BLOCKS), incoming), "changes")
    changes, merged, days = _merged(table_blocks(spark, name), incoming, work, whole_days)
    if days:
        replace_days(merged, name)
        filled = {r["blockdate"] for r in merged.select("blockdate").distinct().collect()}
        for day in set(days) - filled:
            spark.sql(f"alter table {name} drop if exists partition (blockdate = {day})")
    return changes


def _merged(existing: DataFrame, incoming: DataFrame, work: Workspace, whole_days: bool) -> tuple[DataFrame, DataFrame, list[int]]:
    """Changes and merged rows, both written, as the table they come from is about to be overwritten."""
    incoming = work.keep(incoming, "incoming")
    changes = work.keep(block_changes(existing, incoming, whole_days), "changes")
    days = touched_days(changes)
    return changes, work.keep(merged_blocks(existing, incoming, changes, days), "merged"), days
